"""Exploding computed arrays without evaluating them twice.

For ``explode(expr)`` Catalyst infers a ``size(expr) > 0`` filter and pushes
it towards the scan, so an expensive ``expr`` (tokenizing a long text, say)
runs twice, once in the scan stage. Outer generators get no inferred filter;
dropping the row an outer generator emits for an empty array (the one with a
NULL position) gives exactly the rows of ``explode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, array: Column, out: str, keep: list | tuple = (), pos: str | None = None) -> DataFrame:
    """Rows of ``explode(array)`` (with the position when ``pos`` is given)."""
    p = pos or "_pos"
    rows = df.select(*keep, F.posexplode_outer(array).alias(p, out)).where(F.col(p).isNotNull())
    return rows if pos else rows.drop(p)
