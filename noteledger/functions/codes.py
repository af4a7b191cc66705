"""Code and code-set expressions (Column -> Column)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import CODE_SEPARATOR, CODE_STRICT
from .text import col, strip_ws


def is_code(c, pattern: str = CODE_STRICT) -> Column:
    """Code format predicate (NULL stays NULL)."""
    return col(c).rlike(pattern)


def code_pieces(codes, sep: str = CODE_SEPARATOR) -> Column:
    """Split a code-set string; pieces are stripped, empties dropped; NULL -> []."""
    parts = F.split(F.coalesce(col(codes), F.lit("")), re.escape(sep))
    return F.filter(F.transform(parts, strip_ws), lambda x: x != "")


def parse_code_set(codes, pattern: str = CODE_STRICT, sep: str = CODE_SEPARATOR) -> Column:
    """Split, strip, drop empty pieces and keep well-formed codes only."""
    return F.filter(code_pieces(codes, sep), lambda x: x.rlike(pattern))


def raw_code_pieces(codes, sep: str = CODE_SEPARATOR) -> Column:
    """Pieces as written (no strip, no validation); NULL and '' dropped."""
    parts = F.split(col(codes), re.escape(sep))
    return F.filter(parts, lambda x: x.isNotNull() & (x != ""))


def all_codes_valid(codes, pattern: str = CODE_STRICT, sep: str = CODE_SEPARATOR) -> Column:
    """True when every piece of the set is well formed (an empty set is valid)."""
    return F.forall(code_pieces(codes, sep), lambda x: x.rlike(pattern))
