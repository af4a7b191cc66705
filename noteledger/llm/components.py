"""Connected components of a link table by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteledger.llm.common import checkpoint


ROWS = 100_000  # of a partition of a table of links or labels


def n_parts(rows: int) -> int:
    """Partitions of a table that every round reads and shuffles: few for a small one, as each costs files and tasks."""
    return max(1, -(-rows // ROWS))


def components(links: DataFrame) -> DataFrame:
    """(id, comp) of every id in ``links`` (a, b); comp is the smallest id that can be reached.

    Each round every node takes the smallest label among its neighbours and
    then its label's label, and the labels are written; rounds go on until
    none changes. Stars, which near-copies give, take three.
    """
    # both directions of one frame: fresh columns, else Spark takes them for the same
    edges = checkpoint(links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).where("u <> v").distinct())
    parts = n_parts(edges.count())
    edges = edges.coalesce(parts)
    labels = checkpoint(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("comp")).coalesce(parts))
    while True:
        near = (
            edges.join(labels.select(F.col("id").alias("v"), F.col("comp").alias("c")), "v")
            .groupBy("u").agg(F.min("c").alias("c")).select(F.col("u").alias("id"), "c")
        )
        lower = labels.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "c").alias("comp"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("far"))
        moved = checkpoint(lower.join(jump, "comp").select("id", "old", F.least("comp", "far").alias("comp")).coalesce(parts))
        labels = moved.select("id", "comp")
        if moved.where("old <> comp").isEmpty():
            return labels


def roots(parents: DataFrame) -> DataFrame:
    """(id, comp) of the ids in a forest (a, b) where every b occurs once and a < b; comp is the tree's root.

    Pointers are doubled until none moves, which is cheaper than ``components``.
    """
    tops = parents.select(F.col("a").alias("id")).distinct().join(parents.select(F.col("b").alias("id")), "id", "left_anti")
    parts = n_parts(parents.count())
    labels = checkpoint(parents.select(F.col("b").alias("id"), F.col("a").alias("comp")).coalesce(parts))
    while True:
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("far"))
        moved = checkpoint(labels.join(jump, "comp", "left").select("id", F.coalesce("far", "comp").alias("comp"), F.col("far").isNotNull().alias("moved")).coalesce(parts))
        labels = moved.select("id", "comp")
        if moved.where("moved").isEmpty():
            return labels.unionByName(tops.select("id", F.col("id").alias("comp")))
