"""Exact global ranks and running sums without a single-partition window.

``row_number() OVER (ORDER BY k)`` and ``sum() OVER (ORDER BY k)`` without a
PARTITION BY run in one task. Here the ordering key is cut into buckets that
are monotone in the key (a prefix of a hash, or ranges found by Spark):

1. count / sum per bucket: a tiny aggregate (partial aggregation map-side);
2. offsets per bucket by a window over that tiny table;
3. the exact window inside each bucket, partitioned by the bucket;
4. rank = offset + rank inside the bucket.

Step 3 is spread over all buckets, so the work is split however large the
input is. The offset table has (groups x buckets) rows, independent of the
row count; it is joined without a hint, so AQE broadcasts it when it is
small and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def seeded_hash(key, seed: int) -> Column:
    """Hex md5 of 'seed:key'; the same in Spark and in any SQL engine."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def exact_rank(df: DataFrame, hash_col: str, tie_col: str, partition_cols: list[str] | None = None,
               prefix_len: int = 4, out: str = "rank") -> DataFrame:
    """1-based ``row_number() over (partition by P order by hash_col, tie_col)``.

    ``hash_col`` must be a string whose first ``prefix_len`` characters are a
    bucket monotone in the order: a hex hash (:func:`seeded_hash`) gives
    16**prefix_len evenly filled buckets. With the default 4 (65,536
    buckets) a window partition holds about 1.5 million rows at 10**11 rows,
    and the offset table stays about 1 MB.
    """
    parts = list(partition_cols or [])
    b = df.withColumn("_bucket", F.substring(F.col(hash_col), 1, prefix_len))
    counts = b.groupBy(*parts, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*parts).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*parts, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(*parts, "_bucket").orderBy(hash_col, tie_col)
    ranked = b.withColumn("_local", F.row_number().over(inner))
    return (ranked.join(offsets, parts + ["_bucket"])
            .withColumn(out, F.col("_off") + F.col("_local"))
            .drop("_bucket", "_off", "_local"))


def running_totals(df: DataFrame, order_col: str, values: list[str],
                   partition_cols: list[str] | None = None, prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``values`` ordered by the number ``order_col``
    (unique within each partition group).

    The rows are dealt out by ranges of (group, number), as many as the session
    has shuffle partitions, and written, so a row stays in its range. A range's
    sums are one row per group in it; their running sums are the offsets of the
    sums inside the range.
    """
    parts = list(partition_cols or [])
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(df.repartitionByRange(n, *parts, order_col).withColumn("_range", F.spark_partition_id()))
    totals = placed.groupBy(*parts, "_range").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    before = Window.partitionBy(*parts).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*parts, "_range",
                            *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}")
                              for v in values])
    inner = (Window.partitionBy(*parts, "_range").orderBy(order_col)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = placed.join(offsets, parts + ["_range"])
    return out.select(*df.columns, *[(F.col(f"_o_{v}") + F.sum(v).over(inner)).alias(prefix + v) for v in values])


def row_index(df: DataFrame, out: str = "row_index") -> DataFrame:
    """0-based position of each row in the frame's current order, without
    moving all rows into one task. For a plain scan of one file that is file
    order; Spark orders several files by size, so their rows follow no file order.

    Per-partition counts (one row per partition) give offsets; the position
    inside a partition comes from ``monotonically_increasing_id``. The frame
    is checkpointed first so both uses see the same partitioning, also after
    an executor loss.
    """
    m = materialize(df.withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_mid"), 33)
    counts = m.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a bounded table, safe to broadcast
    offsets = F.broadcast(counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    local = F.col("_mid") - F.shiftleft(F.col("_p"), 33)
    return (m.withColumn("_p", part).join(offsets, "_p")
            .withColumn(out, F.col("_off") + local)
            .drop("_p", "_off", "_mid"))


def file_row_index(scan: DataFrame, columns: list[Column], out: str = "row_index") -> DataFrame:
    """0-based position of each row of a file scan: files in the order of their paths, rows in the files' order.

    Spark deals out files by size, and cuts large ones; a piece of a file is read in
    order by one task. Pieces are counted (a row per piece), and the rows of
    the pieces before give a piece's offset.
    """
    m = materialize(scan.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                                F.monotonically_increasing_id().alias("_mid")))
    pieces = m.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("_file", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
    return m.join(offsets, ["_file", "_start"]).withColumn(out, F.col("_mid") + F.col("_off")).drop("_file", "_start", "_mid", "_off")
