"""Small helpers that the operators of this package share."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as WIN

from noteledger.session import ensure_checkpoint_dir

#: md5 stands for a text as key; a null text has a key that no text has
NULL_KEY = "null"
#: An executor holds a batch several times, in the JVM and in Python, for each of its tasks
BATCH_BYTES = "4m"


def checkpoint(df: DataFrame) -> DataFrame:
    """Eager checkpoint in the shared folder; cuts the lineage and fixes row order and ids."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table below the shared checkpoint folder and read back.

    For larger intermediate tables: unlike a checkpoint it is compressed, and
    readers take the columns they need. It stays until the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_light_batches(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``operator`` (of a frame), whose eager steps hand rows to Python in batches of about ``BATCH_BYTES``, whatever their number.

    The session's own setting, which may be sixteen times as large, holds again afterwards.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"

    @functools.wraps(operator)
    def call(frame: DataFrame, *args, **kwargs) -> DataFrame:
        conf = frame.sparkSession.conf
        before = conf.get(name)
        conf.set(name, BATCH_BYTES)
        try:
            return operator(frame, *args, **kwargs)
        finally:
            conf.set(name, before)

    return call


def text_key(text: Column) -> Column:
    """128-bit content key of a text (hex string); equal texts have equal keys."""
    return F.coalesce(F.md5(text), F.lit(NULL_KEY))


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def n_tasks(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the unit in which work is dealt out."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def number_within(df: DataFrame, group: str, name: str, order: list[str]) -> DataFrame:
    """Number rows 0, 1, 2, ... without gaps in each value of ``group`` (column ``name``).

    No task sees a whole group: rows are sorted inside their partitions and
    written once; a row's number is its place in the partition moved by the
    rows of its group in earlier partitions. The table of these moves has one
    row per (partition, group value) that occurs, so it is joined as any
    other table and Spark broadcasts it only below its own size limit.
    """
    placed = checkpoint(
        df.sortWithinPartitions(group, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.expr("shiftright(_at, 33)").cast("int"))
        .withColumn("_at", F.expr("_at & 8589934591L"))
    )
    in_part = WIN.Window.partitionBy("_part").orderBy(group).rowsBetween(WIN.Window.unboundedPreceding, -1)
    in_group = WIN.Window.partitionBy(group).orderBy("_part").rowsBetween(WIN.Window.unboundedPreceding, -1)
    moves = (
        placed.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_move", F.coalesce(F.sum("_n").over(in_group), F.lit(0)) - F.coalesce(F.sum("_n").over(in_part), F.lit(0)))
        .select(F.col("_part").alias("_mp"), F.col(group).alias("_mg"), "_move")
    )
    return (
        placed.join(moves, (F.col("_part") == F.col("_mp")) & (F.col(group) == F.col("_mg")))
        .withColumn(name, (F.col("_at") + F.col("_move")).cast("long"))
        .drop("_at", "_part", "_mp", "_mg", "_move")
    )


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of driver-side rows whose number the caller has bounded."""
    return spark.createDataFrame(rows, T._parse_datatype_string(schema))


def fresh(frame: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``frame`` has such a column."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
