"""Reading the input tables (one Parquet dataset per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


def row_groups(df: DataFrame, enough: int) -> int:
    """Row groups of the Parquet files that ``df`` scans, counted up to ``enough``.

    Every file with rows has at least one, so only the footers of fewer than
    ``enough`` files are read, on the driver, through Spark's file systems.
    """
    files = df.inputFiles()
    if len(files) >= enough:
        return len(files)
    spark = df.sparkSession
    hadoop, parquet = spark._jvm.org.apache.hadoop, spark._jvm.org.apache.parquet.hadoop
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    n = 0
    for name in files:
        path = hadoop.fs.Path(hadoop.fs.Path(name).toUri()) if "%" not in name else hadoop.fs.Path(spark._jvm.java.net.URI(name))
        reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(path, conf))
        try:
            n += reader.getRowGroups().size()
        finally:
            reader.close()
    return n


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal out a scan with fewer row groups than the session has cores by ``key``.

    CPU-heavy row work (regexes over long texts) should use every core, and a
    task reads whole row groups: a scan may be cut into more byte ranges than
    it has row groups, but the others are empty. A table of enough row groups
    is left alone: its texts are not shuffled. Of a frame that is not a scan the
    partitions count. No job runs.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if (row_groups(df, cores) or df.rdd.getNumPartitions()) < cores:
        return df.repartition(cores, key)
    return df
