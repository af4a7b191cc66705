"""Scale guards: no size limits, labels from the data, required folders."""

import pytest
from pyspark.sql import functions as F

from noteledger.operators import labels as L
from noteledger.operators import reports as R
from noteledger.plans.catalog import QUERIES
from noteledger.session import cluster_conf, ensure_checkpoint_dir, materialize
from noteledger.sources import roles
from noteledger.sources.tables import row_groups, spread


def test_spread_counts_row_groups(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    one, many = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, cores)
    assert spread(one, "id").rdd.getNumPartitions() == cores
    assert spread(many, "id") is many
    # one file of one row group, read as several byte ranges: all rows are in one of them
    spark.range(0, 50_000, 1, 1).write.parquet(str(tmp_path / "one"))
    few = spark.read.parquet(str(tmp_path / "one"))
    assert row_groups(few, cores) == 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    try:
        assert few.rdd.getNumPartitions() > 2
        dealt = spread(few, "id")
        assert dealt.select(F.spark_partition_id()).distinct().count() == cores
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    many.write.parquet(str(tmp_path / "many"))
    enough = spark.read.parquet(str(tmp_path / "many"))
    assert row_groups(enough, cores) == cores and spread(enough, "id") is enough


def test_one_hot_has_no_width_limit(spark):
    v = spark.createDataFrame([(1, "|".join(f"A{i:02d}" for i in range(90)))], "record_id long, codes string")
    row = L.one_hot_labels(v, L.code_dictionary(v)).first()
    assert row.labels == [1] * 90 and row.label_indexes == list(range(90))


def test_metadata_lists_every_category(spark):
    df = spark.createDataFrame([(i, 30, f"g{i:03d}", "I10", 5) for i in range(200)],
                               "record_id long, age int, gender string, codes string, note_chars int")
    row = R.dataset_metadata(df, note_length="note_chars").first()
    assert row.gender_distribution.count(":1") >= 200


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"
        getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda *a: None)})())

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_twelve_classes_are_all_scored(spark, tmp_path):
    rows = [(i, [0.1 * (i % 3)] * 16, i % 12) for i in range(48)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    d = str(tmp_path)
    assert roles.label_count(spark, d) == 12
    assert QUERIES["confusion"](spark, d).count() == 12
    counts = QUERIES["sparse_micro"](spark, d).first()
    assert counts.tp + counts.fn == 48 and counts.tp + counts.fp + counts.fn + counts.tn == 48 * 12
    assert {r.code for r in QUERIES["label_accuracy"](spark, d).collect()} == set(roles.label_codes(12))


def test_materialize_cuts_lineage(spark):
    df = materialize(spark.range(10).withColumn("x", F.col("id") * 2))
    assert "LogicalRDD" in df._jdf.queryExecution().analyzed().toString()
    assert df.agg(F.sum("x")).collect()[0][0] == 90


def test_cluster_conf_scales_with_input():
    small = cluster_conf(10 * 1024**2, 8)
    big = cluster_conf(100 * 1024**4, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
