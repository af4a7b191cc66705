"""Run-metrics table: params, metrics and tags of runs in one long table.

Schema ``(run_id, kind, key, value, num, step)``: ``kind`` is param, metric or
tag; params and tags carry ``value`` (string), metrics carry ``num``
(double); step orders entries of one key. Appending replaces the entries it repeats; queries are filters, top-k and
pivots over the long table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("num", T.DoubleType()),
    T.StructField("step", T.LongType()),
])

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def run_rows(spark: SparkSession, run_id: str, params: dict | None = None, metrics: dict | None = None,
             tags: dict | None = None, step: int = 0) -> DataFrame:
    """One run's entries as rows of the run table (a handful of driver values);
    ``step`` orders entries of one key."""
    rows = [(run_id, "param", str(k), str(v), None, step) for k, v in (params or {}).items()]
    rows += [(run_id, "metric", str(k), None, float(v), step) for k, v in (metrics or {}).items()]
    rows += [(run_id, "tag", str(k), str(v), None, step) for k, v in (tags or {}).items()]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def runs_exist(spark: SparkSession, path: str) -> bool:
    """Whether there is a run table at ``path``, on whatever file system that is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def append_runs(runs: DataFrame, path: str) -> None:
    """Put entries into the run table at ``path``; an entry (run, step, kind, key) that is there already is replaced.

    The table is partitioned by run and step, and only the partitions of the new
    entries are written, in one dynamic overwrite: a repeated append leaves one
    copy, and one that fails half-way can be repeated.
    """
    spark = runs.sparkSession
    entry, place = ["run_id", "step", "kind", "key"], ["run_id", "step"]
    rows = materialize(runs.select(*[f.name for f in RUN_SCHEMA.fields]))
    # of an entry given twice the larger value counts, as when it is read
    rows = rows.groupBy(*entry).agg(F.max(F.struct("num", "value")).alias("_v")).select("run_id", "kind", "key", "_v.value", "_v.num", "step")
    if runs_exist(spark, path):
        touched, new = rows.select(*place).distinct(), rows.select(*entry)
        held = read_runs(spark, path)
        same = lambda a, b, on: [a[c].eqNullSafe(b[c]) for c in on]
        held = held.join(touched, same(held, touched, place), "left_semi")
        held = held.join(new, same(held, new, entry), "left_anti")
        rows = materialize(held.unionByName(rows))
    rows.repartition(*place).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*place).parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path).select(*[f.name for f in RUN_SCHEMA.fields])


def metrics_long(df: DataFrame, run_col: str, metric_cols: list[str]) -> DataFrame:
    """Unpivot per-run metric columns into metric rows."""
    casted = df.select(F.col(run_col).cast("string").alias("run_id"),
                       *[F.col(c).cast("double").alias(c) for c in metric_cols])
    long = casted.unpivot(["run_id"], metric_cols, "key", "num")
    return long.select("run_id", F.lit("metric").alias("kind"), "key",
                       F.lit(None).cast("string").alias("value"), "num", F.lit(0).cast("long").alias("step"))


def flatten_numeric(df: DataFrame, id_col: str, struct_col: str, prefix: str) -> DataFrame:
    """Numeric fields of a nested report as metric rows named
    ``{prefix}_{field}`` and ``{prefix}_{field}_{sub}``; other fields skipped.
    Only the schema is read on the driver."""
    fields = df.schema[struct_col].dataType.fields
    pairs = []
    for f in fields:
        if isinstance(f.dataType, NUMERIC):
            pairs.append((f"{prefix}_{f.name}", F.col(f"{struct_col}.{f.name}")))
        elif isinstance(f.dataType, T.StructType):
            for s in f.dataType.fields:
                if isinstance(s.dataType, NUMERIC):
                    pairs.append((f"{prefix}_{f.name}_{s.name}", F.col(f"{struct_col}.{f.name}.{s.name}")))
    arr = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("double").alias("num")) for k, v in pairs])
    return (df.select(F.col(id_col).cast("string").alias("run_id"), F.explode(arr).alias("e"))
            .select("run_id", F.lit("metric").alias("kind"), F.col("e.key").alias("key"),
                    F.lit(None).cast("string").alias("value"), F.round(F.col("e.num"), 6).alias("num")))


def best_runs(runs: DataFrame, metric: str, k: int = 5) -> DataFrame:
    """Runs ordered by a metric, best first (ties by run id), top k."""
    m = runs.where((F.col("kind") == "metric") & (F.col("key") == metric) & F.col("num").isNotNull())
    return (m.orderBy(F.desc("num"), "run_id").limit(k)
            .select("run_id", F.lit(metric).alias("metric"), F.round("num", 6).alias("value")))


def compare_runs(runs: DataFrame, run_ids: list[str] | None, keys: list[str], params: list[str] = ()) -> DataFrame:
    """One row per run (the given ones, or all): one column per metric of
    ``keys`` and one per param of ``params``. Of an entry logged more than once
    the latest counts (by step, then the larger value)."""
    wanted = runs.where(F.col("kind").isin("metric", "param"))
    if run_ids is not None:
        wanted = wanted.where(F.col("run_id").isin(list(run_ids)))
    latest = lambda kind, key, value: F.max_by(
        F.when((F.col("kind") == kind) & (F.col("key") == key), F.col(value)),
        F.when((F.col("kind") == kind) & (F.col("key") == key), F.struct("step", value)))
    cols = [F.round(latest("metric", k, "num"), 6).alias(k) for k in keys]
    cols += [latest("param", k, "value").alias(k) for k in params]
    return wanted.groupBy("run_id").agg(*cols).orderBy("run_id")


def metrics_with_prefix(runs: DataFrame, prefix: str) -> DataFrame:
    m = runs.where((F.col("kind") == "metric") & F.col("key").startswith(prefix))
    return m.select("run_id", "key", F.round("num", 6).alias("num")).orderBy("run_id", "key")


def source_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document source as a run: metrics, the most frequent language as
    a param, and the input table as a tag."""
    from ..sources.tables import read_table

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = docs.join(labels, "doc_id", "left")
    per = j.groupBy("source").agg(
        F.count(F.lit(1)).alias("records"),
        F.round(F.avg("n_chars"), 6).alias("mean_chars"),
        F.round(F.avg(F.col("quality").isNotNull().cast("double")), 6).alias("labelled_share"),
        F.round(F.avg("quality"), 6).alias("quality_rate"),
        F.round(F.avg("toxic"), 6).alias("toxic_rate"),
    )
    metrics = metrics_long(per, "source", ["records", "mean_chars", "labelled_share", "quality_rate", "toxic_rate"])
    lang = (docs.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("source").agg(F.min_by("lang", F.struct((-F.col("n")).alias("o"), F.col("lang"))).alias("v")))
    params = lang.select(F.col("source").alias("run_id"), F.lit("param").alias("kind"),
                         F.lit("top_lang").alias("key"), F.col("v").alias("value"),
                         F.lit(None).cast("double").alias("num"), F.lit(0).cast("long").alias("step"))
    tags = per.select(F.col("source").alias("run_id"), F.lit("tag").alias("kind"), F.lit("table").alias("key"),
                      F.lit("documents").alias("value"), F.lit(None).cast("double").alias("num"),
                      F.lit(0).cast("long").alias("step"))
    return metrics.unionByName(params).unionByName(tags)


def source_quality_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested quality report per document source (input of flattening)."""
    from ..sources.tables import read_table

    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.length(F.trim("text")) >= 10).alias("valid"), "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = docs.join(labels, "doc_id", "left")
    per = j.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("valid").alias("valid_texts"),
        F.min("n_chars").alias("min_chars"),
        F.max("n_chars").alias("max_chars"),
        F.count_if(F.col("quality") == 1).alias("quality_1"),
        F.count_if(F.col("toxic") == 1).alias("toxic_1"),
        F.count(F.col("quality")).alias("labelled"),
    )
    report = F.struct(
        F.col("total_records"), F.col("valid_texts"),
        F.struct(F.col("min_chars").alias("min"), F.col("max_chars").alias("max")).alias("text_chars"),
        F.struct(F.col("quality_1").alias("quality"), F.col("toxic_1").alias("toxic"),
                 F.col("labelled")).alias("label_counts"),
        F.lit("documents").alias("table"),
    )
    return per.select(F.col("source").alias("run_id"), report.alias("report"))


def evaluation_run(long: DataFrame, run_id: str, code: str = "code") -> DataFrame:
    """An evaluation as metric rows: accuracy_{code} for labels with a
    positive, plus the element accuracy and Hamming loss."""
    eq = (F.col("y_true") == F.col("y_pred")).cast("double")
    per = long.groupBy(code).agg(F.avg(eq).alias("acc"), F.sum("y_true").alias("pos")).where(F.col("pos") > 0)
    label_rows = per.select(F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"),
                            F.concat(F.lit("accuracy_"), F.col(code)).alias("key"),
                            F.lit(None).cast("string").alias("value"), F.col("acc").alias("num"),
                            F.lit(0).cast("long").alias("step"))
    overall = long.agg(F.avg(eq).alias("overall_accuracy"), (1.0 - F.avg(eq)).alias("hamming_loss"))
    overall = overall.select(F.lit(run_id).alias("run_id"), "overall_accuracy", "hamming_loss")
    return label_rows.unionByName(metrics_long(overall, "run_id", ["overall_accuracy", "hamming_loss"]))


def confidence_series(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Average value per day, in time order."""
    return (df.groupBy(F.to_date(F.col(ts)).alias("day"))
            .agg(F.round(F.avg(value), 6).alias("avg_confidence"), F.count(F.lit(1)).alias("n"))
            .orderBy("day"))
