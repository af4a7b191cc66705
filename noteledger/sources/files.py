"""Readers and writers: CSV and Parquet record tables, report and metadata
sinks, literal rows, views, previews.

Schemas are declared, never inferred on the hot path (inference costs a full
extra pass over the input). Sinks write from the executors; nothing is
collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import file_row_index, row_index

# ---------------------------------------------------------------------------
# schemas

RAW_RECORDS = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("doctor_notes", T.StringType()),
    T.StructField("diagnosis_date", T.DateType()),
    T.StructField("icd10_codes", T.StringType()),
    T.StructField("icd10_codes_list", T.StringType()),
    T.StructField("medical_conditions", T.StringType()),
])

VALIDATION_RECORDS = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("diagnosis_text", T.StringType()),
    T.StructField("icd10_code", T.StringType()),
    T.StructField("admission_date", T.StringType()),
    T.StructField("discharge_date", T.StringType()),
    T.StructField("length_of_stay", T.IntegerType()),
    T.StructField("severity_score", T.DoubleType()),
])

CODE_MAPPING = T.StructType([
    T.StructField("icd10_code", T.StringType()),
    T.StructField("code_index", T.LongType()),
])

BATCH_PREDICTIONS = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("doctor_notes", T.StringType()),
    T.StructField("top_prediction", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("all_predictions", T.StringType()),
    T.StructField("status", T.StringType()),
])

REQUIRED_COLUMNS = ["patient_id", "age", "gender", "doctor_notes", "icd10_codes"]

# Column aliases of a scoring upload, first present wins.
UPLOAD_ALIASES = {
    "doctor_notes": ["doctor_notes", "clinical_notes"],
    "age": ["age", "patient_age"],
    "gender": ["gender", "patient_gender"],
}


# ---------------------------------------------------------------------------
# sources


MALFORMED = "_malformed"


def _csv(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = RAW_RECORDS,
             infer: bool = False, multi_line: bool = True, malformed: str | None = None) -> DataFrame:
    """CSV with a header. A declared schema by default; ``infer=True`` does
    what an inferred read does (one extra pass over the data). With
    ``multi_line`` quoted fields may hold line breaks and a file is one task;
    without it large files are split.

    Records that do not fit the schema are kept: what can be read of them is,
    the rest is NULL. With ``malformed`` such a record's text is in a column of
    that name, which is NULL for all others."""
    r = _csv(spark, multi_line)
    if infer or schema is None:
        return r.option("inferSchema", True).csv(path)
    if malformed:
        schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
        # without pruning: a reader of some columns only would not see that there are too many
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", malformed).option("columnPruning", False)
    return r.schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def missing_columns(df: DataFrame, required: list[str] = REQUIRED_COLUMNS) -> list[str]:
    """Required columns absent from the frame (empty when the check passes)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, required: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def _first_present(df: DataFrame, names: list[str]) -> Column:
    for n in names:
        if n in df.columns:
            return F.col(n)
    return F.lit(None)


def read_upload(spark: SparkSession, path: str, multi_line: bool = True, malformed: bool = False) -> DataFrame:
    """A scoring upload: every column read as text, aliases resolved, a
    default id ``Patient_{n}`` (1-based position, files in the order of their
    paths) when there is no ``patient_id`` column. With ``malformed`` records
    that do not fit the header are kept with their text in ``MALFORMED``, from
    which batch scoring makes error rows."""
    raw = _csv(spark, multi_line).csv(path)
    if malformed:
        raw = read_csv(spark, path, raw.schema, multi_line=multi_line, malformed=MALFORMED)
    return normalize_upload(raw)


def normalize_upload(raw: DataFrame) -> DataFrame:
    """Columns by their aliases, and default ids: in file order if ``raw`` is a scan, in the frame's order otherwise."""
    cols = {k: _first_present(raw, v) for k, v in UPLOAD_ALIASES.items()}
    kept = [MALFORMED] if MALFORMED in raw.columns else []
    if "patient_id" in raw.columns:
        base = raw.select(F.col("patient_id").cast("string").alias("patient_id"), *[c.alias(k) for k, c in cols.items()], *kept)
    else:
        wanted = [*[c.alias(k) for k, c in cols.items()], *kept]
        indexed = file_row_index(raw, wanted, "_pos") if raw.inputFiles() else row_index(raw.select(*wanted), "_pos")
        base = indexed.select(F.concat(F.lit("Patient_"), (F.col("_pos") + 1).cast("string")).alias("patient_id"),
                              *cols.keys(), *kept)
    return base.select("patient_id", F.col("doctor_notes").cast("string").alias("doctor_notes"),
                       F.col("age").try_cast("int").alias("age"), F.col("gender").cast("string").alias("gender"), *kept)


def literal_rows(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """Literal rows with an explicit schema (fixtures and small lookups)."""
    return spark.createDataFrame(rows, schema)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


# ---------------------------------------------------------------------------
# sinks


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_report_csv(df: DataFrame, path: str, single_file: bool = True) -> None:
    """A report as CSV with a header. Reports are aggregates (a few rows), so
    one output file is the default; pass ``single_file=False`` for record
    extracts, which stay as parallel as their input."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_records_csv(df: DataFrame, path: str) -> None:
    """Records as CSV; white space at the ends of values is kept."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_json_document(doc: DataFrame, path: str) -> None:
    """A one-row document (nested structs allowed) as JSON."""
    doc.coalesce(1).write.mode("overwrite").json(path)


def metadata_document(spark: SparkSession, parts: dict[str, DataFrame]) -> DataFrame:
    """Nest several one-row frames as struct fields of one row, using scalar
    subqueries (no join)."""
    cols = [F.struct(*[F.col(c) for c in p.columns]).alias("v") for p in parts.values()]
    return spark.range(1).select(*[p.select(c).scalar().alias(k) for (k, p), c in zip(parts.items(), cols)])


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
