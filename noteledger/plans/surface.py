"""Queries over sources and sinks, the SQL functions and the text vectors, with their SQL twins.

The round trips write a table, or records made from one, to a folder of its own below
``spark.checkpoint.dir`` and read it back with the library's readers.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import labels as L
from ..operators import reports as R
from ..operators import scoring as S
from ..operators import text_vectors as TV
from ..operators import vectorize as V
from ..session import ensure_checkpoint_dir, materialize
from ..sources import files as FI
from ..sources import roles
from ..sources import sql as SQ
from ..sources.tables import read_table, spread
from .catalog import RECORD_LEN_COLS, RULE_COLUMNS, q_category_distribution, q_dataset_metrics
from .oracle import SQL as CATALOG_SQL
from .oracle import clean_sql

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# -- sources and sinks ------------------------------------------------------


def q_csv_records(spark, d):
    """Documents written as CSV records and read back: quotes, separators and line breaks inside texts survive."""
    path = _folder(spark, "csv")
    FI.write_records_csv(read_table(spark, d, "documents").select(*DOCUMENT.names), path)
    return FI.read_csv(spark, path, DOCUMENT)


def q_upload_ids(spark, d):
    """Default ids of an upload in several files: the n-th record in file order is Patient_n."""
    path = _folder(spark, "upload")
    docs = read_table(spark, d, "documents").select("doc_id", F.col("text").alias("clinical_notes"))
    FI.write_records_csv(docs.repartitionByRange(7, "doc_id").sortWithinPartitions("doc_id").drop("doc_id"), path)
    up = FI.read_upload(spark, path)
    return up.select("patient_id", F.length("doctor_notes").alias("note_chars"))


def q_malformed_upload(spark, d):
    """An upload in which every tenth record has fields too many: each record has a row and a status."""
    path = _folder(spark, "broken")
    note = F.concat("lang", F.lit("-"), F.col("n_chars").cast("string"))
    broken = F.when(F.col("doc_id") % 10 == 0, F.concat(note, F.lit(",one,two,three,four"))).otherwise(note)
    rows = read_table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("patient_id"), broken.alias("doctor_notes"), (F.col("n_chars") % 90).cast("string").alias("age"))
    # without quotes, so that separators inside a note cut the record
    rows.write.option("header", True).option("quote", "\u0000").csv(path)
    up = FI.read_upload(spark, path, multi_line=False, malformed=True)
    share = F.col("age") / 90
    wide = up.select(F.col("patient_id").alias("row_id"), F.array(share, 1 - share).alias("scores"), FI.MALFORMED)
    return S.batch_scores(wide, ["A00", "B01"], malformed=FI.MALFORMED).select("patient_id", "top_prediction", "status")


def q_parquet_split(spark, d):
    """Documents written in a folder per language and read back."""
    path = _folder(spark, "parquet")
    FI.write_parquet(read_table(spark, d, "documents").select("doc_id", "n_chars", "lang"), path, ["lang"])
    return FI.read_parquet(spark, path).groupBy("lang").agg(F.count(F.lit(1)).alias("records"), F.sum("n_chars").alias("chars"), F.max("doc_id").alias("last_id"))


def q_report_csv(spark, d):
    path = _folder(spark, "report")
    report = q_category_distribution(spark, d)
    FI.write_report_csv(report, path)
    return FI.read_csv(spark, path, report.schema)


def q_json_document(spark, d):
    path = _folder(spark, "json")
    document = q_dataset_metrics(spark, d)
    FI.write_json_document(document, path)
    return spark.read.schema(document.schema).json(path)


def q_literal_names(spark, d):
    """Literal rows as a lookup: records per language name."""
    names = FI.literal_rows(spark, [("en", "English"), ("fr", "French"), ("de", "German"), ("es", "Spanish")],
                            T.StructType([T.StructField("lang", T.StringType()), T.StructField("language", T.StringType())]))
    return read_table(spark, d, "documents").join(names, "lang", "left").groupBy("language").agg(F.count(F.lit(1)).alias("records"))


def q_value_rows(spark, d):
    """Value lists of records as rows."""
    return R.value_rows(roles.records(spark, d, ["category", "code", "age"]), {"category": "category", "code": "code", "age": "age"})


def q_label_vectors(spark, d):
    """The label matrix as sparse vectors: indexes of the ones of each order, from the vector itself."""
    v = materialize(roles.visits(spark, d, ["record_id", "codes"]))
    vectors = L.label_vectors(v, L.code_dictionary(v))
    held = F.unwrap_udt("label_vector")
    return vectors.select("record_id", held["size"].alias("width"), F.size(held["indices"]).alias("n_labels"),
                          F.array_join(F.transform(held["indices"], lambda i: i.cast("string")), ",").alias("label_indexes"))


# -- reports and cleaners as SQL --------------------------------------------


def _registered(spark: SparkSession, d: str) -> None:
    FI.register_view(roles.records(spark, d, RULE_COLUMNS), "validation_records")
    SQ.register_reports(spark, "validation_records", RECORD_LEN_COLS)


def _sql_report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        _registered(spark, d)
        return SQ.run_report(spark, name)

    return query


def q_sql_clean_text(spark, d):
    SQ.register_functions(spark)
    FI.register_view(spread(read_table(spark, d, "documents").select("doc_id", "text"), "doc_id"), "notes")
    return spark.sql("SELECT doc_id, clean_note(text) AS cleaned, length(clean_note(text)) AS note_length FROM notes")


def q_sql_code_parse(spark, d):
    SQ.register_functions(spark)
    FI.register_view(roles.visits(spark, d, ["record_id", "codes"]), "visits")
    return spark.sql("SELECT record_id, size(parse_codes(codes)) AS n_valid, array_join(parse_codes(codes), '|') AS valid_codes FROM visits")


# -- text vectors -----------------------------------------------------------


def _word_table(spark, d):
    tokens = materialize(V.token_frame(spread(read_table(spark, d, "documents"), "doc_id"), "doc_id", "text").select("doc_id", F.slice(F.filter("filtered", lambda t: t != ""), 1, TV.MAX_TOKENS).alias("filtered")))
    return tokens, materialize(TV.word_vectors(tokens, "filtered"))


def _shown(vector: str):
    return F.array_join(F.transform(vector, lambda x: x.cast("string")), ",").alias("vector")


def q_text_vectors_mean(spark, d):
    tokens, words = _word_table(spark, d)
    return TV.mean_vectors(tokens, "doc_id", "filtered", words).select("doc_id", "n_tokens", _shown("vector"))


def q_text_vectors_first(spark, d):
    tokens, words = _word_table(spark, d)
    return TV.first_vectors(tokens, "doc_id", "filtered", words).select("doc_id", "word", _shown("vector"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn) and fn.__module__ == __name__
} | {f"sql_{name}": _sql_report(f"report_{name}") for name in ("quality", "metadata", "missing", "violations", "issues", "ages", "stays", "prefixes", "categories")}


# -- SQL twins --------------------------------------------------------------

SQL: dict[str, str] = {
    "csv_records": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "upload_ids": "SELECT 'Patient_' || row_number() OVER (ORDER BY doc_id) AS patient_id, length(text)::INTEGER AS note_chars FROM documents",
    "malformed_upload": """SELECT doc_id::VARCHAR AS patient_id,
  CASE WHEN doc_id % 10 = 0 THEN 'ERROR' WHEN 2 * (n_chars % 90) >= 90 THEN 'A00' ELSE 'B01' END AS top_prediction,
  CASE WHEN doc_id % 10 = 0 THEN 'Error' ELSE 'Success' END AS status
FROM documents""",
    "parquet_split": "SELECT lang, count(*) AS records, sum(n_chars)::BIGINT AS chars, max(doc_id) AS last_id FROM documents GROUP BY lang",
    "report_csv": CATALOG_SQL["category_distribution"],
    "json_document": CATALOG_SQL["dataset_metrics"],
    "literal_names": "SELECT CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish' END AS language, count(*) AS records FROM documents GROUP BY 1",
    "sql_clean_text": f"SELECT doc_id, {clean_sql('text')} AS cleaned, length({clean_sql('text')})::INTEGER AS note_length FROM documents",
    "sql_code_parse": "SELECT record_id, n_valid, valid_codes FROM (" + CATALOG_SQL["code_parse"] + ")",
    "sql_quality": CATALOG_SQL["quality_summary"],
    "sql_metadata": CATALOG_SQL["report_metadata"],
    "sql_violations": CATALOG_SQL["rule_violations"],
    "sql_prefixes": CATALOG_SQL["prefix_distribution"],
}

_RECORDS = """d.doc_id AS record_id, floor(c.c_acctbal / 100)::INTEGER AS age, d.lang AS category, length(trim(d.text)) AS note_len,
    upper(substr(p.p_type, 1, 1)) || substr(p.p_brand, 7) || '.' || (p.p_size % 10)::VARCHAR AS code, p.p_size AS stay
  FROM documents d LEFT JOIN part p ON p.p_partkey = d.doc_id LEFT JOIN customer c ON c.c_custkey = d.doc_id"""


def _grouped(section: str, name: str, key: str) -> str:
    return f"""WITH r AS (SELECT {_RECORDS}), g AS (SELECT {key} AS {name}, count(*) AS n FROM r GROUP BY 1)
SELECT '{section}' AS report_section, {name}, n AS count, round(n::DOUBLE * 100.0 / (SELECT count(*) FROM r), 2) AS percentage FROM g"""


SQL["label_vectors"] = f"""WITH pairs AS ({CATALOG_SQL["label_pairs"]}), width AS (SELECT count(DISTINCT code)::INTEGER AS n FROM pairs)
SELECT o.o_orderkey AS record_id, (SELECT n FROM width) AS width, count(p.code_index)::INTEGER AS n_labels,
  coalesce(string_agg(p.code_index::VARCHAR, ',' ORDER BY p.code_index), '') AS label_indexes
FROM orders o LEFT JOIN pairs p ON p.record_id = o.o_orderkey GROUP BY o.o_orderkey"""
SQL["value_rows"] = f"""WITH r AS (SELECT {_RECORDS}),
t AS (SELECT unnest(['category', 'code', 'age']) AS field, unnest([category, code, age::VARCHAR]) AS value FROM r)
SELECT field, value, count(*) AS count FROM t GROUP BY ALL"""
SQL["sql_ages"] = _grouped("Age Distribution", "age_group_name", "CASE WHEN age < 18 THEN 'Under 18' WHEN age <= 30 THEN '18-30' WHEN age <= 50 THEN '31-50' WHEN age <= 70 THEN '51-70' WHEN age > 70 THEN 'Over 70' ELSE 'Unknown' END")
SQL["sql_stays"] = _grouped("Length of Stay Distribution", "los_group", "CASE WHEN stay <= 1 THEN '1 day or less' WHEN stay <= 7 THEN '2-7 days' WHEN stay <= 14 THEN '8-14 days' WHEN stay <= 30 THEN '15-30 days' WHEN stay > 30 THEN 'Over 30 days' ELSE 'Unknown' END")
SQL["sql_categories"] = _grouped("Category Distribution", "category", "category")
SQL["sql_missing"] = f"""WITH r AS (SELECT {_RECORDS}), t AS (
  SELECT unnest(['record_id', 'age', 'category', 'note_len', 'code', 'stay']) AS field_name,
    unnest([count_if(record_id IS NULL), count_if(age IS NULL), count_if(category IS NULL), count_if(note_len IS NULL), count_if(code IS NULL), count_if(stay IS NULL)])::BIGINT AS invalid_count, count(*) AS n FROM r)
SELECT 'Missing Values' AS metric_category, field_name, invalid_count, round(invalid_count::DOUBLE * 100.0 / n, 2) AS error_percentage FROM t"""
SQL["sql_issues"] = "SELECT validation_issue, count(*) AS count FROM (" + CATALOG_SQL["invalid_records"].replace("ORDER BY validation_issue, record_id", "") + ") GROUP BY 1"

_VECTORS = r"""toks AS (
  SELECT doc_id, [t for t in string_split_regex(lower({clean}), '\s') if t <> '' AND NOT list_contains({stops}, t)][1:512] AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM toks
), near AS (
  SELECT w[i] AS word, [('0x' || md5(c)[1:4])::INTEGER for c in list_concat(w[greatest(i - 2, 1):i - 1], w[i + 1:i + 2])] AS h FROM places
), sums AS (
  SELECT word, count(*) AS n, sum(len(h)) AS known, [{minus}] AS m FROM near GROUP BY word
), vectors AS (
  SELECT word, [floor((known - 2 * x)::DOUBLE * 1000000 / n)::BIGINT for x in m] AS vector FROM sums
)"""


def _vectors() -> str:
    from ..functions.patterns import STOP_WORDS

    minus = ", ".join(f"coalesce(sum(list_sum([(x >> {j}) & 1 for x in h])), 0)" for j in range(TV.DIMS))
    return _VECTORS.replace("{clean}", clean_sql("text")).replace("{stops}", str(STOP_WORDS)).replace("{minus}", minus)


SQL["text_vectors_mean"] = f"""WITH {_vectors()}, words AS (
  SELECT doc_id, w[i] AS word FROM places
), summed AS (
  SELECT t.doc_id, count(v.word) AS n_tokens, [{", ".join(f"coalesce(sum(v.vector[{j + 1}]), 0)" for j in range(TV.DIMS))}] AS s
  FROM toks t LEFT JOIN words x ON x.doc_id = t.doc_id LEFT JOIN vectors v ON v.word = x.word GROUP BY t.doc_id
)
SELECT doc_id, n_tokens, array_to_string([floor(x::DOUBLE / greatest(n_tokens, 1))::BIGINT for x in s], ',') AS vector FROM summed"""
SQL["text_vectors_first"] = f"""WITH {_vectors()}
SELECT t.doc_id, t.w[1] AS word, array_to_string(coalesce(v.vector, [{", ".join(["0"] * TV.DIMS)}]), ',') AS vector
FROM toks t LEFT JOIN vectors v ON v.word = t.w[1]"""
