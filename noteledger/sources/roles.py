"""Role frames: the record tables the operators expect, derived with Spark
from the input tables.

The input tables carry no clinical columns, so each role maps existing
columns onto the shape the reports and label operators work on. Every role
is a lazy plan over the full tables; Catalyst prunes whatever a query does
not use.

``records`` (one code per record, validation-report shape)
    documents LEFT JOIN labels, part and customer on the record key.
    record_id = doc_id, note = text, category = lang,
    code = type initial + brand number + '.' + (size mod 10),
    stay = p_size, age = floor(c_acctbal / 100), quality/toxic from labels
    (NULL for unlabelled documents).

``visits`` (a code set per record, raw-record shape)
    orders LEFT JOIN customer LEFT JOIN the order's code set.
    A code set is the sorted distinct part codes of an order's line items
    (type initial + brand number), joined by '|'; orders without line items
    have NULL. age = floor(c_acctbal / 100), gender = c_mktsegment.

``scored_rows`` (per row: a score array and a truth array)
    embeddings: label k = 0..n-1 has score round(sigmoid(8 * embedding[k]), 6)
    and truth (label = k); label names are letter k + two-digit k.

``severity``: events.value / 50.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_ws
from .tables import read_table, spread


def part_code() -> Column:
    """Label code of a part: first letter of its type and its brand number."""
    return F.concat(F.upper(F.substr(F.col("p_type"), F.lit(1), F.lit(1))), F.substr(F.col("p_brand"), F.lit(7)))


def record_code() -> Column:
    """Single code of a record (validation-report form, with a dot part)."""
    return F.concat(part_code(), F.lit("."), (F.col("p_size") % 10).cast("string"))


def age_of_balance(c: str = "c_acctbal") -> Column:
    return F.floor(F.col(c) / 100).cast("int")


RECORD_COLUMNS = ["record_id", "age", "category", "note", "note_len", "note_strip_len", "note_chars", "code", "stay",
                  "quality", "toxic"]


def records(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """The ``columns`` asked for, of ``RECORD_COLUMNS``; only the tables they
    come from are read and joined.

    note is the text; note_len = length(trim), note_strip_len = length(strip)
    and note_chars = length stand for it in rules, computed before the joins so
    that a shuffle carries integers instead of texts. All joins are on the
    record key: the documents side is partitioned by it once, and AQE
    broadcasts the other side when it turns out small.
    """
    unknown = set(columns) - set(RECORD_COLUMNS)
    if unknown:
        raise ValueError(f"no record columns: {sorted(unknown)}")
    t = F.col("text")
    of_docs = {"record_id": F.col("doc_id"), "category": F.col("lang"), "note": t, "note_len": F.length(F.trim(t)),
               "note_strip_len": F.length(strip_ws(t)), "note_chars": F.length(t)}
    docs = read_table(spark, sf_dir, "documents")
    if any(c.startswith("note") for c in columns):
        docs = spread(docs, "doc_id")
    out = docs.select(F.col("doc_id").alias("_key"), *(v.alias(k) for k, v in of_docs.items() if k in columns))
    joined = [
        (["quality", "toxic"], lambda: read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id"),
        (["code", "stay"], lambda: read_table(spark, sf_dir, "part").select(
            "p_partkey", record_code().alias("code"), F.col("p_size").alias("stay")), "p_partkey"),
        (["age"], lambda: read_table(spark, sf_dir, "customer").select("c_custkey", age_of_balance().alias("age")), "c_custkey"),
    ]
    for names, table, key in joined:
        if set(names) & set(columns):
            side = table()
            out = out.join(side, F.col("_key") == F.col(key), "left")
    return out.select(*columns)


def code_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, codes): one row per order that has line items.

    collect_set runs partially on the map side and its buffer is bounded by
    the number of distinct codes, so a huge order cannot blow up one task.
    """
    part = read_table(spark, sf_dir, "part").select("p_partkey", part_code().alias("code"))
    # hash-partitioned by order key when the scan is narrow: the aggregation
    # below then reuses that partitioning (no second shuffle)
    items = spread(read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), "l_orderkey")
    return (items.join(part, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("l_orderkey")
            .agg(F.array_join(F.array_sort(F.collect_set("code")), "|").alias("codes")))


VISIT_COLUMNS = ["record_id", "age", "gender", "visit_date", "codes", "note_chars"]


def visits(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """The ``columns`` asked for, of ``VISIT_COLUMNS``; only the tables they
    come from are read and joined. note_chars is NULL when there is no note."""
    unknown = set(columns) - set(VISIT_COLUMNS)
    if unknown:
        raise ValueError(f"no visit columns: {sorted(unknown)}")
    out = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderkey").alias("record_id"), F.to_date("o_orderdate").alias("visit_date"))
    if "codes" in columns:
        out = out.join(code_sets(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    if "note_chars" in columns:
        # only the note's length crosses the shuffle
        docs = read_table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("note_chars"))
        out = out.join(docs, F.col("o_orderkey") == F.col("doc_id"), "left")
    if {"age", "gender"} & set(columns):
        cust = read_table(spark, sf_dir, "customer").select(
            "c_custkey", age_of_balance().alias("age"), F.col("c_mktsegment").alias("gender"))
        out = out.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    return out.select(*columns)


def label_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of labels of the embeddings table: the largest label plus 1 (one
    aggregate over the label column; the scored role is that wide)."""
    top = read_table(spark, sf_dir, "embeddings").agg(F.max("label")).first()[0]
    return 0 if top is None else int(top) + 1


def label_codes(n_labels: int) -> list[str]:
    """Names of the score labels: letter k and two-digit k (A00, B01, ...)."""
    return [chr(65 + k % 26) + f"{k:02d}" for k in range(n_labels)]


def truth_array(label: str, n_labels: int) -> Column:
    """0/1 per label k = 0..n_labels-1."""
    return F.transform(F.sequence(F.lit(1), F.lit(n_labels)), lambda k: (F.col(label) == k - 1).cast("int"))


def scored_rows(spark: SparkSession, sf_dir: str, n_labels: int) -> DataFrame:
    """Wide form (row_id, scores array<double>, y_true array<int>), the shape
    a Spark ML probability vector has after ``vector_to_array``.

    score of label k = round(1 / (1 + exp(-8 * embedding[k])), 6);
    truth of label k = (label = k).
    """
    emb = read_table(spark, sf_dir, "embeddings")
    sig = F.transform(
        F.slice("embedding", 1, n_labels),
        lambda v: F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-8.0) * v.cast("double"))), 6))
    return emb.select(F.col("vec_id").alias("row_id"), sig.alias("scores"), truth_array("label", n_labels).alias("y_true"))


def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", (F.col("value") / 50).alias("severity_score"))
