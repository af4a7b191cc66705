"""Training-data pipeline over ``documents``; each stage calls one operator of ``noteledger.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again before the next. All but the last keep the columns of
documents (and any others that docs has).

1. quality: documents that the classifier rejects go. It is fitted on labels
   of the documents it is given.
2. near duplicates: of each group linked by 5-word shingles at a similarity
   of 0.8 or more, the document with the smallest doc_id stays. Of several
   rows with that id and equal texts one stays; documents without words are
   linked with nothing and stay.
3. repeated passages: bytes covered by strings of ``PASSAGE_BYTES`` bytes that
   also start in another text go, if they form a run of at least ``PASSAGE_WORDS``
   words; the text is what is left of it, n_chars its new length. Fifty words are
   longer than such a string, so every window of a shared passage is found; what
   a document repeats only within itself, and shorter shared runs, stay.
4. packing: pieces of all documents in sequences of 1,024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteledger.llm import minhash, packing, quality, suffix_dedup
from noteledger.llm.common import stored
from noteledger.llm.queries import vocabulary

PASSAGE_WORDS = 50
PASSAGE_BYTES = 240


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit_quality(docs.select("doc_id", "text"), labels)
    return docs.where(quality.score_udf(model)(F.col("text")) >= 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, k=5, numerator=80, denominator=100)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(docs, length=PASSAGE_BYTES, across=True, least_words=PASSAGE_WORDS).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), capacity=1024)


STAGES = [
    ("quality classifier", drop_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeated_passages),
    ("packing", pack_sequences),
]

#: The classifier, the token ids and the packing have no SQL form; the tests check each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
