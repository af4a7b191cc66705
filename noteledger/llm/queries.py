"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteledger.llm import class_lm, collocations, minhash, packing, quality, sentencepiece_lattice, sharding, spelling, suffix_dedup, topk, url_filter, warc, winnowing
from noteledger.llm.common import checkpoint
from noteledger.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
]


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), capacity=1024)


def op4_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_slots(read_table(spark, sf_dir, "documents"), n=16)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(read_table(spark, sf_dir, "documents"), length=400)


def op3_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read_table(spark, sf_dir, "documents"), k=3, numerator=85, denominator=100)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op7_sentencepiece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_lattice.Pieces(vocabulary("piece_bpe_32k.model"))
    return sentencepiece_lattice.coded_documents(read_table(spark, sf_dir, "documents"), pieces)


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.pmod("vec_id", F.lit(50)) == 0, k=5)


def op9_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = checkpoint(warc.write_warc(read_table(spark, sf_dir, "pages"), warc.warc_folder(spark)))
    return warc.read_warc(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"), min_count=100, top=2000)


def op12_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.language_model_scores(read_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_additive_quality": op1_additive_quality,
    "op5_differencing_packing": op5_differencing_packing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_bayes_minhash": op3_bayes_minhash,
    "op4_minimax_shards": op4_minimax_shards,
    "op6_winnowing": op6_winnowing,
    "op7_sentencepiece_lattice": op7_sentencepiece_lattice,
    "op8_exact_topk": op8_exact_topk,
    "op9_warc_zstd": op9_warc_zstd,
    "op10_bloom_cascade": op10_bloom_cascade,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_class_lm": op12_class_lm,
    "op13_spelling_variants": op13_spelling_variants,
}
