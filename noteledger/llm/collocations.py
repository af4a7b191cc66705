"""Phrase collocations by prefix-free parsing.

The words of a piece (text between two marks of punctuation or line ends) are
cut where their content says so: at every place whose window of ``max_words`` - 1
words hashes to 0 modulo ``PERIOD``. A chunk reaches from one such place over
the whole window at the next, so neighbours overlap by one window and no
phrase of up to ``max_words`` words is cut by all chunks. Equal stretches of text
are cut alike wherever they stand, so copies give equal chunks; the
dictionary holds each distinct chunk once, with its frequency in the parse.

Phrases are then counted inside the distinct chunks only, weighted by their
frequencies. A phrase belongs to the chunk in whose own part it starts; what
starts in the overlap belongs to the next chunk, and a piece's last chunk has no
overlap.

Lengths are counted one after the other. A phrase can only be as frequent as
the two phrases that lack its last or its first word, so a length is counted
only where both reached ``min_count``. Which did is told to the tasks by a bitmap
of ``BITS`` bits, whatever the size of the corpus: phrases that share a bit by
chance are counted in vain and fall to the exact count afterwards, and none
is lost.

A cut of a phrase a after its first k words into l and r scores
floor(1000 * a * n / (l * r)); the cut with the lowest score counts, of equal ones
the one with the smallest k. Products are decimals of 38 digits, which hold
for up to 10**17 words. A phrase is dropped if some longer candidate that
contains it has 100 * count >= ``absorbed`` * its own; one more word is enough to
look at, since counts never rise with the length.

Nulls: a null text has no words, a null language is ``und`` (as is the language
"und"). Empty texts and pieces without words add nothing. Words have no length
limit, and a piece without a cut is one chunk, at most as long as its text.
Repeated rows count each. Ties of the ranking are broken by the phrase's bytes,
so ranks are unique. An empty table gives no rows; columns other than the
text and the language are not read, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as WIN

from noteledger.llm import words as W
from noteledger.llm.common import checkpoint, stored

PERIOD = 32  # one place in so many starts a chunk
BITS = 1 << 26  # of the bitmap of frequent phrases, 8 MB
WORDS = 1 << 20  # words of the dictionary that are counted together

BREAK = b"."
_FROM = b".,;:!?\x0a\x0b\x0c\x0d\x09" + bytes(range(65, 91))
TABLE = bytes.maketrans(_FROM, BREAK * 10 + b" " + bytes(range(97, 123)))


def chunk_batch(langs: pa.Array, texts: pa.Array, overlap: int, period: int) -> pa.RecordBatch:
    """Chunks of a batch of texts: lang, chunk (words joined by spaces), last (it ends its piece)."""
    spaced = pc.replace_substring(W.translated(texts, TABLE), BREAK.decode(), f" {BREAK.decode()} ")
    distinct, ids, n = W.split_words(spaced)
    text_of = np.repeat(np.arange(len(n)), n)
    is_break = pc.equal(distinct, BREAK.decode()).to_numpy(zero_copy_only=False)[ids] if len(distinct) else np.zeros(0, bool)
    piece = (text_of + np.cumsum(is_break))[~is_break]  # grows from piece to piece
    ids, text_of = ids[~is_break], text_of[~is_break]
    size = len(ids)
    first = np.ones(size, bool)
    first[1:] = piece[1:] != piece[:-1]
    begins = np.flatnonzero(first)
    lengths = np.diff(np.append(begins, size))
    piece_end = np.repeat(begins + lengths, lengths)

    grams = W.gram_hashes(W.word_hashes(distinct)[ids], overlap) if overlap else np.zeros(size, np.uint64)
    place = np.arange(len(grams))
    cut = first.copy()
    cut[:len(grams)] |= (grams % np.uint64(period) == 0) & (place + overlap <= piece_end[:len(grams)])
    at = np.flatnonzero(cut)
    own = np.diff(np.append(at, size))
    last = np.ones(len(at), bool)
    last[:-1] = first[at[1:]]
    whole = own + np.where(last, 0, overlap)
    inside = np.arange(whole.sum()) - np.repeat(W.starts_of(whole) - at, whole)
    return pa.record_batch({
        "lang": langs.take(pa.array(text_of[at])).cast(pa.string()),
        "chunk": W.joined(distinct, ids[inside], whole),
        "last": pa.array(last),
    })


def parse(docs: DataFrame, lang: str = "lang", text: str = "text", max_words: int = 5, period: int = PERIOD) -> DataFrame:
    """The dictionary of the parse: lang, chunk, last, weight (its occurrences)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 1024):
                some = batch.slice(a, 1024)
                yield chunk_batch(pc.fill_null(some.column("lang"), "und"), some.column("text"), max_words - 1, period)

    narrow = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    chunks = narrow.mapInArrow(rows, "lang string, chunk string, last boolean")
    return chunks.groupBy("lang", "chunk", "last").agg(F.count(F.lit(1)).alias("weight"))


def _keyed(hashes: np.ndarray, lang: np.ndarray, bits: int) -> np.ndarray:
    """Bit of a phrase of a language."""
    return W.mixed(hashes * W.FOLD + lang) % np.uint64(bits)


def count_batch(batch: pa.RecordBatch, k: int, overlap: int, frequent: np.ndarray | None, bits: int) -> pa.RecordBatch:
    """Phrases of ``k`` words in some chunks: lang, phrase, n; only those whose parts may be frequent."""
    distinct, ids, n = W.split_words(batch.column("chunk").cast(pa.large_string()))
    langs, lang = W.encoded(batch.column("lang"))
    lang = np.repeat(lang, n)
    weight = np.repeat(batch.column("weight").to_numpy(zero_copy_only=False), n)
    ends = np.cumsum(n)
    last = batch.column("last").to_numpy(zero_copy_only=False)
    own = np.repeat(ends - np.where(last, 0, overlap), n)
    end = np.repeat(ends, n)
    place = np.arange(len(ids))
    ok = (place < own) & (place + k <= end)
    if k > 1 and frequent is not None:
        grams = W.gram_hashes(W.word_hashes(distinct)[ids], k - 1)
        bit = _keyed(grams, W.word_hashes(langs)[lang[:len(grams)]], bits)
        hit = np.zeros(len(ids) + 1, bool)
        hit[:len(grams)] = (frequent[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
        ok &= hit[:-1] & hit[1:]
    at = np.flatnonzero(ok)
    key, size = lang[at], max(1, len(langs))
    for i in range(k):
        if size > 2**62 // max(1, len(distinct)):
            known, key = np.unique(key, return_inverse=True)
            size = len(known)
        key = key * len(distinct) + ids[at + i]
        size *= max(1, len(distinct))
    _, one, inverse = np.unique(key, return_index=True, return_inverse=True)
    total = np.zeros(len(one), np.int64)
    np.add.at(total, inverse, weight[at])
    inside = (at[one][:, None] + np.arange(k)).reshape(-1)
    return pa.record_batch({
        "lang": langs.take(pa.array(lang[at[one]])).cast(pa.string()),
        "phrase": W.joined(distinct, ids[inside], np.full(len(one), k)),
        "n": pa.array(total),
    })


def bitmap(phrases: DataFrame, bits: int) -> np.ndarray:
    """Bits of the phrases (lang, phrase), ``bits`` in all; built in parts of 4 kB that the driver puts in a row.

    Spark's bitmap functions number bits and parts from 1.
    """

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            distinct, ids, n = W.split_words(batch.column("phrase").cast(pa.large_string()))
            langs, lang = W.encoded(batch.column("lang"))
            h, first = W.word_hashes(distinct)[ids], W.starts_of(n)
            grams = W.gram_hashes(h, int(n[0]))[first]  # all have as many words
            yield pa.record_batch({"bit": pa.array(_keyed(grams, W.word_hashes(langs)[lang], bits).astype(np.int64) + 1)})

    made = phrases.mapInArrow(numbered, "bit long").groupBy(F.expr("bitmap_bucket_number(bit)").alias("part")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("held"))
    out = np.zeros((bits // (8 * 4096) + 1) * 4096, np.uint8)
    for part, held in made.toLocalIterator():
        out[(part - 1) * 4096:part * 4096] = np.frombuffer(held, np.uint8)
    return out


def count_phrases(parsed: DataFrame, min_count: int, max_words: int = 5, bits: int = BITS) -> tuple[list[DataFrame], DataFrame]:
    """Phrases with at least ``min_count`` occurrences per number of words, as (lang, phrase, n), and all words per lang (lang, n)."""
    spark = parsed.sparkSession
    overlap, levels, held = max_words - 1, [], None
    totals = None
    for k in range(1, max_words + 1):
        def rows(batches: Iterator[pa.RecordBatch], k: int = k, held=held) -> Iterator[pa.RecordBatch]:
            waiting, size = [], 0
            frequent = None if held is None else held.value
            for batch in batches:
                waiting.append(batch)
                size += batch.column("chunk").nbytes // 6
                if size >= WORDS:
                    yield count_batch(pa.concat_batches(waiting), k, overlap, frequent, bits)
                    waiting, size = [], 0
            if waiting:
                yield count_batch(pa.concat_batches(waiting), k, overlap, frequent, bits)

        counted = parsed.mapInArrow(rows, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        if k == 1:
            counted = stored(counted)
            totals = checkpoint(counted.groupBy("lang").agg(F.sum("n").alias("n")))
        found = stored(counted.where(F.col("n") >= min_count))
        levels.append(found)
        if k < max_words:
            held = spark.sparkContext.broadcast(bitmap(found.select("lang", "phrase"), bits))
    return levels, totals


def scored(levels: list[DataFrame], totals: DataFrame, absorbed: int) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the candidates that no longer one absorbs."""
    known = levels[0].withColumn("k", F.lit(1))
    for k, level in enumerate(levels[1:], 2):
        known = known.unionByName(level.withColumn("k", F.lit(k)))
    counts = known.select("lang", "phrase", "n")
    candidates = known.where("k >= 2").withColumn("words", F.split("phrase", " "))

    def part(first, size):
        return F.array_join(F.slice("words", first, size), " ")

    # a candidate without its first or its last word
    shorter = candidates.where("k >= 3").select("lang", F.explode(F.array(part(2, F.col("k") - 1), part(1, F.col("k") - 1))).alias("phrase"), F.col("n").alias("longer"))
    absorbing = shorter.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = (
        candidates.join(absorbing, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("n").cast("decimal(38,0)") * absorbed))
        .select("lang", "phrase", F.col("n").alias("a"), "words", "k")
    )
    cuts = kept.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)"))).select(
        "lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("_left"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("_right"))
    left = counts.select(F.col("lang"), F.col("phrase").alias("_left"), F.col("n").alias("l"))
    right = counts.select(F.col("lang"), F.col("phrase").alias("_right"), F.col("n").alias("r"))
    score = F.expr("(cast(1000 as decimal(38,0)) * cast(a as decimal(38,0)) * cast(n as decimal(38,0))) div (cast(l as decimal(38,0)) * cast(r as decimal(38,0)))")
    return (
        cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"]).join(totals, "lang")
        .withColumn("score", score)
        .groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best"))
        .select("lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score")
    )


def collocations(docs: DataFrame, min_count: int = 100, top: int = 2000, max_words: int = 5, absorbed: int = 100, lang: str = "lang", text: str = "text", period: int = PERIOD, bits: int = BITS) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    parsed = stored(parse(docs, lang, text, max_words, period))
    found = scored(*count_phrases(parsed, min_count, max_words, bits), absorbed)
    order = WIN.Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # of a language, every task passes on its first ``top`` only
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
