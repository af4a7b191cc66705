"""Dense text vectors from co-occurrence, as a relation.

A word's context is the ``window`` words on either side of its occurrences. Every
context word stands for a fixed random direction of ``dims`` signs, taken from the
bits of its md5; a word's vector is the sum of its contexts' directions, over
its occurrences. This is a random projection of the words' co-occurrence rows:
words with similar contexts get similar vectors, and no vocabulary is gathered
anywhere. The vectors are a table (word, coordinates), made by one aggregation whose rows
are as wide as the vectors, whatever the number of word pairs.

A text's vector is the mean of its words' vectors, or that of its first word; only
the first ``max_tokens`` words of a text count, the limit of the encoder that this stands for.
Coordinates are kept in whole millionths, so sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.generators import explode_rows

DIMS = 16
WINDOW = 2
MAX_TOKENS = 512
UNIT = 1_000_000


def direction_bits(word: Column) -> Column:
    """The first 16 bits of the word's md5 as a number; bit j gives the sign of coordinate j (1: minus)."""
    return F.conv(F.substring(F.md5(word), 1, 4), 16, 10).cast("int")


def limited(tokens: Column, max_tokens: int) -> Column:
    return F.slice(F.filter(tokens, lambda t: t != ""), 1, max_tokens)


def word_vectors(docs: DataFrame, tokens: str, dims: int = DIMS, window: int = WINDOW, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(word, n, vector): occurrences, and the mean direction of the contexts in millionths, array<bigint>."""
    if not 1 <= dims <= 16:
        raise ValueError("dims must be 1 to 16")
    words = docs.select(limited(F.col(tokens), max_tokens).alias("_w"))
    words = words.select("_w", F.transform("_w", direction_bits).alias("_h"))
    near = [d for d in range(-window, window + 1) if d]

    def around(i: Column) -> Column:
        # get() gives null outside of the text
        return F.struct(F.get("_w", i).alias("word"), *[F.get("_h", i + d).alias(f"h{k}") for k, d in enumerate(near)])

    places = explode_rows(words, F.transform(F.col("_w"), lambda _, i: around(i)), "p").select("p.*")
    h = [F.col(f"h{k}") for k in range(len(near))]
    known = sum((x.isNotNull().cast("int") for x in h), F.lit(0))

    def minus(j: int) -> Column:
        return sum((F.coalesce(F.shiftright(x, j).bitwiseAND(F.lit(1)), F.lit(0)) for x in h), F.lit(0))

    sums = places.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum(known).alias("_known"), *[F.sum(minus(j)).alias(f"_m{j}") for j in range(dims)])
    coordinate = [F.floor((F.col("_known") - 2 * F.col(f"_m{j}")) * F.lit(float(UNIT)) / F.col("n")).cast("long") for j in range(dims)]
    return sums.select("word", "n", F.array(*coordinate).alias("vector"))


def mean_vectors(docs: DataFrame, id_col: str, tokens: str, vectors: DataFrame, dims: int = DIMS, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(id, n_tokens, vector): mean of the words' vectors in millionths; zeros for a text without words.

    Words are joined by a shuffle; a frequent word is a key with many rows on the texts' side only, which Spark splits.
    """
    words = docs.select(F.col(id_col), limited(F.col(tokens), max_tokens).alias("_w"))
    rows = words.select(id_col, F.explode_outer("_w").alias("word"))
    joined = rows.join(vectors.select("word", "vector"), "word", "left")
    sums = joined.groupBy(id_col).agg(F.count("word").alias("n_tokens"), *[F.coalesce(F.sum(F.get("vector", F.lit(j))), F.lit(0)).alias(f"_s{j}") for j in range(dims)])
    mean = [F.floor(F.col(f"_s{j}") / F.greatest(F.col("n_tokens"), F.lit(1))).cast("long") for j in range(dims)]
    return sums.select(id_col, "n_tokens", F.array(*mean).alias("vector"))


def first_vectors(docs: DataFrame, id_col: str, tokens: str, vectors: DataFrame, dims: int = DIMS, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(id, word, vector): the first word of each text and its vector in millionths; zeros for a text without words."""
    words = docs.select(F.col(id_col), F.get(limited(F.col(tokens), max_tokens), F.lit(0)).alias("word"))
    joined = words.join(vectors.select("word", "vector"), "word", "left")
    return joined.select(id_col, "word", F.coalesce("vector", F.array_repeat(F.lit(0).cast("long"), dims)).alias("vector"))


def as_doubles(vector: str = "vector") -> Column:
    """The coordinates as numbers, for the models."""
    return F.transform(vector, lambda x: x / F.lit(float(UNIT)))
