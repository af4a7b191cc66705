"""Document fingerprints by winnowing, in DataFrame functions only.

A text's UTF-8 bytes give one hash per gram of ``GRAM`` consecutive bytes; a
text of fewer bytes has one gram of them all. Of each window of ``WINDOW``
consecutive hashes the smallest is chosen, the rightmost of equal ones, and its
position is kept; the first windows reach over the text's start, so they hold
its first gram, its first two and so on. Two texts that share
``WINDOW + GRAM - 1`` bytes in a row share a chosen hash, whatever they are written
in, and its positions tell where; with the start, ``GRAM`` bytes are enough. The
rule is one for all lengths. A text so shares a mark with its edit if the half
that stays has ``GRAM`` bytes.

The edit of a text is not hashed again: windows that lie in what stays, or in
what comes from the next text, have those texts' marks, and only windows
around the seam are looked at (``edited_marks``).

``marks`` is the same over words (runs without white space) in grams of ``K``;
a text without white space is one gram there.

A gram's hash and position are one long, so that the smallest long of a window
is its mark. Minima of 2, 4, 8 ... hashes are made from those of half as many,
for ``BLOCK`` windows at a time, so a long text needs no long arrays but its
marks. Intermediate arrays are bound with ``let``, as an expression used inside
a lambda would be evaluated anew for every element. Only texts are shuffled,
and once; marks are made after it.

To pair each document with the next one in descending order of doc_id, rows
are dealt into ranges of doc_id between approximate quantiles (as many as
there are tasks, times ``RANGES_PER_TASK``); the first row of each range is
copied to the end of the one before, and a window function looks ahead inside
a range. Null ids come last; rows of one id are ordered by the md5 of their
text, and nulls, or an id that several quantiles fall on, have ranges of this
key, in proportion to their rows. Only rows alike in id and text stay together.

Null texts count as empty. An empty text has no marks; two texts without marks
are alike (1.0), and one without is unlike any with (0.0). Repeated rows get a
row each. With a single row the next document is the row itself. Texts have no
length limit, and an empty table gives no rows. Only the id and the text are read,
so other columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as WIN

from noteledger.llm.common import n_tasks, small_frame, text_key

GRAM = 8  # bytes in a gram
K = 5  # words in a gram of words
WINDOW = 16  # grams in a window
DIRECT = 64  # an edited text of fewer bytes is looked at whole
REACH = GRAM + WINDOW - 2  # bytes after its first that a window needs
BLOCK = 4096  # windows at a time
RANGES_PER_TASK = 4


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def grams(text: Column, k: int = K) -> Column:
    """Hash of every k-gram of words, in order (empty array: no words)."""
    return let(words(text), lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, F.lit(k))))))


def mark_positions(hashes: Column, window: int = WINDOW) -> Column:
    """Ascending positions (from 0) of each window's smallest hash, the rightmost of equal ones."""

    def chosen(back: Column) -> Column:
        # in the reversed array the rightmost of equal hashes comes first
        starts = F.sequence(F.lit(1), F.greatest(F.size(back) - (window - 1), F.lit(1)))
        at = F.transform(starts, lambda j: let(F.slice(back, j, F.lit(window)), lambda s: F.size(back) - j - F.array_position(s, F.array_min(s)).cast("int") + 1))
        return F.when(F.size(back) == 0, F.array().cast("array<int>")).otherwise(F.reverse(F.array_distinct(at)))

    return let(F.reverse(hashes), chosen)


def marks(text: Column) -> Column:
    """Struct of ``at`` (positions, array<int>) and ``hash`` (array<bigint>) of the chosen grams."""
    return let(grams(text), lambda g: let(mark_positions(g), lambda p: F.struct(p.alias("at"), F.transform(p, lambda i: F.get(g, i)).alias("hash"))))


LAST = (1 << 31) - 1  # a packed gram is 32 bits of its hash and, in the low 31 bits, this less its position from 1
HASH = 0xFFFFFFFF << 31


def packed_grams(data: Column, first: Column, last: Column) -> Column:
    """Hash and position of the grams of ``data`` (binary) that start at ``first`` to ``last``, counted from 1."""
    return F.transform(F.sequence(first, last), lambda i: F.xxhash64(F.substring(data, i, F.lit(GRAM))).bitwiseAND(F.lit(HASH)).bitwiseOR(F.lit(LAST) - i))


def window_minima(packed: Column, window: int = WINDOW) -> Column:
    """The smallest of each window of packed grams (none: fewer than a window)."""

    def wider(mins: Column, step: int) -> Column:
        # least() passes over the nulls after the end
        return let(mins, lambda m: F.zip_with(m, F.slice(m, F.lit(step + 1), F.size(m)), lambda a, b: F.least(a, b)))

    def whole(p: Column) -> Column:
        mins, width = p, 1
        while width < window:
            step = min(width, window - width)
            mins, width = wider(mins, step), width + step
        return F.slice(mins, F.lit(1), F.greatest(F.size(p) - (window - 1), F.lit(0)))

    return let(packed, whole)


#: Before the first gram, so that the first windows reach over the text's start.
NONE = (1 << 63) - 1


def window_marks(data: Column, first: Column, last: Column) -> Column:
    """Marks (packed) of the windows of the grams from ``first`` to ``last``; from 1 on with those over the start."""
    found = packed_grams(data, first, last)
    return F.array_distinct(window_minima(F.when(first == 1, F.concat(F.array_repeat(F.lit(NONE), WINDOW - 1), found)).otherwise(found)))


def byte_marks(text: Column) -> Column:
    """Packed marks of a text's bytes, in order of their positions."""

    def chosen(data: Column, n: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1)), F.lit(BLOCK))
        return F.array_distinct(F.flatten(F.transform(starts, lambda s: window_marks(data, s, F.least(n, s + (BLOCK + WINDOW - 2))))))

    return let(text.cast("binary"), lambda data: F.when(F.octet_length(data) == 0, F.array().cast("array<bigint>")).otherwise(
        let(F.greatest(F.octet_length(data) - (GRAM - 1), F.lit(1)), lambda n: chosen(data, n))))


def position(packed: Column) -> Column:
    """Place of a packed gram, counted from 1."""
    return F.lit(LAST) - packed.bitwiseAND(F.lit(LAST))


def unpacked(packed: Column) -> Column:
    """Struct of ``at`` (byte positions from 0, array<int>) and ``hash`` (array<bigint>) of packed marks."""
    return let(packed, lambda p: F.struct(
        F.transform(p, lambda x: (position(x) - 1).cast("int")).alias("at"), F.transform(p, lambda x: F.shiftright(x, 31)).alias("hash")))


def first_windows(packed: Column) -> Column:
    """First window (by the place of its first gram) that chose each mark, in ascending order.

    A mark replaces the one before either as it comes into the window, if its hash is
    not larger, or when the one before goes out.
    """
    def since(x: Column, k: Column) -> Column:
        before = F.get(packed, k - 1)
        came = F.shiftright(x, 31) <= F.shiftright(before, 31)
        return F.when(k == 0, F.lit(2 - WINDOW).cast("long")).when(came, position(x) - (WINDOW - 1)).otherwise(position(before) + 1)

    return F.transform(packed, since)


def edited_marks(data: Column, own: Column, stays: Column, following: Column, comes: Column) -> Column:
    """Marks of the text ``data`` (binary): ``stays`` bytes of one with the marks ``own``, then ``comes`` of one with ``following``.

    Windows up to ``stays`` - REACH lie in the first text, those after ``stays`` in the second.
    """
    def upto(windows: Column, last: Column) -> Column:
        return F.size(F.filter(windows, lambda f: f <= last))

    def whole(x: Column) -> Column:
        n = x["stays"] + x["comes"] - (GRAM - 1)
        near = x["stays"] < REACH  # the seam's windows reach over the start
        left = F.when(near, F.lit(0)).otherwise(upto(x["own_since"], x["stays"] - REACH))
        first = F.when(near, F.lit(1)).otherwise(x["stays"] - (REACH - 1))
        last = F.least(x["stays"] + (WINDOW - 1), n)
        after = upto(x["since"], F.lit(1))  # the mark of the second text's first full window
        right = F.when(x["comes"] <= REACH, F.lit(0)).otherwise(upto(x["since"], x["comes"] - REACH) - after + 1)
        return F.array_distinct(F.concat(
            F.slice(x["own"], F.lit(1), left), window_marks(x["data"], first, last),
            F.when(right > 0, F.transform(F.slice(x["following"], after, right), lambda m: m - x["stays"])).otherwise(F.array().cast("array<bigint>"))))

    parts = F.struct(data.alias("data"), own.alias("own"), first_windows(own).alias("own_since"), stays.alias("stays"),
                     following.alias("following"), first_windows(following).alias("since"), comes.alias("comes"))
    return let(parts, whole)


def fingerprint(found: Column) -> Column:
    """Marks as text: hash (low 32 bits, hex) and position of each."""
    return F.array_join(F.zip_with(found["hash"], found["at"], lambda h, p: F.concat(F.lpad(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"), F.lit("@"), p.cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of the two texts' distinct chosen hashes that both have."""
    def of(x: Column) -> Column:
        return let(F.array_distinct(x["a"]), lambda p: let(F.array_distinct(x["b"]), lambda q: let(
            F.size(F.array_intersect(p, q)), lambda both: F.when((F.size(p) == 0) & (F.size(q) == 0), F.lit(1.0)).otherwise(both / (F.size(p) + F.size(q) - both)))))

    return let(F.struct(a.alias("a"), b.alias("b")), of)


def with_next(docs: DataFrame, columns: list[str], ranges: int, enrich: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` (doc_id, text, _key) after ``enrich``, with next_<column> of the next row in descending order.

    ``enrich`` works row by row. It comes after the shuffle, so that what it adds is not shuffled.
    """
    spark = docs.sparkSession
    cuts = F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges) if ranges > 1 else F.lit(None)
    quantiles, known, total = docs.select(cuts, F.count("doc_id"), F.count(F.lit(1))).first()
    shares = Counter(quantiles or [])
    bounds = sorted(shares)
    heavy = {i: n + 1 for i, n in shares.items() if n > 1}  # ids with ranges of their own, by key
    nulls = max(1, -(-ranges * (total - known) // max(1, total)))
    # range 0 holds the largest ids; nulls come after the last
    above = F.lit(len(bounds)) - F.size(F.filter(F.lit(bounds).cast("array<bigint>"), lambda b: b < F.col("doc_id"))) if bounds else F.lit(0)
    many = F.lit(list(heavy)).cast("array<bigint>")
    parts = F.when(F.col("doc_id").isNull(), F.lit(nulls)).when(F.array_contains(many, F.col("doc_id")), F.get(F.lit(list(heavy.values())), F.array_position(many, F.col("doc_id")).cast("int") - 1)) if heavy else F.when(F.col("doc_id").isNull(), F.lit(nulls))
    # the key's place among as many parts; a heavy id is the largest of its range of ids, so the others come after it
    place = F.coalesce(F.shiftright(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * parts, 32), F.lit(ranges + 1).cast("long"))
    dealt = docs.withColumn("_range", F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(above).cast("long") * (ranges + 2) + place)
    first = {r["_range"]: r["f"] for r in dealt.groupBy("_range").agg(F.min(F.struct(F.bitwise_not("doc_id").alias("down"), "_key")).alias("f")).collect()}
    used = sorted(first)
    links = [(used[i - 1], None if first[r]["down"] is None else ~first[r]["down"], first[r]["_key"]) for i, r in enumerate(used)]
    heads = F.broadcast(small_frame(spark, links, "_to long, _id long, _head string"))
    copies = (
        docs.join(heads, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_head")))
        .dropDuplicates(["_to"]).drop("_id", "_head").withColumnRenamed("_to", "_range")
    )
    by = ["_copy", F.desc_nulls_last("doc_id"), "_key"]
    rows = dealt.withColumn("_copy", F.lit(False)).unionByName(copies.withColumn("_copy", F.lit(True)))
    rows = enrich(rows.repartition("_range").sortWithinPartitions("_range", *by))
    order = WIN.Window.partitionBy("_range").orderBy(*by)
    return rows.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns)).where(~F.col("_copy")).drop("_copy", "_range")


def edited(text: Column, following: Column) -> tuple[Column, Column]:
    """``text`` without its last half (rounded down), and as much of the start of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half)


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", find: Callable[[Column], Column] | None = None) -> DataFrame:
    """Fingerprints of every document and its edited text, and likeness to both the edit and the next document.

    ``find``: marks of a text as ``at`` and ``hash`` (``marks`` for words) instead of the byte marks.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("_key", text_key(F.col("text")))
    marked = lambda df: df.withColumn("marks", find(F.col("text")) if find else byte_marks(F.col("text")))
    paired = with_next(rows, ["text", "marks"], RANGES_PER_TASK * n_tasks(docs.sparkSession), marked)
    stays, comes = edited(F.col("text"), F.col("next_text"))
    both = paired.withColumn("_stays", stays).withColumn("_comes", comes).withColumn("_edited", F.concat("_stays", "_comes"))
    if find:
        other, own, after = find(F.col("_edited")), F.col("marks"), F.col("next_marks")
    else:
        data = F.col("_edited").cast("binary")
        composed = edited_marks(data, F.col("marks"), F.octet_length("_stays"), F.col("next_marks"), F.octet_length("_comes"))
        other = unpacked(F.when(F.octet_length(data) < DIRECT, byte_marks(F.col("_edited"))).otherwise(composed))
        own, after = unpacked(F.col("marks")), unpacked(F.col("next_marks"))
    both = both.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"),
                       own.alias("own"), after["hash"].alias("next_hash"), other.alias("other"))
    return both.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own.hash"), F.col("other.hash")).alias("near_edited"), likeness(F.col("own.hash"), F.col("next_hash")).alias("near_next"))
