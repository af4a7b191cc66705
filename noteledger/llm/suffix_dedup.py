"""Exact substring dedup: bytes covered by a string of ``length`` bytes that also starts elsewhere.

Equal strings of ``length`` bytes (windows) must meet, wherever they are, so each
window is placed by its own content: the position of its smallest 32-byte hash
(leftmost of equal ones) is its anchor. Consecutive windows with one anchor,
and with anchor offsets in one of a few ranges of ``STARTS``, form a segment; all
windows of a segment contain the same core, bytes at a fixed distance from the
anchor. Equal windows lie at the same place of segments with equal cores.
Segments are grouped by their core's hash; those whose core occurs once hold
no repeated window and go no further.

In a group the strings, aligned by their core, are sorted column by column from
the right: a round inserts one symbol of every string before its suffix. The
symbols in the order of the suffixes are the column of the collection's
Burrows-Wheeler transform; a stable sort by it gives the order of the longer
suffixes, and their common prefixes follow from range minima of the former
ones. The core is one round that adds its whole length. A window is repeated if
its suffix has a common prefix of at least ``length`` with a neighbour, or if its
whole segment occurs more than once. Groups are constructed together, about
``CHUNK`` strings at a time; the columns lie in a sequential temporary file of the
task, written once and read once, so memory holds the order, the prefixes and
one column. Alignment keeps a round linear in the strings: plain insertion of
documents from their ends would take as many passes over the whole transform
as the longest document has bytes.

With ``across`` a string counts as repeated only if it starts in two different texts:
a class of equal windows then needs two different text ids (the smallest and the
largest are carried), and what a text repeats only within itself stays.

Equal segments are collapsed to one string with a count before the text of a
segment is looked up, so copies cost nothing there. A group with more than
``HOT`` different strings (the edge of a passage that very many documents share) is
split into its windows, which are counted by their content.

Cores are told apart by a 64-bit hash, and what is around a core is compared byte by byte, so a
wrong match needs two cores with one hash inside strings that agree in all other bytes of a window;
segments are taken for equal by the hashes of the core and of the whole, 128 bits together.

A null text is empty; texts shorter than ``length`` have no window. Repeated rows
are copies that repeat all their windows. Matches never cross documents. An
empty table gives no rows; extra columns are kept by ``remove_repeats`` and
ignored by ``repeated_bytes``.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noteledger.llm.common import checkpoint, fresh, in_light_batches

LENGTH = 400
GRAM = 32  # bytes hashed for an anchor
STARTS = 185  # anchor offsets, hence windows, of a segment at most
SLICE = 1 << 20  # window starts handled at once, so that an anchor's place fits ``PLACE`` bits
PLACE = np.uint64((1 << 21) - 1)
CHUNK = 20_000
HOT = 20_000
WINDOW_ROWS = 256  # strings cut into windows at once, up to ``STARTS`` rows each
SMALL = 200_000  # ids of texts that may be broadcast; more are joined by a shuffle

_random = np.random.Generator(np.random.PCG64(7202410))
BYTES = _random.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_random.integers(0, 2**62)) * 2 + 1
INVERSE = pow(BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 14), base, np.uint64)
        held[0] = 1
        held = _powers[base] = np.multiply.accumulate(held)
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def segments(text: bytes, length: int = LENGTH) -> np.ndarray:
    """Segments of a text as columns core hash, segment hash, first start, core minus first start, windows."""
    starts = max(1, min(STARTS, length - min(GRAM, length) + 1))
    gram = min(GRAM, length)
    found = []
    for at in range(0, len(text) - length + 1, SLICE):
        data = np.frombuffer(text, np.uint8, min(len(text) - at, SLICE + length - 1), at)
        n = len(data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTES[data] * powers(BASE, n), out=total[1:])
        back = powers(INVERSE, n)
        grams = mix((total[gram:] - total[:-gram]) * back[:n - gram + 1])
        ranked = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
        anchor = (sliding_min(ranked, length - gram + 1) & PLACE).astype(np.int64)
        first = np.arange(len(anchor))
        part = (anchor - first) // starts
        cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])) + 1
        s1 = np.concatenate([[0], cut])
        s2 = np.concatenate([cut, [len(anchor)]]) - 1
        core = anchor[s1] - part[s1] * starts
        size = length - starts + 1
        key = (total[core + size] - total[core]) * back[core]
        whole = (total[s2 + length] - total[s1]) * back[s1]
        found.append(np.stack([mix(key).view(np.int64), mix(whole).view(np.int64), s1 + at, core - s1, s2 - s1 + 1]))
    return np.concatenate(found, axis=1) if found else np.empty((5, 0), np.int64)


def repeated_windows(group: np.ndarray, left: list[bytes], right: list[bytes], counts: np.ndarray, n_windows: np.ndarray, length: int, ids: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Which windows of each string are repeated: a matrix [string, distance of the window's start from the core].

    ``group`` ascends; a string is its left context, the core and its right context.
    ``ids``: smallest and largest id of the texts of each string; only windows of two texts count.
    """
    n, starts = len(group), max(1, min(STARTS, length - min(GRAM, length) + 1))
    n_left, n_right = (np.fromiter(map(len, x), np.int64, n) for x in (left, right))
    group = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]).astype(np.int64)])) if n else group
    out = np.zeros((n, starts), bool)
    with tempfile.TemporaryFile() as columns:
        # the file holds the columns in the order of the rounds: right contexts from their ends, then left contexts
        side = np.zeros((n, starts - 1), np.uint8)
        for i, x in enumerate(right):
            side[i, :len(x)] = np.frombuffer(x, np.uint8)
        columns.write(np.ascontiguousarray(side[:, ::-1].T).tobytes())
        side[:] = 0
        for i, x in enumerate(left):
            side[i, :len(x)] = np.frombuffer(x, np.uint8)[::-1]
        columns.write(np.ascontiguousarray(side.T).tobytes())
        del side
        columns.seek(0)

        order, prefix = np.empty(0, np.int64), np.empty(0, np.int64)
        inserted = np.zeros(n, bool)

        def round_(order: np.ndarray, prefix: np.ndarray, symbol: np.ndarray, goes_on: np.ndarray, adds: int) -> tuple[np.ndarray, np.ndarray]:
            """Put ``symbol`` before the suffixes in ``order`` (``prefix``: common with the one before) and before new, empty ones."""
            new = np.flatnonzero(goes_on & ~inserted)
            inserted[new] = True
            stays = np.flatnonzero(goes_on[order])
            # an empty suffix sorts before all others and has no common prefix
            strings = np.concatenate([new, order[stays]])
            place = np.concatenate([np.full(len(new), -1), stays])
            transform = group[strings] * 256 + symbol[strings]
            by = np.argsort(transform, kind="stable")
            strings, place, transform = strings[by], place[by], transform[by]
            common = np.zeros(len(strings), np.int64)
            if len(strings) > 1:
                same = transform[1:] == transform[:-1]
                both = same & (place[:-1] >= 0) & (place[1:] >= 0)
                common[1:][same] = adds
                if both.any():
                    ends = np.stack([place[:-1][both] + 1, place[1:][both] + 1], axis=1).reshape(-1)
                    common[1:][both] += np.minimum.reduceat(np.append(prefix, 0), ends)[::2]
            return strings, common

        for d in range(starts - 1, 0, -1):
            order, prefix = round_(order, prefix, np.frombuffer(columns.read(n), np.uint8), n_right >= d, 1)
        order, prefix = round_(order, prefix, np.zeros(n, np.uint8), np.ones(n, bool), length - starts + 1)
        for d in range(starts):
            if d:
                order, prefix = round_(order, prefix, np.frombuffer(columns.read(n), np.uint8), n_left >= d, 1)
            near = prefix >= length
            if ids is not None and len(order):
                # equal windows follow each other
                first = np.flatnonzero(~near)
                low, high = np.minimum.reduceat(ids[0][order], first), np.maximum.reduceat(ids[1][order], first)
                near = np.repeat(low < high, np.diff(np.append(first, len(order))))
            else:
                near[:-1] |= near[1:]
            out[order[near], d] = True
    at = np.arange(starts)
    valid = (at <= n_left[:, None]) & (at > (n_left - n_windows)[:, None])
    return (out if ids is not None else out | (counts > 1)[:, None]) & valid


def runs(marked: np.ndarray) -> list[int]:
    """First and last index of each run of True, in a row."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return [int(x) - (i % 2) for i, x in enumerate(edge)]


def text_id(text: Column) -> list[Column]:
    """128-bit id of a text in two longs; null texts are empty."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("u1"), F.xxhash64(F.lit(1), text).alias("u2")]


PACK = 1 << 8  # core distance and window count of a segment are below this


def _place(start: np.ndarray, core: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (start * PACK + core) * PACK + n


def _unplace(place: int) -> tuple[int, int, int]:
    return place // PACK // PACK, place // PACK % PACK, place % PACK


def candidate_segments(docs: DataFrame, text: str, length: int) -> DataFrame:
    """Segments (core, whole, u1, u2, place) whose core occurs more than once, one row per document that holds it."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 512):
                some = batch.iloc[a:a + 512]
                found = [segments(t, length) for t in some["text"]]
                each = np.fromiter((f.shape[1] for f in found), np.int64, len(found))
                core, whole, start, distance, n = np.concatenate(found, axis=1)
                yield pd.DataFrame({"core": core, "whole": whole, "u1": np.repeat(some["u1"].to_numpy(), each), "u2": np.repeat(some["u2"].to_numpy(), each), "place": _place(start, distance, n)})

    texts = docs.select(*text_id(F.col(text)), F.col(text).cast("binary").alias("text")).where(F.octet_length("text") >= length)
    made = texts.mapInPandas(rows, "core long, whole long, u1 long, u2 long, place long")
    # counted with partial aggregation and joined, as one core may be that of half of all segments; the
    # counts are written first, so that the join's two sides are plain exchanges that Spark can split.
    # The segments are made again for the join: their rows, written, take more disk than the texts
    repeated = checkpoint(made.groupBy("core").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("core"))
    return made.join(repeated, "core")


def contexts(docs: DataFrame, text: str, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (core, whole, n, lo, hi, u1, u2, place) with the bytes of each segment left and right of its core."""
    starts = max(1, min(STARTS, length - min(GRAM, length) + 1))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for data, asked in zip(batch["text"], batch["asked"], strict=True):
                for one in asked:
                    start, to_core, n = _unplace(one["place"])
                    core = start + to_core
                    out.append((one["core"], one["whole"], one["n"], one["lo"], one["hi"], n, data[start:core], data[core + length - starts + 1:start + n - 1 + length]))
            yield pd.DataFrame(out, columns=["core", "whole", "n", "lo", "hi", "windows", "lefts", "rights"])

    by_text = wanted.groupBy("u1", "u2").agg(F.collect_list(F.struct("core", "whole", "n", "lo", "hi", "place")).alias("asked"))
    ids = checkpoint(wanted.select("u1", "u2").distinct())
    if ids.count() <= SMALL:
        ids = F.broadcast(ids)
    # only texts that are asked for are shuffled, if their ids are few enough to broadcast
    texts = docs.select(*text_id(F.col(text)), F.col(text).cast("binary").alias("text")).join(ids, ["u1", "u2"], "left_semi")
    one_each = texts.groupBy("u1", "u2").agg(F.first("text").alias("text"))
    return one_each.join(by_text, ["u1", "u2"]).mapInPandas(rows, "core long, whole long, n long, lo long, hi long, windows long, lefts binary, rights binary")


SPANS = "core long, whole long, spans array<int>"


def construct(strings: DataFrame, length: int, across: bool = False) -> DataFrame:
    """Repeated windows of each string: ``SPANS``, pairs of first and last window counted from the segment's first."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        marked = repeated_windows(rows["core"].to_numpy(), list(rows["lefts"]), list(rows["rights"]), rows["n"].to_numpy(), rows["windows"].to_numpy(), length,
                                  (rows["lo"].to_numpy(), rows["hi"].to_numpy()) if across else None)
        # windows are counted from the segment's first, which is farthest from the core
        spans = [runs(m[len(x) - w + 1:len(x) + 1][::-1]) for m, x, w in zip(marked, rows["lefts"], rows["windows"], strict=True)]
        out = pd.DataFrame({"core": rows["core"], "whole": rows["whole"], "spans": spans})
        return out[out["spans"].map(len) > 0]

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= CHUNK:
                rows = pd.concat(held, ignore_index=True)
                last = rows["core"].to_numpy() == rows["core"].iloc[-1]  # its group may go on
                if not last.all():
                    yield solve(rows[~last].reset_index(drop=True))
                held, size = [rows[last]], int(last.sum())
        if size:
            yield solve(pd.concat(held, ignore_index=True))

    return strings.repartition("core").sortWithinPartitions("core", "whole").mapInPandas(chunks, SPANS)


def count_windows(strings: DataFrame, length: int, across: bool = False) -> DataFrame:
    """The same as ``construct`` for groups with very many strings: windows are counted by content."""
    starts = max(1, min(STARTS, length - min(GRAM, length) + 1))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), WINDOW_ROWS):
                some, out = batch.iloc[a:a + WINDOW_ROWS], []
                for core, whole, n, lo, hi, windows, left, right in zip(*(some[c] for c in ("core", "whole", "n", "lo", "hi", "windows", "lefts", "rights")), strict=True):
                    for i in range(windows):
                        d = len(left) - i
                        content = b"%d:%d:" % (core, d) + left[i:] + right[:starts - 1 - d]
                        out.append((core, whole, n, lo, hi, i, hashlib.blake2b(content, digest_size=16).digest()))
                yield pd.DataFrame(out, columns=["core", "whole", "n", "lo", "hi", "i", "content"])

    def join_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = []
            for found in batch["found"]:
                marked = np.zeros(max(found) + 1, bool)
                marked[found] = True
                spans.append(runs(marked))
            yield batch[["core", "whole"]].assign(spans=spans)

    single = strings.mapInPandas(rows, "core long, whole long, n long, lo long, hi long, i int, content binary")
    repeated = single.groupBy("content").agg(F.sum("n").alias("_n"), F.min("lo").alias("_lo"), F.max("hi").alias("_hi")).where("_lo < _hi" if across else "_n > 1").select("content")
    return single.join(repeated, "content").groupBy("core", "whole").agg(F.collect_list("i").alias("found")).mapInPandas(join_runs, SPANS)


@in_light_batches
def repeated_spans(docs: DataFrame, text: str, length: int, across: bool = False) -> DataFrame:
    """(u1, u2, spans): per distinct text its repeated strings, as a list of (first byte, byte after the last).

    ``across``: only strings that start in two different texts (by their first id) count.
    """
    places = checkpoint(candidate_segments(docs, text, length))
    strings = checkpoint(places.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("n"), F.min("u1").alias("lo"), F.max("u1").alias("hi"), F.min(F.struct("u1", "u2", "place")).alias("one")).select("core", "whole", "n", "lo", "hi", "one.*"))
    sizes = strings.groupBy("core").agg(F.count(F.lit(1)).alias("different"))
    sized = strings.join(sizes, "core")
    # all occurrences of the core are in equal segments: every window is repeated
    alone = sized.where("different = 1 and lo < hi" if across else "different = 1").select("core", "whole", F.array(F.lit(0), (F.col("place") % PACK - 1).cast("int")).alias("spans"))
    texts = contexts(docs, text, sized.where("different > 1").select("core", "whole", "n", "lo", "hi", "u1", "u2", "place"), length)
    hot = sizes.where(F.col("different") > HOT).select("core")
    if hot.isEmpty():
        found = construct(texts, length, across)
    else:
        mixed, hot = checkpoint(texts), checkpoint(hot)
        found = construct(mixed.join(hot, "core", "left_anti"), length, across).unionByName(count_windows(mixed.join(hot, "core", "left_semi"), length, across))
    found = found.unionByName(alone)
    start = F.expr(f"place div {PACK * PACK}")
    ends = F.transform(F.expr("sequence(0, int(size(spans) div 2) - 1)"), lambda i: F.struct(
        (F.col("start") + F.get("spans", i * 2)).alias("a"), (F.col("start") + F.get("spans", i * 2 + 1) + length).alias("b")))
    marked = places.join(found, ["core", "whole"]).select("u1", "u2", start.alias("start"), "spans").select("u1", "u2", F.explode(ends).alias("span"))
    # strings and spans are written once, here: each partition of a checkpoint is a file, for which executors start processes (chmod) on a local file system
    return checkpoint(marked.groupBy("u1", "u2").agg(F.collect_set("span").alias("spans")))


def kept_bytes(data: bytes, spans: list | None) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of maximal removed runs."""
    parts, at, n = [], 0, 0
    end = -1
    for a, b in sorted((s["a"], s["b"]) for s in (spans if spans is not None else ())):
        if a > end:  # a run that only touches the one before is part of it
            n += 1
        if a > at:
            parts.append(data[at:a])
        at = end = max(at, b)
    parts.append(data[at:])
    return b"".join(parts), n


def with_spans(docs: DataFrame, text: str, length: int, columns: list[Column], u1: str, u2: str, spans: str, across: bool = False) -> DataFrame:
    """``columns`` of every row and its spans; the rows are shuffled once, against narrow rows per text."""
    found = repeated_spans(docs, text, length, across).select(F.col("u1").alias(u1), F.col("u2").alias(u2), F.col("spans").alias(spans))
    one, two = text_id(F.col(text))
    return docs.select(*columns, one.alias(u1), two.alias(u2)).join(found, [u1, u2], "left")


def repeated_bytes(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for data, spans in zip(batch["body"], batch["spans"], strict=True):
                kept, n = kept_bytes(data, spans)
                out.append((len(data), len(data) - len(kept), n, hashlib.sha256(kept).hexdigest()))
            made = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True).astype("Int64"), made], axis=1)

    body = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")
    found = with_spans(docs, text, length, [F.col(doc_id).cast("long").alias("doc_id"), body], "u1", "u2", "spans")
    return found.select("doc_id", "body", "spans").mapInPandas(rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def long_runs(data: bytes, spans: list, least_words: int) -> list:
    """The maximal runs of ``spans`` that hold at least ``least_words`` words, whole or in part."""
    out: list[dict] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1]["b"]:
            out[-1]["b"] = max(out[-1]["b"], b)
        else:
            out.append({"a": a, "b": b})
    return [s for s in out if len(data[s["a"]:s["b"]].split()) >= least_words]


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", across: bool = False, least_words: int = 0) -> DataFrame:
    """``docs`` with the kept bytes as text; a character that a cut leaves incomplete goes as well. A null text stays null.

    ``across``: only strings that start in two different texts count. ``least_words``:
    a maximal run of repeated bytes with fewer words stays.
    """

    @F.pandas_udf("string")
    def keep(texts: pd.Series, ends: pd.Series) -> pd.Series:
        out = []
        for t, flat in zip(texts, ends, strict=True):
            data, spans = t.encode("utf-8"), [{"a": a, "b": b} for a, b in zip(flat[::2], flat[1::2], strict=True)]
            out.append(kept_bytes(data, long_runs(data, spans, least_words) if least_words else spans)[0].decode("utf-8", "ignore"))
        return pd.Series(out)

    u1, u2, spans = (fresh(docs, x) for x in ("_u1", "_u2", "_spans"))
    found = with_spans(docs, text, length, [F.col(c) for c in docs.columns], u1, u2, spans, across)
    ends = F.flatten(F.transform(spans, lambda s: F.array(s["a"], s["b"])))
    # rows without spans, null texts among them, are left as they are
    touched = F.col(spans).isNotNull() & F.col(text).isNotNull()
    safe = F.when(touched, F.col(text)).otherwise(F.lit("")), F.when(touched, ends).otherwise(F.array().cast("array<bigint>"))
    return found.withColumn(text, F.when(touched, keep(*safe)).otherwise(F.col(text))).select(*docs.columns)
