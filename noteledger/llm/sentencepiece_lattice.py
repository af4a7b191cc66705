"""SentencePiece encoding and decoding as relations.

Encoding. A text (with the model's leading space) is cut into units: spaces
and what follows them up to the next space, and line feeds by themselves; no
piece of the model crosses a unit's border, so a distinct unit is encoded once
for many occurrences.

As relations: substrings of at most the longest piece's length are exploded and
joined with the piece table (one row per piece, so its size is fixed by the
model and it is broadcast); the edges of a unit's lattice are gathered and
folded by higher-order functions.

* ``viterbi``, for unigram models: the fold keeps for each end the best score and
  its last edge; the path is read back from the end.
* ``merges``, for BPE models, where scores order merges and do not add up: the
  edges in order of score (ties from the left) are applied if the two symbols
  they join are there. If an application makes an earlier edge possible, as a
  piece can be reached in another way than it was learned, the unit is folded
  again, choosing the first possible edge each time.

Characters that are no piece become byte pieces, or the unknown id if the model
has none. Units longer than ``LONG`` characters, whose lattice one row should
not hold, are encoded by the library.

``encode_units`` gives units and ids as a relation. Occurrences of units find
their ids there in two ways, both exact: the ``FREQUENT`` commonest units, a
bounded number, are broadcast; the rest are joined by a shuffle of their
occurrences, so a unit that a third of all text consists of never meets in one
task. Places, units and ids of every occurrence take several times the disk of the texts.

``encode`` gives whole texts' ids, which stay with their row, so nothing is
shuffled or written. A batch of about 4 MB of text is cut into units, its distinct
units are rows of matrices of symbols, and a round joins two symbols in each:
of the edges that are possible (pairs of neighbours that make up a piece, looked up
in the model's table of pairs) the one of highest score, from the left.

Decoding looks each id's bytes up and puts them together.

A null text is empty, and an empty text has no ids. Repeated rows are encoded
alike and stay rows of their own; doc_id may be null. Bytes that are no UTF-8 are
read as U+FFFD. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noteledger.llm.batches import by_bytes
from noteledger.llm.common import checkpoint, fresh, stored

SPACE = "▁"  # fixed value: how pieces write a space
FREQUENT = 300_000
LONG = 400
ID = 1 << 20  # ids are below this
SYMBOL = 1 << 22  # ids, and code points moved by the number of ids, are below this
NONE = np.iinfo(np.int32).max  # rank of a pair that is no piece
CELLS = 1 << 20  # symbols of a matrix of units at most
UNITS = r" +[^ \n]*|\n|[^ \n]+"


class Pieces:
    """The model's piece table on the driver."""

    def __init__(self, path: str):
        import sentencepiece

        self.path = path
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        order = {s: k for k, s in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        self.rows = [(model.id_to_piece(i).replace(SPACE, " "), i, model.get_score(i), order[model.get_score(i)]) for i in plain]
        self.longest = max(len(p) for p, *_ in self.rows)
        inside = [p for p, *_ in self.rows if " " in p.lstrip(" ") or ("\n" in p and p != "\n")]
        if inside:
            raise ValueError(f"pieces cross the borders of units: {inside[:3]}")
        bytes_ = [i for i in ids if model.is_byte(i)]
        self.byte_base = bytes_[0] if bytes_ == list(range(bytes_[0], bytes_[0] + 256)) else None if not bytes_ else -1
        if self.byte_base == -1:
            raise ValueError("byte pieces are not in order")
        self.unknown = model.unk_id()
        self.hex = [""] * len(ids)
        for piece, i, *_ in self.rows:
            self.hex[i] = piece.encode().hex()
        for i in bytes_:
            self.hex[i] = f"{i - self.byte_base:02x}"

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every way to make up a piece of two symbols: key (ascending), rank of the piece's score, its id.

        A symbol is a piece, or a character that is none: the number of ids and its code point.
        """
        known = {p: i for p, i, *_ in self.rows}
        symbol = lambda x: known.get(x, len(self.hex) + ord(x) if len(x) == 1 else None)
        made = sorted(
            (left * SYMBOL + right, rank, i)
            for p, i, _, rank in self.rows for at in range(1, len(p))
            if (left := symbol(p[:at])) is not None and (right := symbol(p[at:])) is not None)
        columns = list(zip(*made, strict=True)) or [(), (), ()]
        return np.array(columns[0], np.int64), np.array(columns[1], np.int32), np.array(columns[2], np.int32)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(pd.DataFrame(self.rows, columns=["piece", "id", "score", "rank"]), "piece string, id int, score double, rank int")


def let(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_units(text: Column) -> Column:
    """The units of a text, in order."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACE, " ")
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.regexp_extract_all(F.concat(F.lit(" "), plain), F.lit(UNITS), F.lit(0)))


def lattice(units: DataFrame, pieces: Pieces) -> DataFrame:
    """``unit`` with ``singles`` (per character its id, -1 if it is no piece) and ``edges``.

    An edge is one long: rank of the score, start, length and id, so that
    sorting gives the order of merges. ``units`` keeps its partitioning by unit,
    so gathering needs no exchange.
    """
    n = F.char_length("unit")
    spans = (
        units.select("unit", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
        .select("unit", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(pieces.longest), F.col("n") - F.col("i")))).alias("len"))
        .withColumn("piece", F.substring("unit", F.col("i") + 1, F.col("len")))
    )
    found = spans.join(F.broadcast(pieces.table(units.sparkSession)), "piece", "left").where("len = 1 or id is not null")
    single = F.when(F.col("len") == 1, F.col("i").cast("long") * ID + F.coalesce("id", F.lit(-1)) + 1)
    edge = F.when(F.col("len") > 1, ((F.col("rank").cast("long") * (1 << 16) + F.col("i")) * 64 + F.col("len")) * ID + F.col("id"))
    return found.groupBy("unit").agg(
        F.collect_list(single).alias("singles"), F.collect_list(edge).alias("edges"),
    ).withColumn("singles", F.transform(F.array_sort("singles"), lambda x: (x % ID).cast("int") - 1)).withColumn("edges", F.array_sort("edges"))


def merge_fold(singles: Column, edges: Column) -> Column:
    """Ids per position after all merges (null where no symbol starts): array of next position * ID + id + 1."""
    start = lambda e: F.pmod(F.call_function("shiftright", e, F.lit(26)), F.lit(1 << 16)).cast("int")
    length = lambda e: F.pmod(F.call_function("shiftright", e, F.lit(20)), F.lit(64)).cast("int")
    after = lambda at, i: F.call_function("shiftright", F.get(at, i), F.lit(20)).cast("int")

    def possible(at: Column, e: Column) -> Column:
        # the symbol at the start, and the one after it, end together where the edge does
        return let(after(at, start(e)), lambda m: (m < start(e) + length(e)) & (after(at, m) == start(e) + length(e)))

    def joined(at: Column, e: Column) -> Column:
        return let(F.struct(start(e).alias("i"), after(at, start(e)).alias("m")), lambda s: F.transform(at, lambda v, k: (
            F.when(k == s["i"], (start(e) + length(e)).cast("long") * ID + F.pmod(e, F.lit(ID)) + 1).when(k == s["m"], F.lit(None).cast("long")).otherwise(v))))

    begin = F.transform(singles, lambda v, k: (k + 1).cast("long") * ID + v + 1)

    def once(acc: Column, e: Column) -> Column:
        changed = lambda at: F.struct(at.alias("at"), (acc["bad"] | F.exists(edges, lambda x: (x < e) & F.coalesce(possible(at, x), F.lit(False)))).alias("bad"))
        return F.when(F.coalesce(possible(acc["at"], e), F.lit(False)), let(joined(acc["at"], e), changed)).otherwise(acc)

    def again(at: Column, _: Column) -> Column:
        return let(F.get(F.filter(edges, lambda x: F.coalesce(possible(at, x), F.lit(False))), F.lit(0)), lambda e: F.when(e.isNull(), at).otherwise(joined(at, e)))

    first = F.aggregate(edges, F.struct(begin.alias("at"), F.lit(False).alias("bad")), once)
    return let(first, lambda f: F.when(f["bad"], F.aggregate(edges, begin, again)).otherwise(f["at"]))


def ids_of_unit(unit: Column, at: Column, pieces: Pieces) -> Column:
    """The ids along the symbols, with bytes for characters that are no piece."""

    def plain(v: Column, i: Column) -> Column:
        char = F.hex(F.encode(F.substring(unit, i + 1, F.lit(1)), "UTF-8"))
        if pieces.byte_base is None:
            missing = F.array(F.lit(pieces.unknown))
        else:
            missing = let(char, lambda c: F.transform(F.sequence(F.lit(1), F.length(c) - 1, F.lit(2)), lambda k: F.conv(F.substring(c, k, F.lit(2)), 16, 10).cast("int") + pieces.byte_base))
        return F.when(v.isNull(), F.array().cast("array<int>")).when(F.pmod(v, F.lit(ID)) == 0, missing).otherwise(F.array(F.pmod(v, F.lit(ID)).cast("int") - 1))

    return F.flatten(F.transform(at, plain))


def viterbi_fold(length: Column, edges: Column) -> Column:
    """Best path of a unigram lattice: ``edges`` (struct end, start, score, id, in order of end) to the ids.

    The accumulator holds for each end the best score and the ids so far; of
    equal scores the edge that starts first is taken.
    """
    state = "array<struct<score:double,ids:array<int>>>"
    begin = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids"))).cast(state)

    def step(best: Column, end: Column) -> Column:
        into = F.filter(edges, lambda e: e["end"] == end)
        ways = F.transform(into, lambda e: F.struct((F.get(best, e["start"])["score"] + e["score"]).alias("score"), (-e["start"]).alias("first"), e["id"].alias("id")))
        top = lambda w: let(F.get(best, -w["first"])["ids"], lambda ids: F.struct(w["score"].alias("score"), F.concat(ids, F.array(w["id"])).alias("ids")))
        return let(F.array_max(ways), lambda w: F.concat(best, F.array(top(w)).cast(state)))

    return F.get(F.aggregate(F.sequence(F.lit(1), length), begin, step), length)["ids"]


def unigram_units(units: DataFrame, pieces: Pieces, unknown_penalty: float = 10.0) -> DataFrame:
    """``unit`` and ``ids`` on the best path, for unigram models; a character that is no piece costs the lowest score less the penalty."""
    worst = min(s for _, _, s, _ in pieces.rows) - unknown_penalty
    n = F.char_length("unit")
    spans = (
        units.select("unit", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
        .select("unit", "n", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(pieces.longest), F.col("n") - F.col("i")))).alias("len"))
        .withColumn("piece", F.substring("unit", F.col("i") + 1, F.col("len")))
    )
    found = spans.join(F.broadcast(pieces.table(units.sparkSession)), "piece", "left").where("len = 1 or id is not null")
    edge = F.struct((F.col("i") + F.col("len")).alias("end"), F.col("i").alias("start"), F.coalesce("score", F.lit(worst)).alias("score"), F.coalesce("id", F.lit(pieces.unknown)).alias("id"))
    edges = found.groupBy("unit", "n").agg(F.array_sort(F.collect_list(edge)).alias("edges"))
    return edges.select("unit", viterbi_fold(F.col("n"), F.col("edges")).alias("ids"))


def library(path: str) -> Callable[[str], list[int]]:
    """The library's ids of a unit."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    line = "\n" if model.encode("\n") else ""
    skip = len(model.encode(line + line)) - len(model.encode(line)) if line else 0
    head = len(model.encode(line)) - skip if line else 0

    def ids(unit: str) -> list[int]:
        if unit.startswith(" "):  # the library puts this space itself
            return model.encode(unit[1:])
        return model.encode(line + unit)[head + skip:]  # a line feed before it keeps the library's space apart

    return ids


def merged_units(units: DataFrame, pieces: Pieces) -> DataFrame:
    """``unit`` and ``ids`` after all merges, for BPE models. ``units``: distinct, partitioned by unit."""
    path = pieces.path

    def by_library(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = library(path)
        for batch in batches:
            yield batch[["unit"]].assign(ids=[ids(unit) for unit in batch["unit"]])

    short = lattice(units.where(F.char_length("unit") <= LONG), pieces)
    folded = short.withColumn("at", merge_fold(F.col("singles"), F.col("edges"))).select("unit", ids_of_unit(F.col("unit"), F.col("at"), pieces).alias("ids"))
    long = units.where(F.char_length("unit") > LONG).select("unit").mapInPandas(by_library, "unit string, ids array<int>")
    return folded.unionByName(long)


def occurrences(docs: DataFrame, row: str, text: str) -> DataFrame:
    """row, nth, unit: every unit of every text."""
    return docs.select(row, F.posexplode(text_units(F.col(text))).alias("nth", "unit"))


def encode_units(docs: DataFrame, pieces: Pieces, row: str = "row", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """row, nth, unit, ids: every unit of every text with its ids. ``row`` tells rows apart."""
    counted = stored(occurrences(docs, row, text).groupBy("unit").agg(F.count(F.lit(1)).alias("n")))
    # the least count at which at most ``frequent`` units are left; the driver sees one row per count
    tally = sorted(((r["n"], r["units"]) for r in counted.groupBy("n").agg(F.count(F.lit(1)).alias("units")).collect()), reverse=True)
    limit, held = (tally[0][0] + 1 if tally else 1), 0
    for n, units in tally:
        if held + units > frequent:
            break
        held, limit = held + units, n
    common = checkpoint(merged_units(counted.where(F.col("n") >= limit).select("unit"), pieces))
    rare = merged_units(counted.where(F.col("n") < limit).select("unit").repartition("unit"), pieces)
    marked = occurrences(docs, row, text).join(F.broadcast(common), "unit", "left")
    known = marked.where("ids is not null")
    return known.unionByName(marked.where("ids is null").drop("ids").join(rare, "unit")).select(row, "nth", "unit", "ids")


def units_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All units of some texts in a row (bytes), and their number per text; ``text_units`` on a column."""
    plain = pc.replace_substring(pc.fill_null(texts, "").cast(pa.large_string()), SPACE, " ")
    empty = pa.scalar("", pa.large_string())
    plain = pc.if_else(pc.equal(pc.binary_length(plain), 0), empty, pc.binary_join_element_wise(empty, plain, pa.scalar(" ", pa.large_string())))
    if not pc.sum(pc.binary_length(plain)).as_py():
        return pa.array([], pa.large_binary()), np.zeros(len(texts), np.int64)
    _, ends, data = plain.buffers()
    ends = np.frombuffer(ends, np.int64, len(plain) + 1, 8 * plain.offset)
    body = np.frombuffer(data, np.uint8, ends[-1])
    space, line = body == 32, body == 10
    first = space | line
    first[1:] &= line[1:] | ~space[:-1]
    first[1:] |= line[:-1] & ~space[1:]
    first[:ends[0]] = False
    first[ends[:-1][np.diff(ends) > 0]] = True
    starts = np.flatnonzero(first)
    units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, ends[-1])), data])
    return units, np.diff(np.searchsorted(starts, ends))


def gathered(values: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Runs of ``n`` values from ``start`` on, in a row."""
    return values[np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)]


def merge_rounds(symbols: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """``symbols`` [unit, place], -1 behind a unit's end, after all merges: each round joins one pair per unit."""
    keys, ranks, ids = pairs
    out = np.full_like(symbols, -1)
    if not len(keys):
        return symbols

    def found(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * SYMBOL + right
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return at, (keys[at] == key) & (left >= 0) & (right >= 0)

    def rank_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        at, there = found(left, right)
        return np.where(there, ranks[at], NONE)

    rows = np.arange(len(symbols))
    rank = rank_of(symbols[:, :-1], symbols[:, 1:])
    while symbols.shape[1] > 1 and len(rows):
        at = rank.argmin(axis=1)  # the leftmost of equal ones
        on = rank[np.arange(len(rows)), at] < NONE
        out[rows[~on], :symbols.shape[1]] = symbols[~on]
        rows, symbols, rank, at = rows[on], symbols[on], rank[on], at[on]
        each = np.arange(len(rows))
        joined = ids[found(symbols[each, at], symbols[each, at + 1])[0]]
        keep = np.ones(symbols.shape, bool)
        keep[each, at + 1] = False
        symbols = symbols[keep].reshape(len(rows), symbols.shape[1] - 1)
        symbols[each, at] = joined
        # the joined pair's rank goes; those of the new symbol and its neighbours are looked up
        keep = np.ones(rank.shape, bool)
        keep[each, at] = False
        rank = rank[keep].reshape(len(rows), rank.shape[1] - 1)
        left, right = np.flatnonzero(at > 0), np.flatnonzero(at < rank.shape[1])
        rank[left, at[left] - 1] = rank_of(symbols[left, at[left] - 1], joined[left])
        rank[right, at[right]] = rank_of(joined[right], symbols[right, at[right] + 1])
    out[rows, :symbols.shape[1]] = symbols
    return out


class UnitCoder:
    """Ids of units, in a task: the tables of the model that ``merge_rounds`` needs."""

    def __init__(self, pieces: Pieces):
        self.path, self.n_ids, self.byte_base, self.unknown = pieces.path, len(pieces.hex), pieces.byte_base, pieces.unknown
        chars = sorted((ord(p), i) for p, i, *_ in pieces.rows if len(p) == 1)
        self.chars, self.char_ids = np.array([c for c, _ in chars], np.int64), np.array([i for _, i in chars], np.int32)
        self.pairs = pieces.pairs()

    def symbols_of(self, points: np.ndarray) -> np.ndarray:
        """A character's id, or the number of ids and its code point if it is no piece."""
        at = np.minimum(np.searchsorted(self.chars, points), max(len(self.chars) - 1, 0))
        there = self.chars[at] == points if len(self.chars) else np.zeros(len(points), bool)
        return np.where(there, self.char_ids[at] if len(self.chars) else 0, self.n_ids + points).astype(np.int32)

    def missing(self, point: int) -> list[int]:
        """Ids of a character that is no piece."""
        if self.byte_base is None:
            return [self.unknown]
        return [self.byte_base + b for b in chr(point).encode()]

    def short(self, units: list[str], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units of ``n`` characters in a row, and their number per unit."""
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        symbols, start = self.symbols_of(points), np.cumsum(n) - n
        order, made, counts, a = np.argsort(n, kind="stable"), [], np.zeros(len(n), np.int64), 0
        while a < len(order):
            # units of like lengths share a matrix
            width = n[order[a]] + max(2, n[order[a]] // 8)
            b = min(int(np.searchsorted(n[order], width, side="right")), a + max(1, CELLS // int(width)))
            some = order[a:b]
            matrix = np.full((len(some), int(n[some[-1]])), -1, np.int32)
            matrix[np.arange(matrix.shape[1]) < n[some][:, None]] = gathered(symbols, start[some], n[some])
            matrix = merge_rounds(matrix, self.pairs)
            counts[some] = (matrix >= 0).sum(axis=1)
            made.append(matrix[matrix >= 0])
            a = b
        merged = np.concatenate(made) if made else np.empty(0, np.int32)
        place = np.zeros(len(n), np.int64)
        place[order] = np.cumsum(counts[order]) - counts[order]
        merged = gathered(merged, place, counts)
        # a character that is no piece stands for a run of ids
        others, which = np.unique(merged[merged >= self.n_ids], return_inverse=True)
        if len(others):
            runs = [self.missing(int(x) - self.n_ids) for x in others]
            size = np.array([len(r) for r in runs])
            at, length = merged.astype(np.int64), np.ones(len(merged), np.int64)
            at[merged >= self.n_ids] = (self.n_ids + np.cumsum(size) - size)[which]
            length[merged >= self.n_ids] = size[which]
            pool = np.concatenate([np.arange(self.n_ids), *runs]).astype(np.int32)
            counts = np.diff(np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(counts)])])
            merged = gathered(pool, at, length)
        return merged, counts

    def __call__(self, units: pa.Array, ids_of_long: Callable[[str], list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units in a row, and their number per unit."""
        texts = [u.decode("utf-8", "replace") for u in units.to_pylist()]
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        long = np.flatnonzero(n > LONG)
        if not len(long):
            return self.short(texts, n)
        brief = np.flatnonzero(n <= LONG)
        ids, counts = self.short([texts[i] for i in brief], n[brief])
        more = [ids_of_long(texts[i]) for i in long]
        all_counts = np.zeros(len(n), np.int64)
        all_counts[brief], all_counts[long] = counts, [len(m) for m in more]
        pool, start = np.concatenate([ids, *more]).astype(np.int32), np.zeros(len(n), np.int64)
        start[np.concatenate([brief, long])] = np.cumsum(np.concatenate([counts, all_counts[long]])) - np.concatenate([counts, all_counts[long]])
        return gathered(pool, start, all_counts), all_counts


def with_ids(docs: DataFrame, pieces: Pieces, text: str, ids: str, n_units: str) -> DataFrame:
    """``docs`` with the ids of every text (array) and the number of its units; rows stay in their partitions."""
    coder = UnitCoder(pieces)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def by_library(unit: str) -> list[int]:
            if not held:
                held.append(library(coder.path))
            return held[0](unit)

        for batch in by_bytes(batches, text):
            units, n = units_of(batch.column(text))
            distinct = units.dictionary_encode()
            made, length = coder(distinct.dictionary, by_library)
            which = distinct.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            each = length[which]
            flat = gathered(made, (np.cumsum(length) - length)[which], each)
            ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(n)])]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(n, pa.int64())], names=[*batch.schema.names, ids, n_units])

    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(n_units, T.LongType())])
    return docs.mapInArrow(rows, schema)


def encode(docs: DataFrame, pieces: Pieces, row: str = "row", text: str = "text") -> DataFrame:
    """row and ids (array) of every text that has units."""
    given, n_units = fresh(docs, "_text"), fresh(docs, "n_units")
    return with_ids(docs.select(row, F.col(text).alias(given)), pieces, given, "ids", n_units).where(F.col(n_units) > 0).select(row, "ids")


def decode_ids(ids: Column, pieces: Pieces, leading: bool = True) -> Column:
    """Text of an array of ids; ``leading``: the first space is the model's own. Ids of control pieces give nothing.

    The piece table's bytes are one literal, as large as the model's vocabulary, so decoding needs no join.
    """
    table = F.split(F.lit(",".join(pieces.hex)), ",")
    whole = F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")), "UTF-8")
    return F.substr(whole, F.lit(2)) if leading else whole


def decode(coded: DataFrame, pieces: Pieces, ids: str = "ids", text: str = "text") -> DataFrame:
    """``coded`` with the text of its ids."""
    return coded.withColumn(text, decode_ids(F.col(ids), pieces))


def coded_documents(docs: DataFrame, pieces: Pieces, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, ids and the text decoded from them, with n_units, n_pieces, ids_digest (of the ids in order), n_chars decoded and round_trip.

    round_trip: the decoded text equals the whole input text, as it is given. A
    text with U+2581 is not given back, as pieces write a space so.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("given"))
    coded = decode(with_ids(rows, pieces, "given", "ids", "n_units"), pieces)
    return coded.select(
        "doc_id", "n_units", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_digest"),
        F.char_length("text").cast("long").alias("n_chars"), (F.col("text") == F.col("given")).alias("round_trip"), "ids", "text")
