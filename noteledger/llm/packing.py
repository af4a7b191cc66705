"""Packing of token sequences by Karmarkar-Karp multiway differencing.

A document's ids (with an end id) are cut into pieces: as many pieces of
exactly ``capacity`` as fit, each a sequence of its own without padding, and
the rest in pieces of at most half the capacity; every 16th document's rest is
cut finely, which gives the differencing small pieces to level windows with.
These pieces are dealt at random into batches of about ``BATCH``, one task
each, and a batch is packed into k windows: every piece starts as a partial partition of
its own into k windows, and the two partial partitions with the widest spread
are merged again and again, the fullest window of one with the emptiest of the
other, until one is left. k starts at ceil(sum / capacity) and rises while a
window exceeds the capacity, by as much as the excess over the mean asks for.
Windows come out near equal, with under one part in a hundred of padding.

Batches are dealt by the place of a row in a written table, so a document or
source of any size, and rows that repeat, spread evenly. Ids never cross a
shuffle unless ``keep_ids`` asks for them.

A null text is empty: its only id is the end id. Texts have no length limit; a long
one is many pieces. Pieces of one length are told apart by their place, so ties do
not matter. An empty table gives no rows. Only the id and the text are read, so other
columns may have any name.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from array import array
from bisect import insort
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteledger.llm.common import checkpoint, in_light_batches

COARSE, FINE = 2, 64  # the rest of a document is cut to pieces of capacity / COARSE, or FINE for one document in EVERY
EVERY = 16
BATCH = 2048
MEMO = 200_000  # parts whose ids a Python worker remembers while it runs a task
END_ID = 0

#: Parts whose ids in a row are the ids of the text: the vocabulary's pattern starts a new token at each.
#: White space as in Unicode: Python's class also has the separators 1c to 1f.
PART = re.compile(r"[ \n]?[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+(?![\S\x1c-\x1f])|[^\S\x1c-\x1f]")
#: A text with none of these, and no white space at its ends, has single spaces and line feeds only.
IRREGULAR = ["  ", " \n", "\n ", "\n\n", *map(chr, [9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])]

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class PartIds(dict):
    """Ids of words as little-endian 32-bit bytes, each word with the space or line feed before it.

    A key is a word after a space, or a line feed and a word. The first
    ``MEMO`` words that occur are kept, among them the frequent ones. The
    vocabulary is read from the tokenizer file; words are encoded by an
    engine that gives the same ids as the file's own library.
    """

    def __init__(self, path: str):
        import tiktoken

        super().__init__()
        with open(path, encoding="utf-8") as src:
            model = json.load(src)
        special = {t["content"] for t in model["added_tokens"]}
        odd = [t["content"] for t in model["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"]]
        if odd:
            raise ValueError(f"added tokens that take in or look at what is beside them: {odd[:3]}")
        self.added = {t["content"]: array("I", [t["id"]]).tobytes() for t in model["added_tokens"] if t["content"]}
        # of tokens that start at one place the longest, as the library does
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        ranks = {bytes(map(BYTE_OF.__getitem__, t)): i for t, i in model["model"]["vocab"].items() if t not in special}
        self.encode_word = tiktoken.Encoding("words", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary

    def ids(self, part: str) -> bytes:
        return array("I", self.encode_word(part)).tobytes()

    def __missing__(self, key: str) -> bytes:
        found = self.ids(key if key[0] == "\n" else " " + key)
        if len(self) < MEMO:
            self[key] = found
        return found

    def encode_added(self, text: str) -> bytes:
        """Ids of a whole text as the file's library gives them: added tokens that the text holds have their own ids."""
        if not any(t in text for t in self.added):
            return self.encode(text)
        # every second part is an added token
        return b"".join(self.added[x] if i % 2 else self.encode(x) for i, x in enumerate(self.added_pattern.split(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, all of it taken as plain text."""
        if not text:
            return b""
        if text[0].isspace() or text[-1].isspace() or any(x in text for x in IRREGULAR):
            return b"".join(map(self.ids, PART.findall(text)))
        first, *words = text.replace("\n", " \n").split(" ")
        return self.ids(first) + b"".join(map(self.__getitem__, words))


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}


BYTE_OF = byte_of()
#: Fixed value: the pattern of byte-level vocabularies of this kind.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_tokenizers: dict[str, PartIds] = {}


def part_ids(path: str) -> PartIds:
    """One memo per Python worker and vocabulary."""
    if path not in _tokenizers:
        _tokenizers[path] = PartIds(path)
    return _tokenizers[path]


def cut(n: int, capacity: int, fine: bool) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    whole = n - n % capacity
    out = [(s, capacity) for s in range(0, whole, capacity)]
    rest = n - whole
    if rest:
        k = -(-rest // max(1, capacity // (FINE if fine else COARSE)))
        ends = [whole + rest * i // k for i in range(k + 1)]
        out += [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]
    return out


def piece_rows(batches: Iterator[pd.DataFrame], path: str, capacity: int, keep_ids: bool, group: int = 256) -> Iterator[pd.DataFrame]:
    end, encoder = array("I", [END_ID]).tobytes(), part_ids(path)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
    nth = 0
    for batch in batches:
        for a in range(0, len(batch), group):
            some, out = batch.iloc[a:a + group], []
            for doc_id, text in zip(some["doc_id"], some["text"], strict=True):
                ids = encoder.encode_added(text or "") + end
                n = len(ids) // 4
                pieces = cut(n, capacity, nth % EVERY == 0)
                nth += 1
                for start, length in pieces:
                    piece = ids[4 * start:4 * (start + length)]
                    row = (doc_id, start, length, zlib.crc32(piece), n)
                    out.append((*row, np.frombuffer(piece, "<u4").astype("int32")) if keep_ids else row)
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
    encoder.clear()  # the worker serves other stages too


def merge(a: list, b: list, k: int) -> list:
    """Opposing sum of two partial partitions into ``k`` windows.

    A partial partition is the ascending list of (-sum, members) of its
    nonempty windows; the others are zero. The fullest window of one meets the
    emptiest of the other.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) + len(b) <= k:
        for window in b:
            insort(a, window)
        return a
    for j, (s, members) in enumerate(b):
        i = k - 1 - j  # b's fullest window goes to a's last slot, and so on
        if i >= len(a):
            a.append((s, members))
        else:
            a[i] = (a[i][0] + s, a[i][1] + members)
    return sorted(a)


def differencing(sizes: list[int], k: int) -> list[tuple[int, list[int]]]:
    """Windows as (sum, members) from ``k``-way differencing of the sizes."""
    spread = lambda p: p[0][0] - (p[-1][0] if len(p) == k else 0)  # noqa: E731  negative: widest first
    heap = [(-s, i, [(-s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        c = merge(a, b, k)
        heapq.heappush(heap, (spread(c), i, c))
    return [(-s, members) for s, members in heap[0][2]] if heap else []


def windows(sizes: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """Near-equal windows of at most ``capacity``; their number rises until all fit."""
    total = sum(sizes)
    k = max(1, -(-total // capacity))
    while True:
        found = differencing(sizes, k)
        fullest = max((s for s, _ in found), default=0)
        if fullest <= capacity:
            return found
        room = capacity - (fullest - total / k)  # for the mean, if the excess stays
        k = max(k + 1, ceil(total / room) if room > capacity / 2 else k + k // 8)


def pack_batch(batch: pd.DataFrame, capacity: int) -> pd.DataFrame:
    batch = batch.sort_values("_at", ignore_index=True)
    sequence, offset = np.zeros(len(batch), "int64"), np.zeros(len(batch), "int64")
    lengths = batch["length"].to_numpy()
    for w, (_, members) in enumerate(windows(lengths.tolist(), capacity)):
        at = 0
        for i in members:
            sequence[i], offset[i] = w, at
            at += lengths[i]
    # odd numbers; the batch has fewer windows than pieces, and these have distinct places
    places = batch["_at"].to_numpy()
    return batch.assign(sequence_id=2 * places[sequence] + 1, offset=offset).drop(columns=["_at", "_batch"])


@in_light_batches
def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    sequence_id: twice the piece's place for a piece that is a sequence, twice
    the place of a batch's w-th piece plus 1 for the batch's w-th window.
    """
    schema = PIECES + (", ids array<int>" if keep_ids else "")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = checkpoint(rows.mapInPandas(lambda it: piece_rows(it, tokenizer, capacity, keep_ids), schema)).withColumn("_at", F.monotonically_increasing_id())
    small = pieces.where(F.col("length") < capacity)
    batches = max(1, -(-small.count() // BATCH))
    packed = (
        small.withColumn("_batch", F.pmod(F.xxhash64("_at"), F.lit(batches)))
        .groupBy("_batch").applyInPandas(lambda b: pack_batch(b, capacity), schema + ", sequence_id long, offset long")
    )
    alone = pieces.where(F.col("length") == capacity).select(*(c.split()[0] for c in schema.split(", ")), (F.col("_at") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)
