"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact check.

A document is its set of word shingles. Documents with equal sets are one node
from the start, so copies cost nothing further. Every node gets a signature of
minimum hashes, cut into bands; nodes that agree on a band share a bucket. The
bands are chosen so that a pair at the threshold shares no bucket with
probability below ``MISS``.

A candidate pair's signatures are compared a batch at a time. After n hashes
with m matches the posterior of the similarity is Beta(m+1, n-m+1); the pair is
pruned as soon as the chance that it reaches the threshold falls below
``MISS``. Survivors are confirmed on the full sets.

Candidates are made so that no group's square is emitted and no link between
components is lost:

1. each member of a bucket is paired with the bucket's smallest node, and the
   best survivor of each member is confirmed;
2. nodes that surviving pairs connect are a cluster. A cluster that still holds
   several components, such as many documents just below the threshold, is
   compared in full: its blocks meet in pairs, a task each, where intersections
   are products of incidence matrices; only links that join components leave it;
3. members of one bucket in different clusters are compared by their signatures,
   again block by block, and only survivors of the Bayesian test leave the task.

Words are runs without space, tab or line breaks of the text with A-Z in lower
case. A text with fewer words than a shingle is one shingle; null texts, and
texts without words, have no shingles and are linked with nothing. Repeated
rows are copies of each other; rows with a null doc_id take part, and are in
the component of the smallest id among the linked (null if there is none). An
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteledger.llm.common import checkpoint, fresh, in_light_batches, text_key
from noteledger.llm.components import components, roots

HASHES = 198
MISS = 1e-6
BATCH = 33  # hashes compared between two looks at the posterior
BLOCK = 1024  # nodes of a group that are compared at once, on average
BLOCK_BYTES = 8 << 20
SMALL = 200_000  # ids that may be broadcast; more are joined by a shuffle
MEMO = 200_000  # words whose hash a Python worker remembers while it runs a task

_random = np.random.Generator(np.random.PCG64(20240607))
MULTIPLY = _random.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _random.integers(0, 2**63, HASHES, dtype=np.uint64)
FOLD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < MEMO:
            self[word] = found
        return found


_hashes = WordHashes()


def forgetting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``batches`` of a task; workers serve later stages too, so its memo goes with it."""
    try:
        yield from batches
    finally:
        _hashes.clear()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    k = min(k, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out * FOLD + h[i:len(h) - k + 1 + i])
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the set, high 32 bits."""
    low = np.full(HASHES, 2**64 - 1, np.uint64)
    for a in range(0, len(found), 2048):
        np.minimum(low, (found[a:a + 2048, None] * MULTIPLY + ADD).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def bands(threshold: float) -> tuple[int, int]:
    """(rows, bands): the longest bands with which a pair at the threshold is missed below ``MISS``."""
    for rows in range(12, 1, -1):
        n = HASHES // rows
        if (1 - threshold**rows) ** n <= MISS:
            return rows, n
    return 1, HASHES


def least_matches(threshold: float, miss: float = MISS) -> dict[int, int]:
    """For n hashes seen, the fewest matches at which P(similarity >= threshold) is at least ``miss``.

    The upper tail of Beta(m+1, n-m+1) at t is the chance of at most m successes in n+1 draws of t.
    """
    out = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, -1
        while chance < miss and m <= n:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def survivors(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the row pairs of two signature matrices that are not pruned, and their matches."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n in range(BATCH, HASHES + 1, BATCH):
        matches[alive] += (a[alive, n - BATCH:n] == b[alive, n - BATCH:n]).sum(axis=1)
        alive = alive[matches[alive] >= least[n]]
    return alive, matches[alive]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u4").reshape(len(column), HASHES)


def sets_of(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """doc_id, tkey, skey (content key of the set, null if empty), n, sig per row."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t in batch["text"]:
                s = shingles(t, k)
                out.append((hashlib.blake2b(s.tobytes(), digest_size=16).digest(), len(s), signature(s).tobytes()) if len(s) else (None, 0, None))
            made = pd.DataFrame(out, columns=["skey", "n", "sig"])
            yield pd.concat([batch[["doc_id", "tkey"]].reset_index(drop=True).astype({"doc_id": "Int64"}), made], axis=1)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(F.col(text)).alias("tkey"), F.col(text).alias("text"))
    return narrow.mapInPandas(lambda it: forgetting(rows(it)), "doc_id long, tkey string, skey binary, n long, sig binary")


def full_sets(docs: DataFrame, text: str, needed: DataFrame, k: int) -> DataFrame:
    """(id, shingles as bytes) of the nodes in ``needed`` (id, tkey), recomputed from one text of each."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "items": [shingles(t, k).tobytes() for t in batch["text"]]})

    if needed.count() <= SMALL:
        needed = F.broadcast(needed)
    texts = docs.select(text_key(F.col(text)).alias("tkey"), F.col(text).alias("text")).join(needed, "tkey")
    return texts.groupBy("id").agg(F.first("text").alias("text")).mapInPandas(lambda it: forgetting(rows(it)), "id long, items binary")


def confirm(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Of the pairs (a, b) those with denominator * intersection >= numerator * union."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(denominator * both >= numerator * (len(p) + len(q) - both))
            yield batch.loc[keep, ["a", "b"]]

    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInPandas(rows, "a long, b long")


def with_components(frame: DataFrame, comps: DataFrame, *ids: str) -> DataFrame:
    """``frame`` with c_<id>: the component of the node in each column of ``ids``, itself if it has no link."""
    for name in ids:
        own = comps.select(F.col("id").alias(name), F.col("comp").alias("_c"))
        frame = frame.join(own, name, "left").withColumn(f"c_{name}", F.coalesce("_c", name)).drop("_c")
    return frame


def dealt_in_blocks(members: DataFrame, group: str, blocks: DataFrame) -> DataFrame:
    """``members`` (group, id, c_id) copied to every pair of blocks (i <= j) that holds them; ``blocks``: group and their number."""
    return (
        members.join(blocks, group)
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(group, "id", "c_id", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )


def intersections(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, as products of incidence matrices."""
    out = np.zeros((len(left), len(right)), np.float32)
    items, column = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    n = sum(map(len, left))
    on_left, on_right = (np.bincount(c, minlength=len(items)) > 0 for c in (column[:n], column[n:]))
    number = np.cumsum(on_left & on_right) - 1  # items of one side alone add nothing
    number[~(on_left & on_right)] = -1
    sides = []
    for sets, place in ((left, column[:n]), (right, column[n:])):
        row, col = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets]), number[place].astype(np.int32)
        order = np.argsort(col, kind="stable")
        sides.append((row[order], col[order]))
    for start in range(0, int(number.max(initial=-1)) + 1, width):
        part = []
        for (row, col), size in zip(sides, (len(left), len(right)), strict=True):
            a, b = np.searchsorted(col, [start, start + width])
            matrix = np.zeros((size, width), np.float32)
            matrix[row[a:b], col[a:b] - start] = 1
            part.append(matrix)
        out += part[0] @ part[1].T
    return out


def joining_links(group: pd.DataFrame, i: int, j: int, numerator: int, denominator: int) -> pd.DataFrame:
    """Of the links between two blocks one for each two components they join, without circles."""
    group = group.sort_values("id", ignore_index=True)
    block, comp, ids = (group[c].to_numpy() for c in ("block", "c_id", "id"))
    sets = [np.frombuffer(x, np.uint64) for x in group["items"]]
    sizes = np.array([len(x) for x in sets], np.float64)
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    out = []
    if len(left) and len(right):
        both = intersections([sets[x] for x in left], [sets[x] for x in right]).astype(np.float64)
        linked = denominator * both >= numerator * (sizes[left][:, None] + sizes[right][None, :] - both)
        linked &= comp[left][:, None] != comp[right][None, :]
        p, q = np.nonzero(linked)
        _, first = np.unique(np.stack([comp[left][p], comp[right][q]]), axis=1, return_index=True)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := root.get(x, x)) != x:
                root[x] = x = root.get(y, y)
            return x

        for k in first:
            x, y = find(comp[left][p[k]]), find(comp[right][q[k]])
            if x != y:
                root[x] = y
                out.append((ids[left[p[k]]], ids[right[q[k]]]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def within_clusters(clusters: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Links that join components within the clusters (cluster, id, c_id) that hold several.

    Blocks of a cluster meet in pairs, in a task each, on their full sets. A
    block has about ``BLOCK_BYTES`` of sets, and no more than ``BLOCK`` on average.
    """
    held = clusters.join(sets, "id")
    mixed = (
        held.groupBy("cluster").agg(F.min("c_id").alias("lo"), F.max("c_id").alias("hi"), F.count(F.lit(1)).alias("size"), F.sum(F.octet_length("items")).alias("bytes"))
        .where("lo < hi").select("cluster", F.ceil(F.greatest(F.col("size") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    )
    dealt = dealt_in_blocks(clusters, "cluster", mixed).join(sets, "id")

    def join_blocks(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return joining_links(group, key[1], key[2], numerator, denominator)

    return dealt.groupBy("cluster", "i", "j").applyInPandas(join_blocks, "a long, b long")


def across_clusters(members: DataFrame, nodes: DataFrame, least: dict[int, int]) -> DataFrame:
    """Pairs (a, b) of members (bucket, id, c_id: the cluster) of one bucket in different clusters that survive the Bayesian test."""
    mixed = members.groupBy("bucket").agg(F.min("c_id").alias("lo"), F.max("c_id").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi")
    blocks = mixed.select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    dealt = dealt_in_blocks(members, "bucket", blocks).join(nodes.select("id", "sig"), "id")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", ignore_index=True)
        _, i, j = key
        left = np.flatnonzero(rows["block"].to_numpy() == i)
        right = np.flatnonzero(rows["block"].to_numpy() == j)
        comp, sig, ids, out = rows["c_id"].to_numpy(), _matrix(rows["sig"]), rows["id"].to_numpy(), []
        for p in left:
            q = right[comp[right] != comp[p]]
            q = q[q > p] if i == j else q
            if len(q):
                at, _ = survivors(np.broadcast_to(sig[p], (len(q), HASHES)), sig[q], least)
                out += [(min(ids[p], ids[x]), max(ids[p], ids[x])) for x in q[at]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long").distinct()


@in_light_batches
def near_duplicates(docs: DataFrame, k: int = 5, numerator: int = 80, denominator: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id), tkey (of the text) and node (of the component), one row per row."""
    threshold = numerator / denominator
    rows_in_band, n_bands = bands(threshold)
    least = least_matches(threshold)
    documents = checkpoint(sets_of(docs, doc_id, text, k))
    nodes = checkpoint(
        documents.where("n > 0").groupBy("skey").agg(F.min("doc_id").alias("low_id"), F.min("tkey").alias("tkey"), F.first("sig").alias("sig"))
    ).withColumn("id", F.monotonically_increasing_id())

    # buckets: one hash per band; only those with several nodes go on
    slices = [F.xxhash64(F.lit(i), F.substring("sig", 4 * rows_in_band * i + 1, 4 * rows_in_band)) for i in range(n_bands)]
    banded = nodes.select("id", F.explode(F.array(*slices)).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader < last").drop("last")
    members = checkpoint(banded.join(shared, "bucket"))

    # stars: the leader of a bucket against its members
    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, matches = survivors(_matrix(batch["x"]), _matrix(batch["y"]), least)
            yield pd.DataFrame({"a": batch["a"].to_numpy()[at], "b": batch["b"].to_numpy()[at], "matches": matches})

    stars = members.where("leader < id").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    signed = (
        stars.join(nodes.select(F.col("id").alias("a"), F.col("sig").alias("x")), "a")
        .join(nodes.select(F.col("id").alias("b"), F.col("sig").alias("y")), "b")
    )
    alive = checkpoint(signed.mapInPandas(test, "a long, b long, matches long"))
    needed = members.select("id").distinct().join(nodes.select("id", "tkey"), "id")
    sets = checkpoint(full_sets(docs, text, needed, k))

    best = alive.groupBy("b").agg(F.max_by("a", F.struct("matches", (-F.col("a")).alias("least"))).alias("a")).select("a", "b")
    links = checkpoint(confirm(best, sets, numerator, denominator))
    comps = checkpoint(roots(links))
    # candidates that hang together are a cluster; those with several components are compared in full
    clusters = checkpoint(components(alive)).select("id", F.col("comp").alias("cluster"))
    inner = within_clusters(with_components(clusters, comps, "id"), sets, numerator, denominator)
    # members of one bucket in different clusters: no chain of leaders has joined them
    placed = with_components(members.select("bucket", "id"), clusters.withColumnRenamed("cluster", "comp"), "id")
    outer = confirm(across_clusters(placed, nodes, least), sets, numerator, denominator)
    more = checkpoint(inner.unionByName(outer))
    if not more.isEmpty():
        comps = components(links.unionByName(more))

    # the smallest doc_id of each component, and back to the rows by the set's key
    found = with_components(nodes.select("id", "skey", "low_id"), comps, "id")
    # written, so that the join's sides are plain exchanges, which Spark can split where a component holds many nodes
    lowest = checkpoint(found.groupBy("c_id").agg(F.min("low_id").alias("component_id")))
    by_set = found.join(lowest, "c_id").select("skey", "component_id", F.col("c_id").alias("node"))
    out = documents.select("doc_id", "tkey", "skey", "n").join(by_set, "skey", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "tkey", "node").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, k: int = 5, numerator: int = 80, denominator: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the smallest doc_id stays.

    Where several rows of a component have that id, or none has an id, the one
    with the smallest text key stays, and of rows equal in both any one does.
    Rows without shingles all stay.
    """
    found = near_duplicates(docs, k, numerator, denominator, doc_id, text)
    # one (id, text key) per component; documents without shingles are not looked up. The three columns that
    # say which row stays are plain, so the rows that the join has dealt out need not move again for repeats
    key, number, none = (fresh(docs, x) for x in ("_tkey", "_number", "_none"))
    chosen = (
        found.where("n_shingles > 0").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey")).alias("one"))
        .select(F.col("one.tkey").alias(key), F.coalesce("one.doc_id", F.lit(0)).alias(number), F.col("one.none").alias(none))
    )
    id_ = F.col(doc_id).cast("long")
    keyed = docs.withColumn(key, text_key(F.col(text))).withColumn(number, F.coalesce(id_, F.lit(0))).withColumn(none, id_.isNull())
    has_words = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    stays = keyed.where(has_words).join(chosen, [key, number, none], "left_semi")
    return stays.dropDuplicates([key, number, none]).unionByName(keyed.where(~has_words)).select(*docs.columns)
