import random
import zlib

from pyspark.sql import functions as F

from noteledger.llm import sharding as SH
from noteledger.llm.common import number_within
from noteledger.llm.queries import QUERIES


def brute_capacity(sizes, n):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, shards, held = (low + high) // 2, 1, 0
        for s in sizes:
            if held + s > mid:
                shards, held = shards + 1, 0
            held += s
        low, high = (low, mid) if shards <= n else (mid + 1, high)
    return low


def groups(spark, sizes):
    rows = [(f"{i:032x}"[::-1], s) for i, s in enumerate(sizes)]
    return spark.createDataFrame(rows, "key string, size long"), [s for _, s in sorted(rows)]


def test_smallest_capacity(spark):
    rng = random.Random(1)
    for n, sizes in ((16, [rng.randint(1, 900) for _ in range(300)]), (4, [5, 1, 1]), (3, [1000] + [1] * 50), (16, [7]), (5, [rng.choice([1, 10_000]) for _ in range(60)])):
        frame, ordered = groups(spark, sizes)
        assert SH.smallest_capacity(SH.RunningSums(frame), n) == brute_capacity(ordered, n)


def check(rows, n, texts):
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r.slot)
        assert 0 <= r.shard < n and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    place = {}
    for r in rows:
        for t in texts[r.doc_id]:
            body = (t or "").encode()
            if (r.size, r.text_crc32) == (len(body) + 1, zlib.crc32(body)):
                assert place.setdefault(t, r.shard) == r.shard


def test_query(spark, sf_small):
    rows = QUERIES["op4_minimax_shards"](spark, sf_small).collect()
    texts = {r.doc_id: [r.text] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    check(rows, 16, texts)
    sizes = {}
    for r in rows:
        sizes[texts[r.doc_id][0]] = sizes.get(texts[r.doc_id][0], 0) + r.size
    bytes_ = {}
    for r in rows:
        bytes_[r.shard] = bytes_.get(r.shard, 0) + r.size
    import hashlib

    ordered = [s for _, s in sorted((hashlib.md5(t.encode()).hexdigest(), s) for t, s in sizes.items())]
    assert len(rows) == len(texts) and max(bytes_.values()) == brute_capacity(ordered, 16)


def test_odd_rows(spark):
    rows = [(None, "a", 1), (None, "a", 1), (1, None, 2), (2, "", 3), (2, "", 3), (3, "é" * 5000, 4)] + [(10 + i, "hot", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = SH.shard_slots(docs.drop("shard"), 4).collect()
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append(t)
    assert len(got) == len(rows)
    check(got, 4, texts)
    assert SH.shard_slots(docs.limit(0).drop("shard"), 4).count() == 0
    assert sorted(r.size for r in got if r.doc_id in (1, 2, 3)) == [1, 1, 1, 10001]


def test_extra_columns_survive_assignment(spark):
    docs = spark.createDataFrame([(1, "x", "keep")], "doc_id long, text string, law string")
    assert SH.assign_shards(docs, 2).select("law", "shard").first() == ("keep", 0)


def test_clashing_columns_are_replaced(spark):
    docs = spark.createDataFrame([(i, "x" * i, "s", -1, "k", 5) for i in range(9)], "doc_id long, text string, shard string, size int, text_key string, slot int")
    got = SH.assign_shards(docs, 3)
    assert got.columns == docs.columns
    assert all(r.size == r.doc_id + 1 and 0 <= r.shard < 3 and len(r.text_key) == 32 and r.slot == 5 for r in got.collect())
    check(SH.shard_slots(docs, 3).collect(), 3, {i: ["x" * i] for i in range(9)})


def test_number_within(spark):
    df = spark.range(1000).withColumn("g", (F.col("id") % 7 == 0).cast("int")).repartition(9)
    rows = number_within(df, "g", "at", ["id"]).collect()
    for g in (0, 1):
        at = sorted(r["at"] for r in rows if r.g == g)
        assert at == list(range(len(at)))
