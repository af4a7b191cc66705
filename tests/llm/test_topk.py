import random

import pytest
from pyspark.sql import functions as F

from noteledger.llm import topk as T


def brute(rows, k):
    import math

    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, (i, v) in enumerate(ok):
        if i % 5 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for c, (j, w) in enumerate(ok) if c != q and len(w) == len(v))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize(("shard_rows", "query_tile"), [(8192, 4096), (7, 3)])
def test_matches_brute_force(spark, monkeypatch, shard_rows, query_tile):
    monkeypatch.setattr(T, "STRIP", 2)
    monkeypatch.setattr(T, "MERGE", 3)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.5, 0.25, 0.0]) for _ in range(4)]) for i in range(60)]
    rows += [(100, [0.3, None, 0.1, 0.2]), (105, None), (110, [float("nan")] * 4), (115, [float("inf")] * 4), (None, [0.5] * 4), (120, [0.5, 0.5]), (125, [0.1, 0.2]), (130, [])]
    rows += [(5, list(rows[5][1])), (5, [0.125] * 4)]  # a repeated row and a repeated id
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = T.top_k(df, F.col("vec_id") % 5 == 0, 3, shard_rows=shard_rows, query_tile=query_tile).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3)


def test_large_products_stay_exact(spark):
    big = 2.0**40
    rows = [(0, [big, 1.0]), (1, [16.0, 1 / 256]), (2, [16.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in T.top_k(df, F.col("vec_id") == 0, 2).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2**60 + 256), (0, 2, 2, 2**60)]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert T.top_k(df, F.col("vec_id") % 50 == 0).count() == 0
