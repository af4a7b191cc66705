import random
import re
from itertools import combinations

import numpy as np

from noteledger.llm import minhash as M
from noteledger.llm.components import components


def naive_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, num, den):
    sets = [naive_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = min(doc_id, low.get(find(i), doc_id))
    return [(len(sets[i]), low.get(find(i))) for i in range(len(rows))]


def near_copies(rng, n, words, edits):
    base = [f"w{rng.randint(0, 500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"e{rng.randint(0, 9999)}"
        out.append(" ".join(copy))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(5)
    texts = near_copies(rng, 40, 120, 6) + near_copies(rng, 30, 60, 5) + near_copies(rng, 30, 300, 20)
    texts += ["", " \t\n", "One", "one", "ONE two", "one  two", "É a b c", "é a b c", "\x1f a b c", texts[0], texts[0].upper(), "a b c " * 30_000]
    rng.shuffle(texts)
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)] + [(7, texts[3]), (7, texts[3]), (1000, None), (1000, None)]
    docs = spark.createDataFrame([(i, t, 1, "b", "x") for i, t in rows], "doc_id long, text string, n int, bucket string, tkey string")
    for k, num in ((3, 85), (5, 80)):
        got = M.near_duplicates(docs, k, num, 100).collect()
        want = brute(rows, k, num, 100)
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
            (str(i), n, str(c if n else i)) for (i, _), (n, c) in zip(rows, want, strict=True))
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_links_found_without_the_leader(spark, monkeypatch):
    """A chain: neighbours are linked, ends are not, so leaders alone do not join it."""
    monkeypatch.setattr(M, "BLOCK", 4)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[3 * i:3 * i + 120]) for i in range(20)]
    rows = list(enumerate(texts))
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, 100).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for (i, _), (_, c) in zip(rows, brute(rows, 3, 85, 100), strict=True)}


def test_pruning_keeps_what_reaches_the_threshold():
    least = M.least_matches(0.85)
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**32, (4000, M.HASHES), dtype=np.uint32)
    same = rng.random(a.shape) < 0.85
    b = np.where(same, a, a + 1)
    kept, _ = M.survivors(a, b, least)
    assert len(kept) >= 3999
    kept, _ = M.survivors(a, np.where(rng.random(a.shape) < 0.4, a, a + 1), least)
    assert len(kept) == 0


def test_bands_meet_the_miss_probability():
    for t in (0.5, 0.8, 0.85, 0.95):
        rows, n = M.bands(t)
        assert rows * n <= M.HASHES and (1 - t**rows) ** n <= M.MISS


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 9), (10, 9), (4, 4), *[(100 + i, 101 + i) for i in range(30)]], "a long, b long")
    got = {r.id: r.comp for r in components(links).collect()}
    assert got[3] == 1 and got[10] == 8 and {got[100 + i] for i in range(31)} == {100} and 4 not in got
    assert components(links.limit(0)).count() == 0


def test_keep_one(spark):
    t = "some words that are long enough to make shingles of five"
    docs = spark.createDataFrame([(3, t, "a"), (2, t, "b"), (2, t, "c"), (None, t, "d"), (5, "", "e"), (6, None, "f"), (7, "other text of some more words", "g")],
                                 "doc_id long, text string, _key string")
    kept = M.keep_one(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "5", "6", "7"]
    assert M.keep_one(docs.limit(0)).count() == 0
