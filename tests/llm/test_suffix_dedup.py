import hashlib
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest

from noteledger.llm import common
from noteledger.llm import suffix_dedup as S
from noteledger.llm.queries import QUERIES


def brute(texts, length):
    seen = Counter(t[s:s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if seen[t[s:s + length]] > 1:
                gone[s:s + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def brute_across(texts, length):
    """Texts without the bytes of strings that start in two different texts."""
    where = {}
    for t in texts:
        for s in range(len(t) - length + 1):
            where.setdefault(t[s:s + length], set()).add(t)
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if len(where[t[s:s + length]]) > 1:
                gone[s:s + length] = True
        out.append(gone)
    return out


def made_texts(rng, n, length):
    base = ["".join(rng.choice("abcd é") for _ in range(rng.randint(length, 4 * length))) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            b = rng.choice(base)
            a = rng.randint(0, len(b))
            parts.append(b[a:a + rng.randint(0, 3 * length)])
            parts.append("".join(rng.choice("xyz") for _ in range(rng.randint(0, 5))))
        texts.append("".join(parts))
    return texts + ["", "ab" * length * 2, "q" * 3 * length, texts[0], texts[0]]


@pytest.mark.parametrize("length", [40, 60, 400])
def test_matches_brute_force(spark, length):
    rng = random.Random(length)
    texts = made_texts(rng, 40, length)
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)] + [(900, None, "", 0)], "doc_id long, text string, core string, u1 int")
    got = {r.doc_id: tuple(r)[1:] for r in S.repeated_bytes(docs, length).collect()}
    want = brute([t.encode() for t in texts], length)
    assert [got[i] for i in range(len(texts))] == want
    assert got[900] == (0, 0, 0, hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("hot", [3, 10**6])
def test_strings_of_two_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    rng = random.Random(hot)
    texts = made_texts(rng, 60, 40) + ["own " * 60, "own " * 90 + "x"]
    texts = [t.encode("ascii", "replace").decode() for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in S.remove_repeats(docs, 40, across=True).collect()}
    for (i, t), gone in zip(enumerate(texts), brute_across([t.encode() for t in texts], 40), strict=True):
        assert got[i].encode() == bytes(np.frombuffer(t.encode(), np.uint8)[~gone])
    # runs of fewer words stay
    got = {r.doc_id: r.text for r in S.remove_repeats(docs, 40, across=True, least_words=6).collect()}
    for (i, t), gone in zip(enumerate(texts), brute_across([t.encode() for t in texts], 40), strict=True):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        data = t.encode()
        for a, b in zip(edge[::2], edge[1::2]):
            if len(data[a:b].split()) < 6:
                gone[a:b] = False
        assert got[i].encode() == bytes(np.frombuffer(data, np.uint8)[~gone])


@pytest.mark.parametrize(("hot", "most"), [(3, 7), (10**6, 5)])
def test_few_tables_are_written(spark, monkeypatch, hot, most):
    """Every part of a written table is a file, and an executor starts processes for each."""
    monkeypatch.setattr(S, "HOT", hot)
    written = []
    monkeypatch.setattr(S, "checkpoint", lambda df: written.append(df.columns) or common.checkpoint(df))
    texts = made_texts(random.Random(5), 30, 40)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in S.repeated_bytes(docs, 40).collect()}
    assert [got[i] for i in range(len(texts))] == brute([t.encode() for t in texts], 40)
    assert len(written) <= most


def test_what_a_text_repeats_within_itself_stays(spark):
    rng = random.Random(8)
    line = " ".join(str(rng.randint(0, 999)) for _ in range(40))
    docs = spark.createDataFrame([(1, f"{line}\n{line}\n{line}"), (2, "something else"), (3, f"{line}x"), (4, "q" * 900)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in S.remove_repeats(docs.where("doc_id <> 3"), 60, across=True).collect()}
    assert got[1] == f"{line}\n{line}\n{line}" and got[4] == "q" * 900
    got = {r.doc_id: r.text for r in S.remove_repeats(docs, 60, across=True).collect()}
    assert line[10:50] not in got[1] and got[3].strip() in ("x", "") and got[4] == "q" * 900


def test_hot_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 3)
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdef ") for _ in range(70))
    texts = ["".join(rng.choice("xyzw") for _ in range(30)) + passage + "".join(rng.choice("uvt") for _ in range(30)) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in S.repeated_bytes(docs, 40).collect()}
    assert [got[i] for i in range(30)] == brute([t.encode() for t in texts], 40)


def test_windows_of_hot_groups_are_made_in_bounded_frames():
    made, n = [], 3_000
    batch = pd.DataFrame({"core": 1, "whole": range(n), "n": 1, "lo": 1, "hi": 2, "windows": 5, "lefts": [b"abcd"] * n, "rights": [b"%d" % i for i in range(n)]})

    class Seen(Exception):
        pass

    def first(rows, _):
        made.extend(rows(iter([batch])))
        raise Seen

    with pytest.raises(Seen):
        S.count_windows(SimpleNamespace(mapInPandas=first), 40)
    assert sum(map(len, made)) == 5 * n and max(map(len, made)) <= 5 * 256
    assert [w for x in made for w in x["whole"]] == [w for w in range(n) for _ in range(5)]


def test_chunks_keep_groups_whole(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 5)
    texts = made_texts(random.Random(9), 30, 40)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in S.repeated_bytes(docs, 40).collect()}
    assert [got[i] for i in range(len(texts))] == brute([t.encode() for t in texts], 40)


def test_slices_of_long_texts(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("ab ") for _ in range(3000)).encode()
    whole = S.segments(text, 50)
    monkeypatch.setattr(S, "SLICE", 700)
    cut = S.segments(text, 50)
    # every window is in one segment, at the same distance from its core
    windows = lambda s: {(a + i, a + d - (a + i)) for _, _, a, d, n in s.T.tolist() for i in range(n)}
    assert windows(whole) == windows(cut) and len(windows(whole)) == 3000 - 49


def test_null_ids_repeats_and_empty_tables(spark):
    t = "".join(random.Random(1).choice("abc") for _ in range(100))
    docs = spark.createDataFrame([(None, t), (5, t), (5, t), (6, "short")], "doc_id long, text string")
    rows = S.repeated_bytes(docs, 40).collect()
    assert sorted(r.n_removed for r in rows) == [0, 100, 100, 100]
    assert S.repeated_bytes(docs.limit(0), 40).count() == 0
    left = S.remove_repeats(docs.withColumn("spans", docs.doc_id), 40)
    assert left.columns == ["doc_id", "text", "spans"] and sorted(r.text for r in left.collect()) == ["", "", "", "short"]


def test_query_on_small_table(spark, sf_small):
    texts = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op2_suffix_dedup"](spark, sf_small).collect()}
    assert [got[i] for i, _ in texts] == brute([t for _, t in texts], 400)
