"""Each stage against plain Python on a small table."""

import os
import random

import numpy as np

import corpus_pipeline as C
from noteledger.llm import quality as Q
from tests.llm.test_minhash import naive_set
from tests.llm.test_suffix_dedup import brute_across


def test_stages(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    found = []
    for i, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, sf_small).write.parquet(os.path.join(str(tmp_path), str(i)))
        docs = spark.read.parquet(os.path.join(str(tmp_path), str(i)))
        found.append(docs.collect())
        if i < len(C.STAGES) - 1:
            assert docs.columns == columns, name

    kept = {r.doc_id: r for r in found[0]}
    known = [r.doc_id for r in before if labels.get(r.doc_id) is not None]
    assert sum((i in kept) == (labels[i] == 1) for i in known) > 0.95 * len(known)
    assert all(kept[i] == r for r in before for i in [r.doc_id] if i in kept)

    sets = {r.doc_id: naive_set(r.text, 5) for r in found[0]}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    assert sorted(r.doc_id for r in found[1]) == sorted(i for i in ids if find(i) == i)

    texts = sorted((r.doc_id, r.text.encode()) for r in found[1])
    marked = dict(zip((i for i, _ in texts), brute_across([t for _, t in texts], C.PASSAGE_BYTES), strict=True))
    for r in found[2]:
        had = next(t for i, t in texts if i == r.doc_id)
        gone = marked[r.doc_id]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        for a, b in zip(edge[::2], edge[1::2], strict=True):
            if len(had[a:b].split()) < C.PASSAGE_WORDS:
                gone[a:b] = False
        removed = int(gone.sum())
        # a cut inside a character takes the character's other bytes with it
        assert 0 <= len(had) - len(r.text.encode()) - removed <= 6 * len(edge) * (removed > 0)
        assert r.n_chars == len(r.text)
    assert {r.doc_id for r in found[3]} == {r.doc_id for r in found[2]}
    assert sum(r.doc_tokens for r in found[3] if r.start == 0) == sum(r.length for r in found[3])


def test_planted_passages_go_and_others_stay(spark, sf_small):
    """Passages of 51 words and more in several documents; lines that a document repeats, and short shared runs."""
    rng = random.Random(51)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passages = [text(n) for n in (51, 52, 55, 60, 90, 300)]
    rows, planted, clean = [], {}, {}
    for i in range(60):
        if i < 36:
            planted[i] = passages[i % 6]
            rows.append((i, f"{text(120)} {planted[i]} {text(120)}"))
        elif i < 48:
            line = text(30)
            rows.append((i, f"{text(80)}\n{line}\n{line}\n{line}\n{text(50)} {passages[0][:120]}"))
            clean[i] = rows[-1][1]
        else:
            rows.append((i, text(250)))
            clean[i] = rows[-1][1]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in C.drop_repeated_passages(spark, docs, sf_small).collect()}
    for i, p in planted.items():
        words = p.split()
        assert not any(" ".join(words[k:k + 20]) in got[i] for k in range(len(words) - 19)), i
    assert all(got[i] == t for i, t in clean.items())


def test_run_writes_between_the_stages(spark, sf_small):
    plan = C.run(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "documents.parquet" not in plan and "labels.parquet" not in plan


def test_empty_tables(spark, sf_small, sf_dir):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(0)
    folder = sf_dir(documents=docs, labels=spark.read.parquet(f"{sf_small}/labels.parquet").limit(0))
    assert C.run(spark, folder).count() == 0


def test_nulls_and_extra_columns(spark, sf_small):
    docs = spark.createDataFrame([(None, None, None, None, None, "e"), (1, "", "en", "s", 0, "e"), (1, "", "en", "s", 0, "e"), (2, "some words " * 90, None, "s", 990, "e")],
                                 "doc_id long, text string, lang string, source string, n_chars long, score string")
    for name, stage in C.STAGES[:3]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns, name
        out.collect()
    C.STAGES[3][1](spark, docs, sf_small).collect()


def test_score_column_is_not_needed(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    model = Q.fit_quality(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_small}/labels.parquet"))
    assert Q.score_documents(docs, model).columns == [*docs.columns, "score", "predicted"]
