import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noteledger.llm import class_lm as L
from noteledger.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, word string, c int, score double, rid long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    out, word = [], ""
    for c in (text or "").translate(LOWER) + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return [*out, ""]


def is_held(doc_id):
    return doc_id is not None and crc32(str(doc_id).encode()) % 7 == 2


def corpus(rng, n):
    """Sentences whose words come from a few groups in a fixed order."""
    groups = [[f"{g}{i}{e}" for i in range(12)] for g, e in (("det", "a"), ("adj", "ous"), ("noun", "ness"), ("verb", "ing"))]
    out = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(1, 12)):
            text += " ".join(rng.choice(g) for g in groups) + rng.choice([" ", "\n", "\t", "  "])
        if rng.random() < 0.2:
            text += f"Rare{rng.randint(0, 400)}ness "
        out.append((i, text, "clash", 1, 0.0, 7))
    return out


def expected_base(rows):
    counts = Counter(t for d, text, *_ in rows if not is_held(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, text, *_ in rows:
        found = tokens(text)
        out.append((d is None, d or 0, is_held(d), len(found), sum(counts[t] > 0 for t in found), n, round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in found), 6)))
    return sorted(out)


def shown(frame):
    return sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in frame.collect())


@pytest.mark.parametrize("lookup", [4, 30, 10**6])
def test_counts_and_base(spark, lookup):
    rows = corpus(random.Random(1), 150) + [(None, "Deta0 unseen", None, None, None, None), (900, None, "", 0, 0.0, 0), (901, "", "", 0, 0.0, 0), (902, " \x0b\x0c ", "", 0, 0.0, 0), (903, "É É é x" + "y" * 50_000, "", 0, 0.0, 0)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = L.language_model_scores(df, units=20, groups=8, k=6, rounds=2, lookup=lookup)
    assert shown(got) == expected_base(rows)


def test_lookup_and_join_agree(spark):
    rows = corpus(random.Random(4), 120)
    df = spark.createDataFrame(rows, SCHEMA)
    # as many units in both, whose words all tasks know in either
    few, many = ({r.doc_id: r.score for r in L.language_model_scores(df, units=5, groups=8, k=6, rounds=2, lookup=x).collect()} for x in (25, 10**6))
    assert few.keys() == many.keys() and all(abs(few[i] - many[i]) < 1e-6 for i in few)


def test_partitions_do_not_matter(spark):
    df = spark.createDataFrame(corpus(random.Random(14), 150), SCHEMA)
    one, other = ({r.doc_id: r.score for r in L.language_model_scores(df.repartition(n), units=30, groups=8, k=6, rounds=3).collect()} for n in (1, 7))
    assert one.keys() == other.keys() and all(abs(one[i] - other[i]) < 1e-6 for i in one)


def fitted(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA).where(~L.held_out(F.col("doc_id")))
    counts = L.word_counts(df.select("text")).cache()
    return L.fit(df, counts, **settings), {r.word: r.c for r in counts.collect()}


def test_probabilities_sum_to_one(spark):
    model, counts = fitted(spark, corpus(random.Random(2), 100), units=15, groups=5, k=7, rounds=2)
    known = model.known
    words = pa.array([w for w in counts if w], pa.string())
    unit = known.unit_of(words, known.places(words))
    mass = np.bincount(model.classes[unit], [counts[w.as_py()] + 1 for w in words], minlength=7)
    mass += np.bincount(model.classes[1 + known.units:], minlength=7)  # one unseen word for each shared unit
    mass[0] += counts[""] + 1
    total = (10 ** model.log_steps * mass).sum(axis=1)
    assert np.allclose(total, 1)


def test_scores_follow_the_model(spark):
    rows = corpus(random.Random(6), 80)
    model, counts = fitted(spark, rows, units=30, groups=6, k=5, rounds=2)
    df = spark.createDataFrame(rows, SCHEMA)
    table = spark.createDataFrame([(w, c) for w, c in counts.items()], "word string, c long")
    got = {r.doc_id: r.score for r in L.score_texts(df, table, model).collect()}
    for d, text, *_ in rows:
        total, before = 0.0, 0
        for t in tokens(text):
            word = pa.array([t], pa.string())
            unit = int(model.known.unit_of(word, model.known.places(word))[0]) if t else 0
            now = model.classes[unit]
            total += model.log_steps[before, now] + math.log10(counts.get(t, 0) + 1)
            before = now
        assert abs(got[d] - total) < 1e-6


def test_classes_beat_the_base_on_held_out_texts(spark):
    rows = corpus(random.Random(7), 400)
    scored = L.language_model_scores(spark.createDataFrame(rows, SCHEMA), units=60, groups=16, k=8, rounds=4).cache()
    r = L.perplexity(scored).first()
    assert r.perplexity < 0.5 * r.base_perplexity
    # the four groups of words are found
    model, _ = fitted(spark, rows, units=48, groups=4, k=6, rounds=6)
    found = {}
    for w, c in zip(model.known.words.to_pylist()[:48], model.classes[1:49].tolist()):
        found.setdefault(w[:3], Counter())[c] += 1
    assert sum(max(c.values()) for c in found.values()) >= 40


def test_exchange_step_is_the_best_of_all(spark):
    rng = np.random.default_rng(3)
    n, k = 12, 4
    counts = rng.integers(0, 9, (n, n))
    classes = 1 + np.arange(n) % (k - 1)
    classes[0] = 0

    def table(classes):
        out = np.zeros((k, k))
        np.add.at(out, (classes[:, None].repeat(n, 1), classes[None, :].repeat(n, 0)), counts)
        return out

    for unit in range(1, n):
        pairs, moved = table(classes), classes.copy()
        all_ = np.arange(n)
        L.exchange(pairs, moved, unit, all_[counts[unit] > 0], counts[unit][counts[unit] > 0], all_[counts[:, unit] > 0], counts[:, unit][counts[:, unit] > 0])
        assert np.allclose(pairs, table(moved))
        tries = []
        for c in range(1, k):
            other = classes.copy()
            other[unit] = c
            tries.append(L.likelihood(table(other)))
        assert abs(L.likelihood(pairs) - max(tries)) < 1e-6
        classes = moved


def test_nothing_to_learn_from(spark):
    held = [(i, "some words here", "", 0, 0.0, 0) for i in range(60) if is_held(i)]
    got = L.language_model_scores(spark.createDataFrame(held, SCHEMA)).collect()
    assert len(got) == len(held)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 4, 0, 0)
        assert r.base_score == 0 and r.score <= 0 and math.isfinite(r.score)
    assert L.language_model_scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_scores_all_documents(spark, sf_dir):
    rows = corpus(random.Random(9), 60)
    got = QUERIES["op12_class_lm"](spark, sf_dir(documents=spark.createDataFrame(rows, SCHEMA)))
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert shown(got) == expected_base(rows)
