import numpy as np
import pytest

from noteledger.llm import quality as Q
from noteledger.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_small):
    out = QUERIES["op1_additive_quality"](spark, sf_small)
    labels = spark.read.parquet(f"{sf_small}/labels.parquet").select("doc_id", "quality")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert out.count() == spark.read.parquet(f"{sf_small}/documents.parquet").count()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_never_learns_from_held_out(spark):
    docs = spark.createDataFrame([(i, "good words here. " * 5 if i % 2 else "###!!! " * 9) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    held = {r.doc_id for r in docs.where(Q.held_out(docs.doc_id)).collect()}
    flipped = spark.createDataFrame([(i, (1 - i % 2) if i in held else i % 2) for i in range(60)], "doc_id long, quality int")
    one, two = (Q.fit_quality(docs, x) for x in (labels, flipped))
    assert one.base == two.base and all((a == b).all() for a, b in zip(one.tables, two.tables, strict=True))


def test_bounded_sample_and_odd_rows(spark):
    rows = [(None, "x", "a"), (1, None, "b"), (1, None, "b"), (2, "", None), (3, "word " * 50_000, "c"), (4, "one", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 0), (4, 1), (None, 1), (99, 1)], "doc_id long, quality int")
    model = Q.fit_quality(docs, labels, max_sample=2)
    scored = Q.score_documents(docs.select("doc_id", "text"), model).collect()
    assert len(scored) == 6 and all(0 <= r.score <= 1 for r in scored)
    empty = Q.fit_quality(docs.limit(0), labels)
    assert empty.score(np.zeros((1, len(Q.FEATURES))))[0] == 0.5
    assert Q.score_documents(docs.limit(0).select("doc_id", "text"), empty).count() == 0


def test_trees_find_the_best_cuts():
    g, h = np.array([1.0, 1, -3, -3, 2]), np.ones(5)
    values = Q.two_cut_tree(g, h)
    assert values[0] == values[1] and values[2] == values[3] and values[4] > 0 > values[2] and values[0] > 0
    gain, table = Q.quadrants(np.array([[5.0, -5], [-5, 5]]), np.ones((2, 2)))
    assert gain > 0 and table[0, 0] == table[1, 1] == pytest.approx(2.5) and table[0, 1] < 0


def test_pairs_model_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = Q.fit(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.9


def plain_score(model, text):
    """A text's score by looking up one entry after the other."""
    x = Q.text_features(text)

    def place(edges, v):  # the number of edges that are not above the value
        return sum(e <= v for e in edges)

    z = float(model.base)
    for j, table in enumerate(model.tables):
        z += float(table[place(model.edges[j], x[j])])
    for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
        z += float(table[place(model.pair_edges[a], x[a])][place(model.pair_edges[b], x[b])])
    return 1 / (1 + np.exp(-z))


def test_scores_equal_a_plain_scorer(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    model = Q.fit_quality(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    assert model.pairs
    for r in Q.score_documents(docs, model).collect():
        assert r.score == pytest.approx(plain_score(model, r.text), abs=1e-9)


def test_two_cut_tree_against_all_cuts():
    rng = np.random.default_rng(2)
    for _ in range(30):
        n = int(rng.integers(2, 9))
        g, h = rng.normal(size=n), rng.random(n) + 0.1
        parts = lambda i, j: [p for p in (slice(0, i), slice(i, j), slice(j, n)) if p.start < p.stop]
        gain = lambda cuts: sum(g[p].sum() ** 2 / (h[p].sum() + Q.PRIOR) for p in cuts)
        best = max(gain(parts(i, j)) for i in range(n + 1) for j in range(i, n + 1))
        values = Q.two_cut_tree(g, h)
        edges = [0, *(np.flatnonzero(np.diff(values)) + 1), n]
        assert len(edges) <= 4
        # the tree's own partition reaches that gain, and its values are the leaves' steps
        assert gain([slice(a, b) for a, b in zip(edges, edges[1:])]) == pytest.approx(best, abs=1e-9)


def test_clashing_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, "some text", "s", -1), (2, None, "t", -1)], "doc_id long, text string, score string, predicted int")
    model = Q.fit_quality(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    got = Q.score_documents(docs, model)
    assert got.columns == docs.columns
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got.collect())
