"""Multi-label metrics on FIXTURES.md section 5 and against brute force."""

import random

import pytest

from noteledger.operators import metrics as M


@pytest.fixture(scope="module")
def wide(spark):
    # scores chosen so that '> 0.5' gives y_pred = [1 1 0] and [0 0 1]
    rows = [(1, [0.9, 0.7, 0.2], [1, 0, 1]), (2, [0.1, 0.3, 0.8], [0, 0, 1])]
    return spark.createDataFrame(rows, "row_id long, scores array<double>, y_true array<int>")


def test_fixture_metrics(wide):
    long = M.with_prediction(M.to_long(wide, codes=["a", "b", "c"]), 0.5)
    mi = M.micro_prf(long).collect()[0]
    assert (mi.tp, mi.fp, mi.fn, mi.tn) == (2, 1, 1, 2)
    assert mi.precision_micro == mi.recall_micro == mi.f1_micro == round(2 / 3, 6)
    el = M.element_metrics(long).collect()[0]
    assert el.element_accuracy == round(4 / 6, 6) and el.hamming_loss == round(2 / 6, 6)
    assert M.subset_accuracy(wide, 0.5).collect()[0].subset_accuracy == 0.5
    ma = M.macro_prf(long).collect()[0]
    assert (ma.precision_macro, ma.recall_macro, ma.f1_macro) == (round(2 / 3, 6), 0.5, round(5 / 9, 6))
    acc = {r.code: r.accuracy for r in M.label_accuracy(long).collect()}
    assert acc == {"a": 1.0, "c": 0.5}
    st = M.label_accuracy_stats(long).collect()[0]
    assert st.per_label_accuracy_min == 0.5 and st.per_label_accuracy_max == 1.0


def _auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return u / (len(pos) * len(neg))


def test_auc_and_roc_points_match_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, k, round(rng.random(), 2), int(rng.random() < 0.3)) for i in range(300) for k in range(3)]
    long = spark.createDataFrame(rows, "row_id long, label int, score double, y_true int")
    got = M.roc_auc_micro(long).collect()[0].roc_auc_micro
    assert got == round(_auc([(s, y) for _, _, s, y in rows]), 6)
    per = {r.label: r.roc_auc for r in M.roc_auc_by_label(long).collect()}
    for k in range(3):
        assert per[k] == round(_auc([(s, y) for _, kk, s, y in rows if kk == k]), 6)
    pts = M.roc_points(long).where("label = 1").collect()
    sub = [(s, y) for _, kk, s, y in rows if kk == 1]
    for p in pts:
        assert p.tp == sum(1 for s, y in sub if s >= p.threshold and y == 1)
        assert p.fp == sum(1 for s, y in sub if s >= p.threshold and y == 0)


def test_sparse_micro_equals_dense(spark, wide):
    long = M.with_prediction(M.to_long(wide), 0.5)
    truth = long.where("y_true = 1").select("row_id", "label")
    pred = long.where("y_pred = 1").select("row_id", "label")
    s = M.sparse_micro(truth, pred, 2, 3).collect()[0]
    d = M.micro_prf(long).collect()[0]
    assert tuple(s) == tuple(d)


def test_hamming_is_one_minus_accuracy(spark):
    rng = random.Random(3)
    rows = [(i, [rng.random() for _ in range(4)], [int(rng.random() < .4) for _ in range(4)]) for i in range(50)]
    w = spark.createDataFrame(rows, "row_id long, scores array<double>, y_true array<int>")
    long = M.with_prediction(M.to_long(w), 0.5)
    el = M.element_metrics(long).collect()[0]
    assert abs(el.element_accuracy + el.hamming_loss - 1.0) < 1e-6
    c = M.confusion_by_label(long).collect()
    assert all(r.tp + r.fp + r.fn + r.tn == 50 for r in c)
