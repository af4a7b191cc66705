"""Run-metrics table: append, flatten, best, compare, prefix selection."""

import tempfile


from noteledger.operators import runs as H


def test_append_best_compare(spark):
    path = tempfile.mkdtemp(prefix="runs-", dir="/tmp") + "/runs"
    H.append_runs(H.run_rows(spark, "r1", {"model": "gbt"}, {"f1_micro": 0.2, "accuracy_I10": 0.9}), path)
    H.append_runs(H.run_rows(spark, "r2", {"model": "rf"}, {"f1_micro": 0.3, "accuracy_I10": 0.8},
                             {"stage": "eval"}), path)
    runs = H.read_runs(spark, path)
    best = [r.run_id for r in H.best_runs(runs, "f1_micro", 5).collect()]
    assert best == ["r2", "r1"]
    H.append_runs(H.run_rows(spark, "r1", {"model": "gbt2"}, {"f1_micro": 0.1}, step=1), path)
    runs = H.read_runs(spark, path)
    latest = {r.run_id: (r.f1_micro, r.model) for r in H.compare_runs(runs, None, ["f1_micro"], ["model"]).collect()}
    assert latest == {"r1": (0.1, "gbt2"), "r2": (0.3, "rf")}
    runs = runs.where("step = 0")
    cmp_ = {r.run_id: r.f1_micro for r in H.compare_runs(runs, ["r1", "r2"], ["f1_micro"]).collect()}
    assert cmp_ == {"r1": 0.2, "r2": 0.3}
    keys = {(r.run_id, r.key) for r in H.metrics_with_prefix(runs, "accuracy_").collect()}
    assert keys == {("r1", "accuracy_I10"), ("r2", "accuracy_I10")}


def test_repeated_appends_leave_one_copy(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = H.run_rows(spark, "r/1 é", {"model": "gbt"}, {"f1": 0.2, "loss": 1.5}, step=3)
    for _ in range(3):
        H.append_runs(first, path)
    assert H.read_runs(spark, path).count() == 3
    # entries of other keys and steps stay; one that is given again is replaced
    H.append_runs(H.run_rows(spark, "r/1 é", None, {"f1": 0.25}, step=3), path)
    H.append_runs(H.run_rows(spark, "r/1 é", None, {"f1": 0.3}, step=4), path)
    H.append_runs(H.run_rows(spark, "other", None, {"f1": 0.9}, step=3), path)
    got = {(r.run_id, r.step, r.key): r.num if r.kind == "metric" else r.value for r in H.read_runs(spark, path).collect()}
    assert got == {("r/1 é", 3, "model"): "gbt", ("r/1 é", 3, "f1"): 0.25, ("r/1 é", 3, "loss"): 1.5, ("r/1 é", 4, "f1"): 0.3, ("other", 3, "f1"): 0.9}


def test_flatten_numeric_two_levels(spark):
    df = spark.createDataFrame([("r", (3, "x", (1, 2.5, "y")))],
                               "run_id string, report struct<total:int, name:string, "
                               "sub:struct<a:int, b:double, c:string>>")
    got = {r.key: r.num for r in H.flatten_numeric(df, "run_id", "report", "data_quality").collect()}
    assert got == {"data_quality_total": 3.0, "data_quality_sub_a": 1.0, "data_quality_sub_b": 2.5}
