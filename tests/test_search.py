"""Grid with prefix scoring and Parzen proposals."""

import numpy as np
from pyspark.sql import functions as F

from noteledger.operators import boosting as B
from noteledger.operators import runs as H
from noteledger.operators import search as SE

from .test_boosting import frame, rows


def test_the_grid_is_whole():
    combos = SE.combinations(SE.GRID)
    assert len(combos) == 972 and len({tuple(c.values()) for c in combos}) == 972


def test_prefix_scores_are_those_of_short_fits(spark):
    df = frame(spark, rows()).withColumn("stratum", F.element_at("y_true", 1))
    grid = {"rounds": [3, 9], "rate": [0.1, 0.5], "depth": [2]}
    whole = {(r.rounds, r.rate): r.f1_micro_mean for r in SE.grid_search(df, "row_id", "features", "y_true", "stratum", grid, folds=3).collect()}
    assert len(whole) == 4
    for rounds in (3, 9):
        alone = SE.grid_search(df, "row_id", "features", "y_true", "stratum", {"rounds": [rounds], "rate": [0.1, 0.5], "depth": [2]}, folds=3).collect()
        assert all(abs(whole[rounds, r.rate] - r.f1_micro_mean) < 1e-9 for r in alone)
    ranked = [r.f1_micro_mean for r in SE.grid_search(df, "row_id", "features", "y_true", "stratum", grid, folds=3).collect()]
    assert ranked == sorted(ranked, reverse=True)


def test_a_dealt_out_fit_equals_the_split_one(spark):
    df = frame(spark, rows()).withColumn("fold", (F.col("row_id") % 2).cast("int"))
    sample = SE.Sample.of(df, "row_id", "features", "y_true", 1000, "fold")
    s = B.Settings(rounds=6, depth=3)
    counts = {r.fold: (r.tp, r.fp, r.fn) for r in SE.judged(sample, [(s, [6])], [0, 1]).collect()}
    base = B.fit_frame(df, "row_id", "features", "y_true", sample.edges, "fold")
    for fold in (0, 1):
        models = B.fit_tasks(base, [B.Task(k, s, fold, fold) for k in range(3)], sample.edges, None)
        held = [r for r in rows() if r[0] % 2 == fold]
        said = B.margins_of(models, np.array([r[1] for r in held])) > 0
        truth = np.array([r[2] for r in held]) == 1
        assert counts[fold] == ((said & truth).sum(), (said & ~truth).sum(), (~said & truth).sum())


def test_settings_of_a_grid_are_fitted_on_their_own_rows(spark):
    df = frame(spark, rows()).withColumn("stratum", F.element_at("y_true", 1))
    grid = {"rounds": [4], "depth": [2], "subsample": [0.5, 1.0]}
    whole = {r.subsample: r for r in SE.grid_search(df, "row_id", "features", "y_true", "stratum", grid, folds=2).collect()}
    assert set(whole) == {0.5, 1.0} and all(r.folds == 2 and 0 < r.f1_micro_mean <= 1 for r in whole.values())
    for share, r in whole.items():
        assert SE.grid_search(df, "row_id", "features", "y_true", "stratum", {**grid, "subsample": [share]}, folds=2).collect() == [r]


def test_held_rows_are_fitted_as_rows_read(spark):
    df = frame(spark, rows(60))
    x = np.array([r[1] for r in rows(60)])
    edges = B.bin_edges(df, "features", x.shape[1])
    got = B.fit_frame(df.withColumn("fold", (F.col("row_id") % 3).cast("int")), "row_id", "features", "y_true", edges, "fold").coalesce(1).toArrow()
    task = B.Task(1, B.Settings(rounds=5, depth=3, subsample=0.7), 2)
    read = B.Block(iter(got.to_batches()), [task])
    held = B.Block.of(read.bins, read.labels, read.fold, read.pick)
    assert SE.fit_one(held, task, edges, [2, 5]) == SE.fit_one(read, task, edges, [2, 5])


def hill(asked):
    """Best at rate 0.05, depth 5 and min_child_weight 2."""
    return [1 / (1 + 40 * abs(np.log(s["rate"] / 0.05)) + abs(s["depth"] - 5) + 0.5 * abs(s["min_child_weight"] - 2) + 2 * abs(s["subsample"] - 0.8)) for s in asked]


def test_parzen_beats_independent_draws():
    ahead = 0
    for seed in range(20):
        parzen = max(v for _, v in SE.parzen_search(hill, trials=50, seed=seed))
        drawn = max(v for _, v in SE.random_search(hill, trials=50, seed=seed))
        ahead += parzen > drawn
    assert ahead >= 16


def test_proposals_stay_in_the_space():
    for settings, _ in SE.parzen_search(hill, trials=40, seed=3):
        for k, (kind, lo, hi) in SE.SPACE.items():
            assert lo <= settings[k] <= hi and isinstance(settings[k], int if kind == "int" else float)


def test_an_interrupted_search_goes_on_as_it_would_have(spark, tmp_path):
    whole = SE.parzen_search(hill, trials=23, seed=1, batch=4)
    path = str(tmp_path / "runs")
    for i, (s, v) in enumerate(whole[:14]):
        H.append_runs(SE.trial_rows(spark, "s", i, s, v), path)
    history = SE.trial_history(H.read_runs(spark, path), "s")
    assert history == whole[:14]
    assert SE.parzen_search(hill, trials=23, seed=1, batch=4, history=history) == whole


def test_boosted_search_keeps_its_trials(spark, tmp_path):
    df = frame(spark, rows(80)).withColumn("is_val", F.col("row_id") % 4 == 0)
    space = {"rounds": ("int", 2, 6), "depth": ("int", 1, 3), "rate": ("float", 0.05, 0.5)}
    path = str(tmp_path / "runs")
    first = SE.boosted_search(df, "row_id", "features", "y_true", "is_val", space, trials=4, batch=2, runs_path=path).collect()
    again = SE.boosted_search(df, "row_id", "features", "y_true", "is_val", space, trials=6, batch=2, runs_path=path).collect()
    assert {r.trial: r.f1_micro for r in first}.items() <= {r.trial: r.f1_micro for r in again}.items()
    assert H.read_runs(spark, path).where("key = 'f1_micro'").count() == 6


def test_boosted_search_goes_on_with_proposals(spark):
    df = frame(spark, rows(80)).withColumn("is_val", F.col("row_id") % 4 == 0)
    space = {"rounds": ("int", 1, 3), "depth": ("int", 1, 2), "subsample": ("float", 0.6, 1.0)}
    found = SE.boosted_search(df, "row_id", "features", "y_true", "is_val", space, trials=12, batch=6).collect()
    assert sorted(r.trial for r in found) == list(range(12)) and all(0 < r.f1_micro <= 1 for r in found)
    by = sorted(found, key=lambda r: r.trial)
    history = [({k: r[k] for k in space}, r.f1_micro) for r in by[:6]]
    # the second batch has two trials after the ten random ones
    assert [{k: r[k] for k in space} for r in by[:10]] == [SE.propose([], space, np.random.default_rng([42, i])) for i in range(10)]
    mean = float(np.mean([v for _, v in history]))
    for i in (10, 11):
        asked = history + [({k: r[k] for k in space}, mean) for r in by[6:i]]
        settings = SE.propose(asked, space, np.random.default_rng([42, i]))
        assert settings["rounds"] == by[i].rounds and settings["depth"] == by[i].depth and abs(settings["subsample"] - by[i].subsample) < 1e-9


def test_a_batch_of_all_trials_is_independent_draws(spark):
    df = frame(spark, rows(80)).withColumn("is_val", F.col("row_id") % 4 == 0)
    space = {"rounds": ("int", 1, 3), "depth": ("int", 1, 2), "subsample": ("float", 0.6, 1.0)}
    found = SE.boosted_search(df, "row_id", "features", "y_true", "is_val", space, trials=5, batch=5).collect()
    drawn = [s for s, _ in SE.random_search(lambda asked: [0.0] * len(asked), space, trials=5)]
    assert [{k: r[k] for k in space} for r in sorted(found, key=lambda r: r.trial)] == drawn
    assert [r.f1_micro for r in found] == sorted((r.f1_micro for r in found), reverse=True) and found[-1].f1_micro > 0
