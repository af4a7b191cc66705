"""Model selection of boosted trees: grid with prefix scoring, and tree-structured Parzen proposals.

Both judge settings by the micro F1 of predictions at 0.5 on rows that were not
fitted. Fits of different settings, folds and labels do not depend on each
other: they are dealt out as rows of a table, one fit per row, over one binned
sample of at most ``rows`` records (drawn by a hash of the id) that every task
holds. Larger fits go through :func:`boosting.fit_tasks`, which splits the rows.

Prefix scoring: a fit of n rounds holds all shorter ones, so settings that differ
in their rounds alone are one fit, scored after each of the wanted rounds.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterator
from dataclasses import asdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting as B
from . import runs as H
from .split import sample_rows, stratified_fold

#: The reference's grid.
GRID = {
    "rounds": [50, 100, 200],
    "rate": [0.01, 0.05, 0.1, 0.2],
    "depth": [4, 6, 8],
    "subsample": [0.7, 0.8, 0.9],
    "colsample": [0.7, 0.8, 0.9],
    "min_child_weight": [1, 3, 5],
}
#: The reference's search space (kind, least, most).
SPACE = {
    "rounds": ("int", 50, 300),
    "rate": ("float", 0.01, 0.3),
    "depth": ("int", 3, 10),
    "subsample": ("float", 0.6, 1.0),
    "colsample": ("float", 0.6, 1.0),
    "min_child_weight": ("int", 1, 7),
}
TRIALS = 50


def combinations(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


class Sample:
    """A bounded sample of binned rows that every task holds."""

    def __init__(self, spark: SparkSession, edges: list[np.ndarray], bins: np.ndarray, labels: np.ndarray, fold: np.ndarray, pick: np.ndarray):
        self.edges, self.n_labels, self.n_rows = edges, labels.shape[1] if len(labels) else 0, len(bins)
        self.held = spark.sparkContext.broadcast((bins, labels, fold, pick))
        self.spark = spark

    @classmethod
    def of(cls, df: DataFrame, id_col: str, features: str, truth: str, rows: int, fold: str) -> Sample:
        """At most ``rows`` records of ``df``; ``fold`` is a column of small numbers."""
        picked = B.materialize(sample_rows(df, id_col, rows))
        first = picked.select(F.size(features)).first()
        edges = B.bin_edges(picked, features, first[0] if first else 0)
        got = B.fit_frame(picked, id_col, features, truth, edges, fold).orderBy("pick").toPandas()
        bins = np.frombuffer(b"".join(got["bins"]), np.uint8).reshape(len(got), -1)
        labels = np.frombuffer(b"".join(got["labels"]), np.uint8).reshape(len(got), -1)
        return cls(df.sparkSession, edges, bins, labels, got["fold"].to_numpy(np.int32), got["pick"].to_numpy(np.int64))


def fit_one(block: B.Block, task: B.Task, edges: list[np.ndarray], stops: list[int]) -> list[tuple[int, int, int, int]]:
    """(rounds, tp, fp, fn) on the left-out rows after each of ``stops`` rounds."""
    s, out = task.settings, []
    held = block.fold == task.fold
    truth = block.labels[held, task.label] == 1
    block.margins[:] = 0
    for n in range(max(stops)):
        tree, open_nodes = B.Tree.stump(s.depth), np.zeros(1, np.int64)
        for level in range(s.depth):
            splits = B.best_splits(B.histograms(block, task, 0, n, tree, level, open_nodes), s)
            open_nodes = B.grow(tree, open_nodes, splits, s, task.label, n, len(edges), level)
            if not len(open_nodes):
                break
        block.margins[:, 0] += tree.values(block.bins)
        if n + 1 in stops:
            said = block.margins[held, 0] > 0
            out.append((n + 1, int((said & truth).sum()), int((said & ~truth).sum()), int((~said & truth).sum())))
    return out


def judged(sample: Sample, settings: list[tuple[B.Settings, list[int]]], folds: list[int]) -> DataFrame:
    """Per settings (its place), rounds and fold: tp, fp, fn over all labels. One row per fit is dealt out."""
    jobs = [(i, fold, label, json.dumps(asdict(s)), stops) for i, (s, stops) in enumerate(settings) for fold in folds for label in range(sample.n_labels)]
    held, edges = sample.held, sample.edges

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = None
        for batch in batches:
            out = []
            for i, fold, label, text, stops in batch.itertuples(index=False):
                if block is None:
                    block = B.Block.of(*held.value)
                task = B.Task(label, B.Settings(**json.loads(text)), fold)
                out += [(i, fold, label, *x) for x in fit_one(block, task, edges, list(stops))]
            yield pd.DataFrame(out, columns=["place", "fold", "label", "rounds", "tp", "fp", "fn"])

    spark = sample.spark
    # a fit a partition, long ones first, as fits take unequal times
    jobs.sort(key=lambda j: -max(j[4]) * json.loads(j[3])["depth"])
    table = spark.createDataFrame(spark.sparkContext.parallelize(jobs, max(1, len(jobs))), "place int, fold int, label int, settings string, stops array<int>")
    counts = table.mapInPandas(fit, "place int, fold int, label int, rounds int, tp long, fp long, fn long")
    return counts.groupBy("place", "rounds", "fold").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])


def f1(tp: float, fp: float, fn: float) -> float:
    return 2 * tp / (2 * tp + fp + fn) if tp else 0.0


def _results(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    kinds = {"rounds": "int", "depth": "int", "trial": "int", "folds": "int"}
    return spark.createDataFrame(rows, ", ".join(f"{n} {kinds.get(n, 'double')}" for n in names))


def grid_search(df: DataFrame, id_col: str, features: str, truth: str, stratum: str, grid: dict[str, list] = GRID, folds: int = 5, rows: int = 2000, seed: int = 42) -> DataFrame:
    """Every combination of ``grid`` with stratified folds: its settings, mean and deviation of the micro F1; best first.

    Combinations that differ in ``rounds`` alone are one fit per fold and label.
    """
    spark = df.sparkSession
    combos = combinations(grid)
    stops = sorted(set(grid.get("rounds", [B.Settings.rounds])))
    shared = combinations({k: v for k, v in grid.items() if k != "rounds"})
    sample = Sample.of(stratified_fold(df, id_col, stratum, folds), id_col, features, truth, rows, "fold")
    counts = judged(sample, [(B.Settings(**{**c, "rounds": max(stops), "seed": seed}), stops) for c in shared], list(range(folds))).collect()
    scores: dict[tuple[int, int], list[float]] = {}
    for r in counts:
        scores.setdefault((r.place, r.rounds), []).append(f1(r.tp, r.fp, r.fn))
    out = []
    for c in combos:
        rounds = c.get("rounds", stops[0])
        found = scores.get((shared.index({k: v for k, v in c.items() if k != "rounds"}), rounds), [0.0])
        out.append((*[float(v) if k not in ("rounds", "depth") else v for k, v in c.items()], len(found), round(float(np.mean(found)), 6), round(float(np.std(found)), 6)))
    names = [*grid, "folds", "f1_micro_mean", "f1_micro_std"]
    return _results(spark, out, names).orderBy(F.desc("f1_micro_mean"), *grid)


class Parzen:
    """Density of a number in [lo, hi]: a bell at each point, as wide as the distance to its neighbours, and one over the whole range."""

    def __init__(self, points: list[float], lo: float, hi: float):
        self.lo, self.hi = lo, hi
        x = np.sort(np.array([*points, (lo + hi) / 2], np.float64))
        ends = np.concatenate([[lo], x, [hi]])
        gaps = np.diff(ends)
        wide = np.maximum(gaps[:-1], gaps[1:])
        self.centers = x
        self.widths = np.clip(wide, (hi - lo) / 50, hi - lo)
        self.widths[np.searchsorted(x, (lo + hi) / 2)] = hi - lo

    def draw(self, rng: np.random.Generator, n: int) -> np.ndarray:
        which = rng.integers(0, len(self.centers), n)
        out = rng.normal(self.centers[which], self.widths[which])
        outside = (out < self.lo) | (out > self.hi)
        out[outside] = rng.uniform(self.lo, self.hi, outside.sum())
        return out

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x[:, None] - self.centers) / self.widths
        return np.log(np.mean(np.exp(-0.5 * z * z) / self.widths, axis=1) + 1e-300)


def propose(history: list[tuple[dict, float]], space: dict[str, tuple], rng: np.random.Generator, startup: int = 10, candidates: int = 24) -> dict:
    """The next settings: random ones first, then of ``candidates`` draws near good trials those most likelier among good than among other trials."""

    def value(kind: str, x: float, lo: float, hi: float):
        return int(np.clip(round(x), lo, hi)) if kind == "int" else float(x)

    if len(history) < startup:
        return {k: value(kind, rng.uniform(lo - 0.5, hi + 0.5) if kind == "int" else rng.uniform(lo, hi), lo, hi) for k, (kind, lo, hi) in space.items()}
    ranked = sorted(range(len(history)), key=lambda i: (-history[i][1], i))
    n_good = max(2, int(np.ceil(0.15 * len(history))))
    good, rest = set(ranked[:n_good]), ranked[n_good:]
    out = {}
    for k, (kind, lo, hi) in space.items():
        lo_, hi_ = (lo - 0.5, hi + 0.5) if kind == "int" else (lo, hi)
        near, far = Parzen([history[i][0][k] for i in good], lo_, hi_), Parzen([history[i][0][k] for i in rest], lo_, hi_)
        drawn = near.draw(rng, candidates)
        out[k] = value(kind, drawn[np.argmax(near.log_density(drawn) - far.log_density(drawn))], lo, hi)
    return out


def parzen_search(objective: Callable[[list[dict]], list[float]], space: dict[str, tuple] = SPACE, trials: int = TRIALS, seed: int = 42,
                  batch: int = 1, history: list[tuple[dict, float]] | None = None, on_trial: Callable[[int, dict, float], None] | None = None) -> list[tuple[dict, float]]:
    """Trials (settings, value) in order; ``objective`` judges a list of settings at once and is maximised.

    A trial's draws depend on its number, the seed and the trials before it, so a search that is
    given the ``history`` of an interrupted one goes on as that would have. With ``batch`` > 1 a batch's later proposals
    take its earlier ones for average trials.
    """
    done = list(history or [])[:trials]
    done = done[:len(done) // batch * batch]  # an unfinished batch is proposed again, as it was
    while len(done) < trials:
        size = min(batch, trials - len(done))
        asked: list[dict] = []
        mean = float(np.mean([v for _, v in done])) if done else 0.0
        for i in range(size):
            rng = np.random.default_rng([seed, len(done) + i])
            asked.append(propose(done + [(a, mean) for a in asked], space, rng))
        for settings, v in zip(asked, objective(asked), strict=True):
            done.append((settings, float(v)))
            if on_trial:
                on_trial(len(done) - 1, settings, float(v))
    return done


def random_search(objective: Callable[[list[dict]], list[float]], space: dict[str, tuple] = SPACE, trials: int = TRIALS, seed: int = 42) -> list[tuple[dict, float]]:
    """As many trials with independent draws."""
    asked = [propose([], space, np.random.default_rng([seed, i])) for i in range(trials)]
    return list(zip(asked, map(float, objective(asked)), strict=True))


def trial_rows(spark: SparkSession, run_id: str, trial: int, settings: dict, value: float) -> DataFrame:
    """A trial as rows of the run table: its settings are params, its value a metric, its number the step."""
    return H.run_rows(spark, run_id, {k: repr(v) for k, v in settings.items()}, {"f1_micro": value}, step=trial)


def trial_history(runs: DataFrame, run_id: str, space: dict[str, tuple] = SPACE) -> list[tuple[dict, float]]:
    """The trials of a run in order, up to the first that is missing or incomplete; one row per trial is read."""
    values = [F.max(F.when((F.col("kind") == "param") & (F.col("key") == k), F.col("value"))).alias(k) for k in space]
    got = runs.where(F.col("run_id") == run_id).groupBy("step").agg(*values, F.max(F.when(F.col("key") == "f1_micro", F.col("num"))).alias("_f1")).orderBy("step").collect()
    out = []
    for r in got:
        if r.step != len(out) or r["_f1"] is None or any(r[k] is None for k in space):
            break
        out.append(({k: int(r[k]) if kind == "int" else float(r[k]) for k, (kind, _, _) in space.items()}, r["_f1"]))
    return out


def boosted_search(df: DataFrame, id_col: str, features: str, truth: str, validation: str, space: dict[str, tuple] = SPACE, trials: int = TRIALS, rows: int = 500,
                   batch: int = 5, seed: int = 42, runs_path: str | None = None, run_id: str = "search") -> DataFrame:
    """Parzen search over boosted trees, judged on the rows where ``validation`` is true: trial, settings, f1_micro; best first.

    With ``runs_path`` every trial is kept in that run table, and trials found there are not run again.
    """
    spark = df.sparkSession
    sample = Sample.of(df.withColumn("_fold", F.when(F.col(validation), F.lit(0)).otherwise(F.lit(1))), id_col, features, truth, rows, "_fold")

    def objective(asked: list[dict]) -> list[float]:
        counts = judged(sample, [(B.Settings(**s, seed=seed), [s["rounds"]]) for s in asked], [0]).collect()
        found = {r.place: f1(r.tp, r.fp, r.fn) for r in counts}
        return [found.get(i, 0.0) for i in range(len(asked))]

    history, keep = None, None
    if runs_path:
        history = trial_history(H.read_runs(spark, runs_path), run_id, space) if H.runs_exist(spark, runs_path) else []
        keep = lambda i, s, v: H.append_runs(trial_rows(spark, run_id, i, s, v), runs_path)
    done = parzen_search(objective, space, trials, seed, batch, history, keep)
    names = ["trial", *space, "f1_micro"]
    out = [(i, *[float(v) if k not in ("rounds", "depth") else v for k, v in s.items()], round(v, 6)) for i, (s, v) in enumerate(done)]
    return _results(spark, out, names).orderBy(F.desc("f1_micro"), "trial")
