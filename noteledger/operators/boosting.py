"""Second-order boosted trees for many labels at once, on binned features.

The frame of a fit has a row per record: its feature bins (a byte each), its
labels, its fold and a hash that decides in which rounds it is sampled. A *task*
is one model: a label, the fold it leaves out, and its settings; all tasks of a
fit share one chain of jobs. Per level of the round's trees one aggregation is
run: every partition adds up gradients and curvatures per (task, node, feature,
bin), the sums of a task meet in one group, as large as its trees are wide
whatever the number of rows, and only its best splits go to the driver. Nothing
is refitted: a fit of n rounds holds all shorter ones, and after the round with the
lowest loss on the left-out rows later trees are dropped.

Settings follow the usual names: rounds, rate, depth, subsample (rows of a
round), colsample (features of a tree), min_child_weight (least curvature of a
child), reg_lambda (L2 on leaf weights). The gain of a split is
GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l) and must be positive; ties go to the first feature
and the lowest bin. Missing feature values have a bin below all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BINS = 32  # of a feature; the first is for missing values
COMMIT = 8  # rounds whose trees are replayed before the margins are written
PATIENCE = 10
BLOCK = 4096


@dataclass(frozen=True)
class Settings:
    """One model's settings; the defaults are the reference's."""

    rounds: int = 100
    rate: float = 0.1
    depth: int = 6
    subsample: float = 0.8
    colsample: float = 0.8
    min_child_weight: float = 1.0
    reg_lambda: float = 1.0
    seed: int = 42


@dataclass(frozen=True)
class Task:
    """A model to fit: which label, which fold is left out (None: no row is), and a group whose losses are judged together."""

    label: int
    settings: Settings = Settings()
    fold: int | None = None
    group: int = 0


@dataclass
class Tree:
    """Nodes in heap order: feature (-1: leaf), last bin that goes left, weight of a leaf, gain of a split."""

    feature: np.ndarray
    last: np.ndarray
    weight: np.ndarray
    gain: np.ndarray

    @classmethod
    def stump(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n))

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """Node of each row after at most ``levels`` splits."""
        n, width = bins.shape
        inner, number = self.feature >= 0, np.arange(len(self.feature))
        # no bin is above a leaf's, so its rows stay
        feature, last, left = np.where(inner, self.feature, 0).astype(np.int64), np.where(inner, self.last, 255).astype(np.uint8), np.where(inner, 2 * number + 1, number)
        out = np.zeros(n, np.int64)
        for a in range(0, n if levels else 0, BLOCK):
            flat = bins[a:a + BLOCK].reshape(-1)
            row, at = np.arange(0, len(flat), width), out[a:a + BLOCK]
            for _ in range(levels):
                at = left.take(at) + (flat.take(row + feature.take(at)) > last.take(at))
            out[a:a + BLOCK] = at
        return out

    def values(self, bins: np.ndarray) -> np.ndarray:
        depth = (len(self.feature) + 1).bit_length() - 2
        return self.weight[self.nodes(bins, depth)]


@dataclass
class Boosted:
    """A fitted model: its trees up to the best round, the loss after each round, the bins' upper ends."""

    task: Task
    edges: list[np.ndarray]
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def importances(self) -> np.ndarray:
        """Share of each feature in the gains of all splits."""
        out = np.zeros(len(self.edges))
        for t in self.trees:
            np.add.at(out, t.feature[t.feature >= 0], t.gain[t.feature >= 0])
        return out / out.sum() if out.sum() else out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def bin_edges(df: DataFrame, features: str, width: int, bins: int = BINS - 1) -> list[np.ndarray]:
    """Upper ends of each feature's bins but the last: quantiles, a value each where there are few."""
    shares = [i / bins for i in range(1, bins)]
    found = (
        df.select(F.posexplode(features).alias("i", "x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
        .groupBy("i").agg(F.percentile_approx("x", shares, 200 * bins).alias("q")).collect()
    )  # one row per feature
    edges = [np.zeros(0)] * width
    for r in found:
        edges[r.i] = np.unique(np.array(r.q, np.float64))
    return edges


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(values.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.where(np.isnan(values[:, j]), 0, 1 + np.searchsorted(e, values[:, j], side="left"))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a column of equally long lists; nulls are NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), width)


def fit_frame(df: DataFrame, id_col: str, features: str, truth: str, edges: list[np.ndarray], fold: str | None = None) -> DataFrame:
    """pick (the hash of the id), fold, bins, labels and margins (none yet).

    A partition has at least ``BLOCK`` rows, so a small fit needs no exchange; a larger one has as many
    partitions as the input, or the cores.
    """
    width = len(edges)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                bins = binned(_matrix(batch.column("x"), width), edges)
                truths = _matrix(batch.column("y"), len(batch.column("y")[0])).astype(np.uint8)
                yield pa.record_batch({
                    "pick": batch.column("pick"), "fold": batch.column("fold"),
                    "bins": pa.array([b.tobytes() for b in bins], pa.binary()), "labels": pa.array([y.tobytes() for y in truths], pa.binary())})

    narrow = df.select(
        F.xxhash64(F.col(id_col)).alias("pick"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
        F.col(features).cast("array<double>").alias("x"), F.col(truth).cast("array<double>").alias("y"))
    made = materialize(narrow.mapInArrow(rows, "pick long, fold int, bins binary, labels binary"))
    parts = max(1, min(-(-made.count() // BLOCK), max(df.sparkSession.sparkContext.defaultParallelism, made.rdd.getNumPartitions())))
    return made.repartition(parts, "pick").withColumn("margins", F.lit(b"").cast("binary"))


def _bytes(column: pa.Array, kind) -> np.ndarray:
    """Rows of a column of equally long byte strings."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32, len(column) + 1, 4 * column.offset)
    return np.frombuffer(data.slice(ends[0], ends[-1] - ends[0]) if data is not None else b"", kind).reshape(len(column), -1)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = x.view(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Block:
    """Rows of one partition as arrays."""

    def __init__(self, batches: Iterator[pa.RecordBatch], tasks: list[Task]):
        rows = [b for b in batches if len(b)]
        self.n = sum(map(len, rows))
        if not self.n:
            return
        table = pa.Table.from_batches(rows).combine_chunks()
        column = lambda c: table.column(c).chunk(0)
        self.pick = column("pick").to_numpy()
        self.fold = column("fold").to_numpy()
        self.bins = _bytes(column("bins"), np.uint8)
        self.labels = _bytes(column("labels"), np.uint8)
        margins = _bytes(column("margins"), np.float64)
        self.margins = margins.copy() if margins.shape[1] else np.zeros((self.n, len(tasks)))
        self._drawn: tuple = (None, ())

    @classmethod
    def of(cls, bins: np.ndarray, labels: np.ndarray, fold: np.ndarray, pick: np.ndarray) -> Block:
        """Rows that are arrays already, for one task at a time."""
        block = cls.__new__(cls)
        block.n, block.bins, block.labels, block.fold, block.pick = len(bins), bins, labels, fold, pick
        block.margins, block._drawn = np.zeros((len(bins), 1)), (None, ())
        return block

    def drawn(self, task: Task, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of round ``n`` of a task, their bins by row and by feature; tasks that follow each other mostly share them."""
        asked = n, task.fold, task.settings.seed, task.settings.subsample
        if self._drawn[0] != asked:
            used = sampled(self.pick, task.settings, n)
            if task.fold is not None:
                used &= self.fold != task.fold
            rows = np.flatnonzero(used)
            bins = self.bins[rows]
            self._drawn = asked, (rows, bins, np.ascontiguousarray(bins.T))
        return self._drawn[1]

    def replay(self, recent: list[dict[int, Tree]]) -> None:
        for trees in recent:
            for t, tree in trees.items():
                self.margins[:, t] += tree.values(self.bins)


def sampled(pick: np.ndarray, settings: Settings, n: int) -> np.ndarray:
    """Rows of round ``n``."""
    if settings.subsample >= 1:
        return np.ones(len(pick), bool)
    return _mixed(pick, settings.seed * 1_000_003 + n) < np.uint64(settings.subsample * 2**64)


def columns_of(settings: Settings, label: int, n: int, width: int) -> np.ndarray:
    """Features of the tree of round ``n``, sorted."""
    rng = np.random.default_rng([settings.seed, label, n])
    return np.sort(rng.permutation(width)[:max(1, round(settings.colsample * width))])


def histograms(block: Block, task: Task, t: int, n: int, tree: Tree, level: int, open_nodes: np.ndarray) -> np.ndarray:
    """Gradients and curvatures [node, feature, bin, 2] of the open nodes of a level."""
    rows, bins, turned = block.drawn(task, n)
    columns = columns_of(task.settings, task.label, n, bins.shape[1])
    out = np.zeros((len(open_nodes), len(columns), BINS, 2))
    place = np.full(len(tree.feature), -1)
    place[open_nodes] = np.arange(len(open_nodes))
    node = place[tree.nodes(bins, level)]
    held = np.flatnonzero(node >= 0)
    if len(held) < len(rows):
        rows, node, turned = rows[held], node[held], turned[:, held]
    p = sigmoid(block.margins[rows, t])
    sides, first = (p - block.labels[rows, task.label], p * (1 - p)), node * BINS
    # a feature at a time: its sums are few and stay near, and no key or value is written per row and feature
    for j, column in enumerate(columns):
        key = first + turned[column]
        for side, v in enumerate(sides):
            out[:, j, :, side] = np.bincount(key, v, minlength=len(open_nodes) * BINS).reshape(-1, BINS)
    return out


def best_splits(sums: np.ndarray, settings: Settings) -> np.ndarray:
    """Per node: gain, column, last bin on the left, G and H of the left side and of the node."""
    left = np.cumsum(sums, axis=2)
    total = left[:, :1, -1:, :]
    g, h, big = left[..., 0], left[..., 1], total[..., 0]
    other_g, other_h, l2 = big - g, total[..., 1] - h, settings.reg_lambda
    gain = g * g / (h + l2 + 1e-300) + other_g**2 / (other_h + l2 + 1e-300) - big**2 / (total[..., 1] + l2 + 1e-300)
    ok = (h >= settings.min_child_weight) & (other_h >= settings.min_child_weight) & (h > 0) & (other_h > 1e-12)
    gain = np.where(ok, gain, -np.inf).reshape(len(sums), -1)
    best = gain.argmax(axis=1)
    rows = np.arange(len(sums))
    column, last = best // BINS, best % BINS
    return np.stack([gain[rows, best], column, last, g[rows, column, last], h[rows, column, last], total[:, 0, 0, 0], total[:, 0, 0, 1]], axis=1)


def _losses(block: Block, task: Task, t: int) -> tuple[float, int]:
    held = block.fold == task.fold if task.fold is not None else np.zeros(block.n, bool)
    m, y = block.margins[held, t], block.labels[held, task.label]
    return float(np.logaddexp(0, np.where(y == 1, -m, m)).sum()), int(held.sum())


LEVEL = "task int, sums binary, loss double, rows long"
FOUND = "task int, splits array<double>, loss double, rows long"


def run_level(frame: DataFrame, tasks: list[Task], active: dict[int, np.ndarray], trees: dict[int, Tree], recent: list[dict[int, Tree]], n: int, level: int, judged: bool, alone: bool = False) -> dict[int, tuple]:
    """One aggregation: splits of the open nodes of all active tasks, and the tasks' losses if ``judged``.

    ``alone``: the frame is one partition, whose sums are the whole ones and need not be merged.
    """

    def splits_of(t: int, sums: np.ndarray) -> list[float]:
        return best_splits(sums.reshape(len(active[t]), -1, BINS, 2), tasks[t].settings).reshape(-1).tolist() if len(active[t]) else []

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(batches, tasks)
        if not block.n:
            return
        block.replay(recent)
        out = []
        for t, open_nodes in active.items():
            sums = histograms(block, tasks[t], t, n, trees[t], level, open_nodes) if len(open_nodes) else np.empty(0)
            out.append((t, splits_of(t, sums) if alone else sums.tobytes(), *(_losses(block, tasks[t], t) if judged else (0.0, 0))))
        kinds = (pa.int32(), pa.list_(pa.float64()) if alone else pa.binary(), pa.float64(), pa.int64())
        yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=["task", "splits" if alone else "sums", "loss", "rows"])

    def merge(table: pa.Table) -> pa.Table:
        t = table.column("task")[0].as_py()
        sums = sum(np.frombuffer(s.as_py()) for s in table.column("sums"))
        return pa.table({"task": pa.array([t], pa.int32()), "splits": pa.array([splits_of(t, sums)], pa.list_(pa.float64())),
                         "loss": pa.array([sum(x.as_py() for x in table.column("loss"))], pa.float64()), "rows": pa.array([sum(x.as_py() for x in table.column("rows"))], pa.int64())})

    made = frame.mapInArrow(partial, FOUND) if alone else frame.mapInArrow(partial, LEVEL).groupBy("task").applyInArrow(merge, FOUND)
    found = made.collect()
    return {r.task: (np.array(r.splits).reshape(-1, 7), r.loss, r.rows) for r in found}


def grow(tree: Tree, open_nodes: np.ndarray, splits: np.ndarray, settings: Settings, label: int, n: int, width: int, level: int) -> np.ndarray:
    """Put a level's splits into the tree; returns the nodes that may be split next."""
    columns = columns_of(settings, label, n, width)
    following = []
    for node, (gain, column, last, gl, hl, g, h) in zip(open_nodes, splits, strict=True):
        if level == 0:
            tree.weight[node] = -g / (h + settings.reg_lambda) * settings.rate
        if gain <= 1e-9:
            continue
        tree.feature[node], tree.last[node], tree.gain[node] = columns[int(column)], int(last), gain
        for child, cg, ch in ((2 * node + 1, gl, hl), (2 * node + 2, g - gl, h - hl)):
            tree.weight[child] = -cg / (ch + settings.reg_lambda) * settings.rate
            following.append(child)
    return np.array(following, np.int64)


def committed(frame: DataFrame, tasks: list[Task], recent: list[dict[int, Tree]]) -> DataFrame:
    """The frame with the margins after the recent rounds, written."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = Block(iter([batch]), tasks)
            if block.n:
                block.replay(recent)
                yield batch.set_column(batch.schema.get_field_index("margins"), "margins", pa.array([m.tobytes() for m in block.margins], pa.binary()))

    return materialize(frame.mapInArrow(rows, frame.schema))


def fit_tasks(frame: DataFrame, tasks: list[Task], edges: list[np.ndarray], patience: int | None = PATIENCE) -> list[Boosted]:
    """Fit all tasks in one chain of jobs.

    With ``patience``, a group of tasks ends when its mean loss on the left-out rows has
    not improved for so many rounds, and keeps the trees up to its best round.
    """
    frame = materialize(frame)
    width, alone = len(edges), frame.rdd.getNumPartitions() == 1
    models = [Boosted(t, edges) for t in tasks]
    groups = sorted({t.group for t in tasks})
    losses: dict[int, list[float]] = {g: [] for g in groups}
    running, recent = set(range(len(tasks))), []
    most = max((t.settings.rounds for t in tasks), default=0)

    def judge(found: dict[int, tuple]) -> None:
        for t, (_, loss, rows) in found.items():
            models[t].losses.append(loss / rows if rows else float("nan"))
        for g in groups:
            mine = [t for t in found if tasks[t].group == g]
            rows = sum(found[t][2] for t in mine)
            if rows:
                losses[g].append(sum(found[t][1] for t in mine) / rows)
                best = int(np.argmin(losses[g]))
                if patience is not None and len(losses[g]) - 1 - best >= patience:
                    running.difference_update(t for t in range(len(tasks)) if tasks[t].group == g)

    watch = any(t.fold is not None for t in tasks)
    for n in range(most + 1):
        running -= {t for t in running if n > tasks[t].settings.rounds}
        if not running:
            break
        trees = {t: Tree.stump(tasks[t].settings.depth) for t in sorted(running)}
        active = {t: np.zeros(1 if n < tasks[t].settings.rounds else 0, np.int64) for t in trees}
        for level in range(max(tasks[t].settings.depth for t in trees)):
            judged = watch and level == 0 and n > 0  # losses after the round before
            if not judged and not any(len(x) for x in active.values()):
                break
            found = run_level(frame, tasks, active, trees, recent, n, level, judged, alone)
            if judged:
                judge({t: found[t] for t in found})
            following = {}
            for t, open_nodes in active.items():
                if t in running and len(open_nodes) and t in found:
                    settings = tasks[t].settings
                    new = grow(trees[t], open_nodes, found[t][0], settings, tasks[t].label, n, width, level)
                    if level + 1 < settings.depth and len(new):
                        following[t] = new
            active = following
        made = {t: tree for t, tree in trees.items() if t in running and n < tasks[t].settings.rounds}
        for t, tree in made.items():
            models[t].trees.append(tree)
        recent.append(made)
        if len(recent) >= COMMIT:
            frame, recent = committed(frame, tasks, recent), []
    if patience is not None:
        for t, model in enumerate(models):
            if losses[tasks[t].group]:
                model.trees = model.trees[:int(np.argmin(losses[tasks[t].group])) + 1]
    return models


def margins_of(models: list[Boosted], values: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """[row, model]; ``rounds``: of the first so many trees only."""
    out = np.zeros((len(values), len(models)))
    shared: dict[int, np.ndarray] = {}
    for j, m in enumerate(models):
        bins = shared.setdefault(id(m.edges), None)
        if bins is None:
            bins = shared[id(m.edges)] = binned(values, m.edges)
        for tree in m.trees[:rounds]:
            out[:, j] += tree.values(bins)
    return out


def score(models: list[Boosted], df: DataFrame, features: str = "features", out: str = "scores") -> DataFrame:
    """``df`` with the probability of each model's label, an array in the models' order."""
    width = len(models[0].edges)

    def probabilities(batches):
        import pandas as pd

        for x in batches:
            values = np.array([np.asarray(v, np.float64) for v in x]).reshape(len(x), width)
            yield pd.Series(list(sigmoid(margins_of(models, values))))

    from collections.abc import Iterator as It

    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    probabilities.__annotations__ = {"batches": It[pd.Series], "return": It[pd.Series]}
    made = pandas_udf(probabilities, "array<double>")
    return df.withColumn(out, made(F.col(features).cast("array<double>")))


def fit_labels(train: DataFrame, n_labels: int, id_col: str, features: str = "features", truth: str = "y_true", validation: str | None = None,
               settings: Settings = Settings(), patience: int = PATIENCE, **overrides) -> list[Boosted]:
    """One model per label over all rows of ``train``; rows where ``validation`` is true are watched, not fitted."""
    settings = replace(settings, **overrides)
    fold = "_fold" if validation else None
    df = train.withColumn("_fold", F.when(F.col(validation), F.lit(0)).otherwise(F.lit(1))) if validation else train
    first = df.select(F.size(features)).first()
    width = first[0] if first else 0
    fitted = df.where("_fold = 1") if validation else df
    edges = bin_edges(fitted, features, width)
    tasks = [Task(k, settings, 0 if validation else None) for k in range(n_labels)]
    return fit_tasks(fit_frame(df, id_col, features, truth, edges, fold), tasks, edges, patience if validation else None)
