"""Binary-relevance multi-label models on Spark ML.

One binary classifier per label, all trained on the same persisted feature
frame. Each fit is a distributed Spark job; a small driver thread pool
submits several labels at once (as ``CrossValidator.parallelism`` does).
Scores come back as the wide form (one probability array per row), so the
scoring and metric operators apply unchanged.
"""

from __future__ import annotations

import itertools
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from . import metrics as M
from .split import kfold

# Model settings of the reference (trees, rate, depth, row and column
# subsampling, seed; forest size and depth; logistic iterations).
GBT_PARAMS = dict(maxIter=100, stepSize=0.1, maxDepth=6, subsamplingRate=0.8,
                  featureSubsetStrategy="0.8", seed=42)
RF_PARAMS = dict(numTrees=100, maxDepth=10, seed=42)
# How a forest is fitted, not what: each row's node in each tree is kept from level to level
# instead of being found from the root again. At most ten levels, so the lineage needs no cut.
RF_EXECUTION = dict(cacheNodeIds=True, checkpointInterval=-1)
LR_PARAMS = dict(maxIter=1000)


PARTITION_BYTES = 64 << 20  # of feature vectors in one partition of a fit
FOREST_BYTES = 1 << 20  # the same for a forest, up to FOREST_PARTS partitions
FOREST_PARTS = 16


def make_estimator(kind: str, features: str = "features", label: str = "label", n_rows: int | None = None, **overrides):
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier

    if kind == "gbt":
        return GBTClassifier(featuresCol=features, labelCol=label, **{**GBT_PARAMS, **overrides})
    if kind == "rf":
        return RandomForestClassifier(featuresCol=features, labelCol=label, **{**RF_PARAMS, **RF_EXECUTION, **overrides})
    if kind == "lr":
        params = {**LR_PARAMS, **overrides}
        if "regParam" not in params and n_rows:
            # the reference's default penalty (L2 with C = 1 on the summed
            # loss) is regParam = 1 / n on Spark's averaged loss, unscaled
            params.update(regParam=1.0 / n_rows, elasticNetParam=0.0, standardization=False)
        return LogisticRegression(featuresCol=features, labelCol=label, **params)
    raise ValueError(f"unknown model kind {kind!r}")


def label_frame(df: DataFrame, truth: str, k: int, out: str = "label") -> DataFrame:
    return df.withColumn(out, F.element_at(F.col(truth), k + 1).cast("double"))


def fit_frame(df: DataFrame, columns: list[str], features: str, id_col: str | None, kind: str = "") -> tuple[DataFrame, int]:
    """``columns`` of ``df`` kept for the fits of all labels, and its rows.

    As many partitions as the vectors' size asks for: every tree level and
    every gradient is a job over all of them. A row of a forest is worth far more
    work (each tree counts it at each level), so smaller partitions pay; but each of them
    sends the counts of all open nodes, hence a bound on their number. With an id the rows'
    place is fixed, so a fit depends neither on how the frame was made nor on the cluster.
    """
    n = df.count()
    first = df.select(features).first()
    width = first[0].size if first else 0
    held = n * (8 * width + 64)
    parts = max(1, -(-held // PARTITION_BYTES))
    if kind == "rf":
        parts = max(parts, min(FOREST_PARTS, held // FOREST_BYTES))
    if id_col:
        df = df.repartition(parts, id_col).sortWithinPartitions(id_col)
    elif parts < df.rdd.getNumPartitions():
        df = df.coalesce(parts)
    return df.select(*columns).persist(StorageLevel.MEMORY_AND_DISK), n


def fit_binary_relevance(train: DataFrame, n_labels: int, kind: str = "gbt", features: str = "features",
                         truth: str = "y_true", parallelism: int = 4, id_col: str | None = None, **overrides) -> list:
    """Fit one model per label; returns the fitted models in label order.
    Boosted trees that stop on validation rows are in :mod:`.boosting`."""
    cached, n_rows = fit_frame(train, [features, truth], features, id_col, kind)
    try:
        def fit(k):
            return make_estimator(kind, features, "label", n_rows, **overrides).fit(label_frame(cached, truth, k))

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            return list(pool.map(fit, range(n_labels)))
    finally:
        cached.unpersist()


def score(models: list, df: DataFrame, features: str = "features", out: str = "scores") -> DataFrame:
    """Wide scores: probability of the positive class of each label's model.
    ``features`` is a vector, also for boosted trees, which read it as an array."""
    from pyspark.ml.functions import vector_to_array

    if models and isinstance(models[0], boosting.Boosted):
        return boosting.score(models, df.withColumn("_dense", vector_to_array(features)), "_dense", out).drop("_dense")
    cur = df
    cols = []
    for k, m in enumerate(models):
        m = m.copy()
        m.setFeaturesCol(features)
        m.setProbabilityCol(f"_p{k}").setRawPredictionCol(f"_r{k}").setPredictionCol(f"_y{k}")
        cur = m.transform(cur)
        cols.append(F.element_at(vector_to_array(F.col(f"_p{k}")), 2))
    drop = [c for k in range(len(models)) for c in (f"_p{k}", f"_r{k}", f"_y{k}")]
    return cur.withColumn(out, F.array(*cols)).drop(*drop)


def _one_row(spark, cols: dict) -> DataFrame:
    """One row whose columns are scalar subqueries over small aggregates."""
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()])


def evaluate(scored: DataFrame, threshold: float = 0.5, row: str = "row_id", truth: str = "y_true") -> DataFrame:
    """One row of the standard metrics of a scored frame."""
    long = M.with_prediction(M.to_long(scored, row=row, truth=truth), threshold)
    el = M.element_metrics(long)
    mi = M.micro_prf(long)
    su = M.subset_accuracy(scored, threshold, truth=truth)
    return _one_row(scored.sparkSession, {
        "element_accuracy": el.select("element_accuracy").scalar(),
        "hamming_loss": el.select("hamming_loss").scalar(),
        "precision_micro": mi.select("precision_micro").scalar(),
        "recall_micro": mi.select("recall_micro").scalar(),
        "f1_micro": mi.select("f1_micro").scalar(),
        "subset_accuracy": su.select("subset_accuracy").scalar(),
    })


CV_METRICS = {"accuracy": "subset_accuracy", "f1": "f1_micro", "precision": "precision_micro", "recall": "recall_micro"}


def _fold_results(folded: DataFrame, id_col: str, n_labels: int, k: int, kind: str, parallelism: int, **params) -> dict:
    """Mean and population std over the folds of each of ``CV_METRICS``: a handful of driver numbers."""
    found = []
    for fold in range(k):
        models = fit_binary_relevance(folded.where(F.col("fold") != fold), n_labels, kind, parallelism=parallelism,
                                      id_col=id_col, **params)
        scored = score(models, folded.where(F.col("fold") == fold)).persist(StorageLevel.MEMORY_AND_DISK)
        found.append(evaluate(scored, 0.5, id_col).first().asDict())
        scored.unpersist()
    out = {}
    for name, metric in CV_METRICS.items():
        values = [f[metric] or 0.0 for f in found]
        mean = sum(values) / len(values)
        out[f"cv_{name}_mean"] = round(mean, 6)
        out[f"cv_{name}_std"] = round((sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5, 6)
    return out


def search(df: DataFrame, candidates: list[dict], id_col: str, n_labels: int, k: int = 2, kind: str = "lr",
           parallelism: int = 4) -> DataFrame:
    """k-fold cross-validation of every candidate's params over all labels: a
    row per candidate with its params and the means and deviations, best micro
    F1 first. The folds are made and kept once."""
    folded = kfold(df, id_col, k).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = [{"trial": i, **{n: str(v) for n, v in c.items()}, **_fold_results(folded, id_col, n_labels, k, kind, parallelism, **c)}
                for i, c in enumerate(candidates)]
    finally:
        folded.unpersist()
    names = list(rows[0])
    schema = ", ".join(f"{n} " + ("int" if n == "trial" else "double" if n.startswith("cv_") else "string") for n in names)
    return df.sparkSession.createDataFrame([tuple(r[n] for n in names) for r in rows], schema).orderBy(F.desc("cv_f1_mean"), "trial")


def cross_validate(df: DataFrame, id_col: str, n_labels: int, k: int = 2, kind: str = "lr", parallelism: int = 4,
                   **params) -> DataFrame:
    """Shuffled k-fold CV: mean and population std over folds of exact-match
    accuracy and micro precision, recall and F1."""
    return search(df, [params], id_col, n_labels, k, kind, parallelism).select(
        *(f"cv_{n}_{s}" for n in CV_METRICS for s in ("mean", "std")))


def grid_search(df: DataFrame, grid: dict, id_col: str, n_labels: int, kind: str = "lr", **kw) -> DataFrame:
    """Every combination of the grid's values (see :func:`search`)."""
    combos = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return search(df, combos, id_col, n_labels, kind=kind, **kw)


def random_search(df: DataFrame, space: dict, trials: int, id_col: str, n_labels: int, kind: str = "lr", seed: int = 42, **kw) -> DataFrame:
    """``trials`` combinations drawn without repeats (see :func:`search`)."""
    combos = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return search(df, random.Random(seed).sample(combos, min(trials, len(combos))), id_col, n_labels, kind=kind, **kw)


def feature_importance(models: list, names: list[str], spark, top: int | None = 20,
                       subset: list[str] | None = None) -> DataFrame:
    """Mean importance of each feature over the label models, ranked (one
    value per feature: the table is as wide as the feature vector).
    ``subset``: only these features (e.g. the engineered block), all of them."""
    import numpy as np

    imps = np.mean([m.importances() if hasattr(m, "importances") else m.featureImportances.toArray() for m in models], axis=0)
    rows = [(n, float(v)) for n, v in zip(names, imps) if subset is None or n in subset]
    df = spark.createDataFrame(rows, "feature string, importance double")
    ranked = df.select("feature", F.round("importance", 6).alias("importance")).orderBy(
        F.desc("importance"), "feature")
    return ranked.limit(top) if top else ranked
