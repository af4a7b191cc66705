"""Exact multi-label evaluation metrics.

The long form (row_id, label, y_true, score, y_pred) comes from the wide
score arrays by ``posexplode`` (no shuffle). Global metrics are one
aggregate; per-label metrics group by label with map-side partial
aggregation, so the shuffle carries (tasks x labels) rows. The AUC is the
exact Mann-Whitney statistic with ties counted half, computed from counts
per distinct score and running sums over ranges of scores (no single-task window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.generators import explode_rows
from .ranking import running_totals


def _r(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits)


def _div(a: Column, b: Column) -> Column:
    """a / b as double, 0 when b is 0 (zero-division rule of the metrics)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def to_long(wide: DataFrame, row: str = "row_id", scores: str = "scores", truth: str = "y_true",
            codes: list[str] | None = None) -> DataFrame:
    z = F.arrays_zip(F.col(scores).alias("score"), F.col(truth).alias("y"))
    out = explode_rows(wide, z, "p", [row], pos="label").select(
        row, "label", F.col("p.score").alias("score"), F.col("p.y").alias("y_true"))
    if codes:
        names = F.array(*[F.lit(c) for c in codes])
        out = out.withColumn("code", F.element_at(names, F.col("label") + 1))
    return out


def with_prediction(long: DataFrame, threshold: float = 0.5, inclusive: bool = False,
                    score: str = "score") -> DataFrame:
    s = F.col(score)
    pred = (s >= threshold) if inclusive else (s > threshold)
    return long.withColumn("y_pred", pred.cast("int"))


def _counts():
    t, p = F.col("y_true"), F.col("y_pred")
    return [
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 0) & (p == 0)).alias("tn"),
    ]


def confusion_by_label(long: DataFrame, label: str = "label") -> DataFrame:
    return long.groupBy(label).agg(*_counts()).orderBy(label)


def element_metrics(long: DataFrame) -> DataFrame:
    """Element-wise accuracy and Hamming loss over all (row, label) cells."""
    eq = (F.col("y_true") == F.col("y_pred")).cast("double")
    agg = long.agg(F.avg(eq).alias("_acc"))
    return agg.select(_r(F.col("_acc")).alias("element_accuracy"), _r(1.0 - F.col("_acc")).alias("hamming_loss"))


def subset_accuracy(wide: DataFrame, threshold: float = 0.5, inclusive: bool = False,
                    scores: str = "scores", truth: str = "y_true") -> DataFrame:
    """Share of rows whose whole predicted label set equals the truth."""
    def same(s, y):
        pred = (s >= threshold) if inclusive else (s > threshold)
        return pred.cast("int") == y
    exact = F.forall(F.zip_with(F.col(scores), F.col(truth), same), lambda x: x)
    return wide.agg(_r(F.avg(exact.cast("double"))).alias("subset_accuracy"),
                    F.count(F.lit(1)).alias("rows"))


def _prf(tp: Column, fp: Column, fn: Column):
    p = _div(tp, tp + fp)
    r = _div(tp, tp + fn)
    f = _div(2.0 * p * r, p + r)
    return p, r, f


def micro_prf(long: DataFrame) -> DataFrame:
    agg = long.agg(*_counts())
    p, r, f = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return agg.select("tp", "fp", "fn", "tn", _r(p).alias("precision_micro"),
                      _r(r).alias("recall_micro"), _r(f).alias("f1_micro"))


def per_label_prf(long: DataFrame, label: str = "label") -> DataFrame:
    c = long.groupBy(label).agg(*_counts())
    p, r, f = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(label, "tp", "fp", "fn", "tn", p.alias("precision"), r.alias("recall"), f.alias("f1"))


def macro_prf(long: DataFrame, label: str = "label") -> DataFrame:
    per = per_label_prf(long, label)
    return per.agg(_r(F.avg("precision")).alias("precision_macro"),
                   _r(F.avg("recall")).alias("recall_macro"),
                   _r(F.avg("f1")).alias("f1_macro"),
                   F.count(F.lit(1)).alias("labels"))


def label_accuracy(long: DataFrame, code: str = "code", prefix: str = "accuracy_") -> DataFrame:
    """Accuracy of each label that has at least one positive."""
    eq = (F.col("y_true") == F.col("y_pred")).cast("double")
    per = long.groupBy(code).agg(F.avg(eq).alias("_acc"), F.sum("y_true").alias("positives"))
    return (per.where(F.col("positives") > 0)
            .select(F.concat(F.lit(prefix), F.col(code)).alias("metric_key"), code,
                    _r(F.col("_acc")).alias("accuracy"), "positives")
            .orderBy(code))


def label_accuracy_stats(long: DataFrame, label: str = "label") -> DataFrame:
    """Mean, population std, min and max of the per-label accuracy."""
    eq = (F.col("y_true") == F.col("y_pred")).cast("double")
    per = long.groupBy(label).agg(F.avg(eq).alias("acc"))
    return per.agg(_r(F.avg("acc")).alias("per_label_accuracy_mean"),
                   _r(F.stddev_pop("acc")).alias("per_label_accuracy_std"),
                   _r(F.min("acc")).alias("per_label_accuracy_min"),
                   _r(F.max("acc")).alias("per_label_accuracy_max"))


def _score_counts(long: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    return long.groupBy(*keys, score).agg(F.sum("y_true").cast("long").alias("pos"),
                                          F.sum(1 - F.col("y_true")).cast("long").alias("neg"))


def roc_auc_micro(long: DataFrame, score: str = "score") -> DataFrame:
    """Exact micro ROC AUC over all (row, label) pairs; NULL when a class is missing."""
    sc = _score_counts(long, [], score)
    cum = running_totals(sc, score, ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    agg = cum.agg(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("_u"),
                  F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return agg.select(_r(F.try_divide(F.col("_u"), F.col("_p").cast("double") * F.col("_n"))).alias("roc_auc_micro"),
                      F.col("_p").alias("positives"), F.col("_n").alias("negatives"))


def roc_points(long: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per label and distinct threshold s: tp/fp of 'score >= s', tpr, fpr."""
    sc = _score_counts(long, [label], score)
    cum = running_totals(sc, score, ["pos", "neg"], [label])
    tot = sc.groupBy(label).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = cum.join(tot, label)
    tp = F.col("P") - (F.col("cum_pos") - F.col("pos"))
    fp = F.col("N") - (F.col("cum_neg") - F.col("neg"))
    return j.select(label, F.col(score).alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                    _r(F.try_divide(tp.cast("double"), F.col("P"))).alias("tpr"),
                    _r(F.try_divide(fp.cast("double"), F.col("N"))).alias("fpr"))


def roc_auc_by_label(long: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    sc = _score_counts(long, [label], score)
    cum = running_totals(sc, score, ["neg"], [label])
    below = F.col("cum_neg") - F.col("neg")
    agg = cum.groupBy(label).agg(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("_u"),
                                 F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return agg.select(label, _r(F.try_divide(F.col("_u"), F.col("_p").cast("double") * F.col("_n"))).alias("roc_auc"))


def sparse_micro(truth_pairs: DataFrame, pred_pairs: DataFrame, n_rows, n_labels,
                 keys: tuple[str, str] = ("row_id", "label")) -> DataFrame:
    """Micro P/R/F1 from positive pairs only: tp from the join of truth and
    prediction on (row, label); fp, fn by difference; tn by arithmetic, so
    the n x labels matrix is never built."""
    k = list(keys)
    t = truth_pairs.select(*k).distinct()
    p = pred_pairs.select(*k).distinct()
    tp = t.join(p, k).select(F.count(F.lit(1))).scalar()
    n_t = t.select(F.count(F.lit(1))).scalar()
    n_p = p.select(F.count(F.lit(1))).scalar()
    spark = truth_pairs.sparkSession
    base = spark.range(1).select(tp.alias("tp"), (n_p - tp).alias("fp"), (n_t - tp).alias("fn"))
    base = base.select("*", (F.lit(n_rows) * F.lit(n_labels) - F.col("tp") - F.col("fp") - F.col("fn")).alias("tn"))
    pr, rc, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return base.select("tp", "fp", "fn", "tn", _r(pr).alias("precision_micro"),
                       _r(rc).alias("recall_micro"), _r(f1).alias("f1_micro"))
