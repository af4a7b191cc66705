"""Scoring-table operators on the wide score form (one array per row).

Top-k, thresholds and packaging are per-row array expressions, so none of
them shuffles: the ranking of one row's labels happens inside the task that
holds the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.generators import explode_rows
from ..functions.patterns import CONFIDENCE_LEVELS
from ..functions.text import preview
from .reports import percent


def _codes(codes: list[str]) -> Column:
    return F.array(*[F.lit(c) for c in codes])


def scored_labels(scores: str, codes: list[str]) -> Column:
    """array<struct<o, label, code, score>> in label order (o = -score)."""
    names = _codes(codes)
    return F.transform(F.col(scores), lambda s, i: F.struct(
        (-s).alias("o"), i.alias("label"), F.element_at(names, i + 1).alias("code"), s.alias("score")))


def ranked_labels(scores: str, codes: list[str]) -> Column:
    """Labels sorted by score descending, ties by label index."""
    return F.sort_array(scored_labels(scores, codes))


def above(score: Column, threshold: float, inclusive: bool) -> Column:
    return score >= threshold if inclusive else score > threshold


def top_k(wide: DataFrame, codes: list[str], k: int = 3, threshold: float = 0.5,
          inclusive: bool = True, row: str = "row_id", scores: str = "scores") -> DataFrame:
    """Always k labels per row, each flagged whether it clears the threshold."""
    top = F.slice(ranked_labels(scores, codes), 1, k)
    return (explode_rows(wide, top, "t", [row], pos="pos")
            .select(row, (F.col("pos") + 1).alias("rank"), F.col("t.label").alias("label"),
                    F.col("t.code").alias("code"), F.col("t.score").alias("score"),
                    above(F.col("t.score"), threshold, inclusive).alias("above_threshold")))


def _ok(scores: str) -> Column:
    return F.col(scores).isNotNull() & (F.size(F.col(scores)) > 0)


def batch_scores(wide: DataFrame, codes: list[str], row: str = "row_id", scores: str = "scores",
                 note: str | None = None, k: int = 3, malformed: str | None = None) -> DataFrame:
    """Batch-scoring table: top code, its score, 'code(0.123); ...' of the
    top k, and a status; rows that cannot be scored are kept as errors, and
    so are those with something in the column ``malformed``."""
    top = F.slice(ranked_labels(scores, codes), 1, k)
    ok = _ok(scores) & F.col(malformed).isNull() if malformed else _ok(scores)
    text = F.array_join(F.transform(top, lambda t: F.format_string(
        "%s(%.3f)", t["code"], F.round(t["score"], 3))), "; ")
    cols = [F.col(row).alias("patient_id")]
    if note:
        cols.append(preview(note).alias("doctor_notes"))
    cols += [
        F.when(ok, F.element_at(top, 1)["code"]).otherwise(F.lit("ERROR")).alias("top_prediction"),
        F.when(ok, F.element_at(top, 1)["score"]).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(ok, text).otherwise(F.lit("ERROR")).alias("all_predictions"),
        F.when(ok, F.lit("Success")).otherwise(F.lit("Error")).alias("status"),
    ]
    return wide.select(*cols)


def packaged_predictions(wide: DataFrame, codes: list[str], threshold: float = 0.5,
                         inclusive: bool = False, row: str = "row_id",
                         scores: str = "scores", as_text: bool = False) -> DataFrame:
    """Codes over the threshold (label order), code -> probability, and the
    mean probability of the predicted codes (0.0 when none)."""
    hits = F.filter(scored_labels(scores, codes), lambda t: above(t["score"], threshold, inclusive))
    n = F.size(hits)
    total = F.aggregate(hits, F.lit(0.0), lambda acc, t: acc + t["score"])
    conf = F.when(n > 0, F.round(total / n, 6)).otherwise(F.lit(0.0))
    if as_text:
        probs = F.array_join(F.transform(hits, lambda t: F.concat(
            t["code"], F.lit(":"), F.format_string("%.6f", t["score"]))), ",")
        codes_col = F.array_join(F.transform(hits, lambda t: t["code"]), "|")
    else:
        probs = F.map_from_arrays(F.transform(hits, lambda t: t["code"]), F.transform(hits, lambda t: t["score"]))
        codes_col = F.transform(hits, lambda t: t["code"])
    return wide.select(row, codes_col.alias("predicted_codes"), n.alias("n_predicted"),
                       probs.alias("probabilities"), conf.alias("confidence"))


def confidence_level(score: Column) -> Column:
    expr = None
    for bound, name in CONFIDENCE_LEVELS:
        expr = F.when(score >= bound, name) if expr is None else expr.when(score >= bound, name)
    return expr.otherwise(CONFIDENCE_LEVELS[-1][1])


def confidence_percent(score: Column) -> Column:
    """'12.3%' (rounded half-up to one decimal before formatting)."""
    return F.format_string("%.1f%%", F.round(score * 100.0, 1))


def with_confidence(df: DataFrame, score: str = "score") -> DataFrame:
    s = F.col(score)
    return df.select("*", confidence_level(s).alias("confidence_level"),
                     confidence_percent(s).alias("confidence_percent"))


def batch_summary(batch: DataFrame, status: str = "status") -> DataFrame:
    """Total, succeeded, failed and success rate (0 when there are no rows)."""
    agg = batch.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(status) == "Success").alias("successful"),
        F.count_if(F.col(status) == "Error").alias("errors"),
    )
    return agg.select("*", F.coalesce(percent(F.col("successful"), F.col("total_records")),
                                      F.lit(0.0)).alias("success_rate"))


def category_counts(df: DataFrame, code: str = "code") -> DataFrame:
    """Count of codes by their first character."""
    return (df.groupBy(F.substring(F.col(code), 1, 1).alias("category"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "category"))
