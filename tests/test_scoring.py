"""Scoring tables: top-k, thresholds, packaging, summary."""

from noteledger.operators import scoring as S

CODES = ["A00", "B01", "C02", "D03"]


def _wide(spark):
    rows = [(1, [0.9, 0.7, 0.7, 0.1]), (2, [0.2, 0.3, 0.1, 0.4]), (3, None)]
    return spark.createDataFrame(rows, "row_id long, scores array<double>")


def test_top3_ties_by_label(spark):
    top = S.top_k(_wide(spark), CODES, 3, 0.7, inclusive=True).where("row_id = 1").orderBy("rank").collect()
    assert [(r.code, r.above_threshold) for r in top] == [("A00", True), ("B01", True), ("C02", True)]
    strict = S.top_k(_wide(spark), CODES, 3, 0.7, inclusive=False).where("row_id = 1").orderBy("rank").collect()
    assert [r.above_threshold for r in strict] == [True, False, False]


def test_batch_scores_and_errors(spark):
    b = {r.patient_id: r for r in S.batch_scores(_wide(spark), CODES).collect()}
    assert b[1].all_predictions == "A00(0.900); B01(0.700); C02(0.700)"
    assert b[2].top_prediction == "D03" and b[2].confidence == 0.4
    assert (b[3].status, b[3].top_prediction, b[3].confidence) == ("Error", "ERROR", 0.0)
    s = S.batch_summary(S.batch_scores(_wide(spark), CODES)).collect()[0]
    assert (s.total_records, s.successful, s.errors, s.success_rate) == (3, 2, 1, 66.67)


def test_packaged_prediction(spark):
    p = {r.row_id: r for r in S.packaged_predictions(_wide(spark), CODES, 0.5).collect()}
    assert p[1].predicted_codes == ["A00", "B01", "C02"]
    assert p[1].confidence == round((0.9 + 0.7 + 0.7) / 3, 6)
    assert p[2].predicted_codes == [] and p[2].confidence == 0.0


def test_confidence_levels(spark):
    df = spark.createDataFrame([(0.8,), (0.6,), (0.59,), (0.123,)], "score double")
    got = [(r.confidence_level, r.confidence_percent) for r in S.with_confidence(df).collect()]
    assert got == [("High", "80.0%"), ("Medium", "60.0%"), ("Low", "59.0%"), ("Low", "12.3%")]
