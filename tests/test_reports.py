"""Validation rules and reports on the FIXTURES.md section 4 rows."""

import pytest

from noteledger.functions.rules import Rules
from noteledger.operators import reports as R
from noteledger.sources.files import VALIDATION_RECORDS

ROWS = [
    ("P1", 45, "F", "long enough text", "E11.9", None, None, 3, 2.05),
    (None, 45, "F", "long enough text", "E11.9", None, None, 3, 1.0),
    ("P3", None, "M", "long enough text", "E11.9", None, None, 3, 1.0),
    ("P4", 121, "M", "long enough text", "E11.9", None, None, 3, 9.0),
    ("P5", 45, "F", "long enough text", "E11.9", None, None, -1, 3.0),
    ("P6", 45, "F", "  short  ", "E11.9", None, None, 3, 6.0),
    ("P7", 45, "M", "long enough text", "I10", None, None, 3, 1.0),
    ("P8", 45, None, None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def recs(spark):
    return spark.createDataFrame(ROWS, VALIDATION_RECORDS)


def test_quality_summary(recs):
    r = R.quality_summary(recs).collect()[0]
    assert r.total_records == 8
    assert r.fully_valid_records == 1
    assert r.overall_quality_score == 12.5
    assert r.valid_patient_ids == 7
    assert r.unique_icd10_codes == 2


def test_first_issue_and_extract(recs):
    got = {r.patient_id: r.validation_issue for r in R.invalid_records(recs).collect()}
    assert got == {
        None: "Missing patient_id", "P3": "Missing age", "P4": "Invalid age",
        "P5": "Negative length of stay", "P6": "Short diagnosis text", "P7": "Invalid ICD-10 format",
    }
    # P8 passes the CASE (NULLs fall through) but is not fully valid
    row = recs.where("patient_id = 'P8'").select(Rules().first_issue().alias("i"),
                                                  Rules().fully_valid().alias("v")).collect()[0]
    assert row.i == "Valid" and not row.v


def test_missing_values(recs):
    got = {r.field_name: r.invalid_count for r in
           R.missing_values(recs, ["patient_id", "age", "diagnosis_text", "icd10_code"]).collect()}
    assert got == {"patient_id": 1, "age": 1, "diagnosis_text": 1, "icd10_code": 1}


def test_rule_violations_keep_three_valued_logic(recs):
    got = {r.field_name: r.invalid_count for r in R.rule_violations(recs).collect()}
    # the NULL code of P8 is neither valid nor counted invalid
    assert got == {"invalid_age": 1, "negative_length_of_stay": 1, "short_diagnosis_text": 1,
                   "invalid_icd10_format": 1}


def test_buckets_keep_gaps(recs):
    sev = {r.severity_group: r["count"] for r in R.severity_distribution(recs).collect()}
    assert sev["Unknown"] == 2  # 2.05 falls in the gap, P8 is NULL
    los = {r.los_group: r["count"] for r in R.stay_distribution(recs).collect()}
    assert los["1 day or less"] == 1  # the negative stay
    pct = sum(r.percentage for r in R.age_distribution(recs).collect())
    assert abs(pct - 100.0) < 0.05


def test_distribution_order_and_percent(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "g string")
    rows = R.distribution(df, df.g, "g", "G").collect()
    assert [(r.g, r["count"], r.percentage) for r in rows] == [("b", 2, 50.0), (None, 1, 25.0), ("a", 1, 25.0)] or \
        [(r.g, r["count"], r.percentage) for r in rows] == [("b", 2, 50.0), ("a", 1, 25.0), (None, 1, 25.0)]


def test_histogram_bins(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "x double")
    rows = R.histogram(df, F.col("x"), 5, "x").collect()
    assert [r["count"] for r in rows] == [2, 2, 1, 0, 1]  # top edge in the last bin
    assert rows[0].bin_start == 0.0 and rows[-1].bin_end == 10.0


def test_dataset_metadata(spark):
    rows = [(1, 30, "M", "I10|E11.9", "note"), (2, 50, "F", "I10", None), (3, 70, "F", "bad", "")]
    df = spark.createDataFrame(rows, "record_id long, age int, gender string, codes string, note string")
    r = R.dataset_metadata(df, note="note").collect()[0]
    assert r.num_records == 3 and r.total_unique_codes == 3 and r.age_range == "30-70"
    assert r.gender_distribution == "F:2, M:1"
    assert r.code_distribution.startswith("I10:2")
    assert r.all_icd10_valid is False and r.no_null_notes is False and r.no_empty_notes is False
    m = R.dataset_metrics(df, note="note").collect()[0]
    assert m.avg_codes_per_record == 1.33 and m.gender_balance == 0.5 and m.age_std == 20.0


def test_distinct_counts_do_not_multiply_rows(spark):
    ids = [0, 0, 1, -1, -1, 32767, 32768, 32769, -32768, 2**40, 2**40, None, -2**40]
    df = spark.createDataFrame([(i, 30, "F", "long enough text", f"E1{abs(i or 0) % 3}.9", 3) for i in ids],
                               "patient_id long, age int, gender string, diagnosis_text string, icd10_code string, length_of_stay int")
    out = R.quality_summary(df)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in R.report_metadata(df)._jdf.queryExecution().executedPlan().toString()
    r = out.first()
    assert (r.unique_patients, r.unique_icd10_codes, r.total_records) == (len(set(ids)) - 1, 3, len(ids))
    text = df.withColumn("patient_id", df.patient_id.cast("string"))
    assert R.report_metadata(text).first().unique_patients == len(set(ids)) - 1
    assert R.quality_summary(df.limit(0)).first().unique_patients == 0
