"""Sources and sinks, the SQL functions and the text vectors."""

import os

import pytest
from pyspark.sql import functions as F

from noteledger.functions import text as T
from noteledger.functions.codes import parse_code_set
from noteledger.functions.rules import RecordColumns
from noteledger.operators import reports as R
from noteledger.operators import text_vectors as TV
from noteledger.plans.surface import QUERIES, SQL
from noteledger.sources import files as FI
from noteledger.sources import sql as SQ

from .conftest import SF_SMALL


def lines(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as out:
        out.write("\n".join(rows) + "\n")


def test_broken_lines_are_kept(spark, tmp_path):
    path = str(tmp_path / "up")
    lines(path, "a.csv", ["patient_id,doctor_notes,age", "1,fine note,30", "2,too,many,fields,here", "3", "4,\"a, quoted\",x", "5,last,40"])
    up = {r.patient_id: r for r in FI.read_upload(spark, path, multi_line=False, malformed=True).collect()}
    assert sorted(up) == ["1", "2", "3", "4", "5"]
    assert [i for i in sorted(up) if up[i][FI.MALFORMED] is not None] == ["2", "3"]
    few = FI.read_upload(spark, path, multi_line=False, malformed=True).select("patient_id", FI.MALFORMED).where(F.col(FI.MALFORMED).isNotNull())
    assert sorted(r.patient_id for r in few.collect()) == ["2", "3"]
    assert up["4"].doctor_notes == "a, quoted" and up["4"].age is None and up["5"].age == 40
    assert "_malformed" not in FI.read_upload(spark, path).columns


def test_typed_columns_that_do_not_parse(spark, tmp_path):
    path = str(tmp_path / "raw")
    lines(path, "a.csv", ["patient_id,age,gender,doctor_notes,diagnosis_date,icd10_codes,icd10_codes_list,medical_conditions", "P1,30,F,note,2024-01-02,I10,[],[]", "P2,old,F,note,not a date,I10,[],[]"])
    got = {r.patient_id: r for r in FI.read_csv(spark, path, multi_line=False, malformed="bad").collect()}
    assert got["P1"].bad is None and got["P1"].age == 30
    assert got["P2"].bad is not None and got["P2"].age is None and got["P2"].gender == "F"


@pytest.mark.parametrize("multi_line", [True, False])
def test_default_ids_follow_many_files(spark, tmp_path, multi_line):
    path = str(tmp_path / "many")
    want = []
    for f, n in enumerate([3, 900, 1, 40, 2, 300]):
        notes = [f"note {f} {i} " + "x" * (i % 50) for i in range(n)]
        want += notes
        lines(path, f"part-{f:03d}.csv", ["clinical_notes,patient_age", *(f"{t},{i}" for i, t in enumerate(notes))])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = FI.read_upload(spark, path, multi_line).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = {r.patient_id: r.doctor_notes for r in rows}
    # leading and trailing white space is kept
    assert got == {f"Patient_{i}": t for i, t in enumerate(want, 1)}


RECORDS = [
    ("P1", 45, "F", "long enough text", "E11.9", 3), (None, 45, "M", "long enough text", "E11.9", 3), ("P3", None, "M", "long enough text", "E11.9", 3),
    ("P4", 121, None, "long enough text", "E11.9", 30), ("P5", 45, "F", "long enough text", "E11.9", -1), ("P6", 45, "F", "  short  ", "E11.9", 3),
    ("P7", 45, "F", "long enough text", "I10", 3), ("P8", 45, "F", None, None, None)]


def test_reports_as_sql_equal_the_operators(spark):
    df = spark.createDataFrame(RECORDS, "patient_id string, age int, gender string, diagnosis_text string, icd10_code string, length_of_stay int")
    FI.register_view(df, "checked_records")
    cols = RecordColumns()
    SQ.register_reports(spark, "checked_records", cols)
    rows = lambda f: sorted(map(str, (tuple(r) for r in f.collect())))
    assert rows(SQ.run_report(spark, "report_quality")) == rows(R.quality_summary(df, cols))
    assert rows(SQ.run_report(spark, "report_metadata")) == rows(R.report_metadata(df, cols))
    assert rows(SQ.run_report(spark, "report_violations")) == rows(R.rule_violations(df, cols))
    assert rows(SQ.run_report(spark, "report_missing")) == rows(R.missing_values(df, [cols.id, cols.age, cols.gender, cols.text, cols.code, cols.stay]))
    assert rows(SQ.run_report(spark, "report_ages")) == rows(R.age_distribution(df, "age"))
    assert rows(SQ.run_report(spark, "report_stays")) == rows(R.stay_distribution(df))
    assert rows(SQ.run_report(spark, "report_prefixes")) == rows(R.prefix_distribution(df))
    assert rows(SQ.run_report(spark, "report_issues")) == rows(R.invalid_records(df).groupBy("validation_issue").count())


def test_scalar_functions_equal_the_columns(spark):
    SQ.register_functions(spark)
    texts = ["  Chest pain, PAIN & (mild)  headache!  ", "Émile: fièvre 38,5°C — test", "", None, "x" * 130, " I10 |E11.9||bad", "G43.9099|i10|J45.909 "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    FI.register_view(df, "some_texts")
    got = spark.sql("SELECT i, clean_note(t), clean_note_app(t), note_preview(t), parse_codes(t) FROM some_texts ORDER BY i").collect()
    want = df.orderBy("i").select("i", T.clean_text("t"), T.clean_text_app("t"), T.preview("t"), parse_code_set("t")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    row = spark.sql("SELECT severity_group(2.05D), severity_group(9.0D), severity_group(NULL), age_group(17), stay_group(-1), is_code('I10'), is_report_code('I10')").first()
    assert tuple(row) == ("Unknown", "Critical (>8)", "Unknown", "Under 18", "1 day or less", True, False)


def test_word_vectors_by_hand(spark):
    import hashlib

    docs = [(1, ["a", "b", "", "c"]), (2, ["b", "a"]), (3, []), (4, None), (5, ["d"])]
    df = spark.createDataFrame(docs, "id int, words array<string>")
    bits = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:4], 16)
    sign = lambda w, j: 1 - 2 * (bits(w) >> j & 1)
    vectors = TV.word_vectors(df, "words", dims=5, window=1).cache()
    got = {r.word: (r.n, r.vector) for r in vectors.collect()}
    # a stands beside b twice, b beside a twice and c once
    assert got["a"] == (2, [10**6 * 2 * sign("b", j) // 2 for j in range(5)])
    assert got["b"] == (2, [10**6 * (2 * sign("a", j) + sign("c", j)) // 2 for j in range(5)])
    assert got["d"] == (1, [0] * 5)
    mean = {r.id: (r.n_tokens, r.vector) for r in TV.mean_vectors(df, "id", "words", vectors, dims=5).collect()}
    assert mean[2] == (2, [(got["a"][1][j] + got["b"][1][j]) // 2 for j in range(5)])
    assert mean[3] == mean[4] == (0, [0] * 5)
    first = {r.id: (r.word, r.vector) for r in TV.first_vectors(df, "id", "words", vectors, dims=5).collect()}
    assert first[1] == ("a", got["a"][1]) and first[3] == (None, [0] * 5)
    assert TV.word_vectors(df, "words", max_tokens=1).where("word = 'c'").count() == 0


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0
