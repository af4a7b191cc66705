"""The batch stages end to end on a small raw CSV."""

import os
import tempfile

import pytest

from noteledger.operators import stages as ST
from noteledger.sources import files as IO

RAW = """patient_id,age,gender,doctor_notes,diagnosis_date,icd10_codes,icd10_codes_list,medical_conditions
P000001,45,M,"Chest pain, mild; examination done",2024-01-02,I10|E11.9,"['I10', 'E11.9']",[]
P000002,60,F,Severe back pain and fatigue,2024-02-03,M54.5,"['M54.5']",[]
P000003,30,F,"Chronic headache, moderate nausea",2024-03-04,G43.909|R51,"['G43.909', 'R51']",[]
P000004,71,M,Acute chest pressure,2024-04-05,I10|bad,"['I10']",[]
P000005,25,F,mild pain in the knee,2024-05-06,,[],[]
"""


def _raw(spark):
    d = tempfile.mkdtemp(prefix="stage-", dir="/tmp")
    with open(os.path.join(d, "raw.csv"), "w") as f:
        f.write(RAW)
    return IO.read_csv(spark, d), d


def test_preprocess_and_split(spark):
    raw, d = _raw(spark)
    feats, mapping, model, metrics = ST.preprocess(raw)
    m = metrics.collect()[0]
    assert (m.input_records, m.output_records, m.unique_icd10_codes) == (5, 5, 5)
    codes = [r.icd10_code for r in mapping.orderBy("code_index").collect()]
    assert codes == ["E11.9", "G43.909", "I10", "M54.5", "R51"]
    rows = {r.patient_id: r for r in feats.collect()}
    assert rows["P000001"].icd10_onehot == [1, 0, 1, 0, 0]
    assert rows["P000004"].processed_codes == ["I10"]
    assert rows["P000001"].medical_features["symptoms_count"] == 1
    assert rows["P000005"].icd10_onehot == [0, 0, 0, 0, 0]
    s, sm = ST.split_and_write(feats.select("patient_id", "age"), "patient_id", d)
    r = sm.collect()[0]
    assert (r.train_records, r.validation_records, r.test_records) == (3, 1, 1)
    assert os.path.isdir(os.path.join(d, "splits", "split=train"))


def test_write_validation_reports(spark):
    from noteledger.sources.files import VALIDATION_RECORDS

    rows = [("P1", 45, "F", "long enough text", "E11.9", None, None, 3, 2.05),
            ("P2", 130, "M", "short", "I10", None, None, -2, 9.5)]
    df = spark.createDataFrame(rows, VALIDATION_RECORDS)
    out = tempfile.mkdtemp(prefix="reports-", dir="/tmp")
    names = ST.write_validation_reports(df, out)
    assert len(names) == 10
    summary = spark.read.option("header", True).csv(os.path.join(out, "validation_summary")).collect()[0]
    assert summary.fully_valid_records == "1" and summary.overall_quality_score == "50.0"


@pytest.mark.parametrize(("kind", "params"), [("lr", {"maxIter": 20}), ("gbt", {"rounds": 4, "depth": 2})])
def test_train_evaluate_log_and_score_uploads(spark, kind, params):
    import tempfile

    from noteledger.operators import runs as H
    from noteledger.operators import scoring as S

    raw, d = _raw(spark)
    feats, mapping, model, _ = ST.preprocess(raw, vocab_size=50, min_df=1)
    feats = ST.model_features(feats)
    split, _ = ST.split_and_write(feats, "patient_id")
    runs = tempfile.mkdtemp(prefix="runs-", dir="/tmp") + "/runs"
    models, metrics = ST.train_and_evaluate(split, 5, kind=kind, runs_path=runs, run_id="r1", **params)
    m = metrics.collect()[0]
    assert 0.0 <= m.element_accuracy <= 1.0
    keys = {r.key for r in H.read_runs(spark, runs).collect()}
    assert {"classifier", "f1_micro", "hamming_loss"} <= keys
    up = spark.createDataFrame([("U1", "chest pain and nausea", 50, "M"), ("U2", None, 40, "F")],
                               "patient_id string, doctor_notes string, age int, gender string")
    codes = [r.icd10_code for r in mapping.orderBy("code_index").collect()]
    table = {r.patient_id: r for r in ST.score_uploads_table(up, model, models, codes).collect()}
    assert table["U1"].status == "Success" and table["U1"].top_prediction in codes
    assert table["U1"].all_predictions.count(";") == 2
    assert (table["U2"].status, table["U2"].top_prediction) == ("Error", "ERROR")
    summary = S.batch_summary(ST.score_uploads_table(up, model, models, codes)).collect()[0]
    assert summary.success_rate == 50.0
