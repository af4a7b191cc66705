"""Readers and sinks."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from noteledger.sources import files as IO


def _tmp():
    return tempfile.mkdtemp(prefix="io-", dir="/tmp")


def test_upload_aliases_and_default_ids(spark):
    d = _tmp()
    with open(os.path.join(d, "up.csv"), "w") as f:
        f.write("clinical_notes,patient_age,patient_gender\n\"chest pain, mild\",45,M\nshort,130,F\n")
    rows = IO.read_upload(spark, d).orderBy("patient_id").collect()
    assert [(r.patient_id, r.doctor_notes, r.age, r.gender) for r in rows] == [
        ("Patient_1", "chest pain, mild", 45, "M"), ("Patient_2", "short", 130, "F")]


def test_upload_keeps_given_ids(spark):
    d = _tmp()
    with open(os.path.join(d, "up.csv"), "w") as f:
        f.write("patient_id,doctor_notes,age\nA7,some text here,abc\n")
    r = IO.read_upload(spark, d).collect()[0]
    assert (r.patient_id, r.age, r.gender) == ("A7", None, None)


def test_required_columns(spark):
    df = spark.createDataFrame([(1, "x")], "patient_id int, age string")
    assert IO.missing_columns(df) == ["gender", "doctor_notes", "icd10_codes"]


def test_csv_roundtrip_with_schema(spark):
    d = _tmp()
    rows = [("P000001", 40, "F", "note, with comma", None, "I10|E11.9", None, None)]
    df = spark.createDataFrame(rows, IO.RAW_RECORDS).withColumn("diagnosis_date", F.to_date(F.lit("2024-01-31")))
    IO.write_records_csv(df, d + "/raw")
    back = IO.read_csv(spark, d + "/raw").collect()[0]
    assert back.doctor_notes == "note, with comma" and str(back.diagnosis_date) == "2024-01-31"


def test_partitioned_parquet_and_json_document(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, "train"), (2, "test")], "k long, split string")
    IO.write_parquet(df, d + "/splits", ["split"])
    assert os.path.isdir(d + "/splits/split=train")
    back = IO.read_parquet(spark, d + "/splits").where("split = 'test'").collect()
    assert [r.k for r in back] == [2]
    doc = IO.metadata_document(spark, {"counts": df.agg(F.count("*").alias("n")),
                                       "keys": df.agg(F.max("k").alias("max_k"))})
    IO.write_json_document(doc, d + "/meta")
    part = [p for p in os.listdir(d + "/meta") if p.endswith(".json")][0]
    assert json.loads(open(os.path.join(d, "meta", part)).read()) == {"counts": {"n": 2}, "keys": {"max_k": 2}}
