"""Incremental upload scoring: each micro-batch through a batch operator."""

import os
import tempfile

from pyspark.sql import functions as F

from noteledger.functions.rules import input_errors
from noteledger.streaming.uploads import score_uploads, upload_stream


def test_uploads_stream_through_batch_operator(spark):
    base = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    inbox = os.path.join(base, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.csv"), "w") as f:
        f.write("patient_id,doctor_notes,age,gender\nP1,long enough note,40,M\nP2,short,130,F\n")

    def op(batch):
        e = input_errors("doctor_notes", "age")
        return batch.select("patient_id", F.size(e).alias("n_errors"))

    q = score_uploads(upload_stream(spark, inbox), op, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    q.awaitTermination(120)
    out = {r.patient_id: r.n_errors for r in spark.read.parquet(os.path.join(base, "out")).collect()}
    assert out == {"P1": 0, "P2": 2}
