"""The reference's batch stages, composed from the operators.

* :func:`preprocess`: raw records -> features table (cleaned text, lexicon
  map, validated codes, one-hot labels, tokens, TF / TF-IDF vectors), the
  code mapping and a metrics row.
* :func:`split_and_write`: exact train / validation / test assignment,
  written partitioned by split, with a split metrics row.
* :func:`write_validation_reports`: every validation report of a record
  table as CSV.

Each stage is a lazy plan until its sink; fitted artifacts (the dictionary,
the ML pipeline) are materialized once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import parse_code_set
from ..functions.patterns import CODE_STRICT, STOP_WORDS, TRAINING_LEXICON, VOCAB_MIN_DF, VOCAB_SIZE
from ..functions.rules import RecordColumns
from ..functions.text import clean_text, lexicon_counts, word_runs
from ..session import materialize
from . import labels as L
from . import reports as R
from .split import assign_split
from .vectorize import feature_pipeline


def preprocess(raw: DataFrame, id_col: str = "patient_id", text: str = "doctor_notes",
               codes: str = "icd10_codes", lexicon: dict = TRAINING_LEXICON, pattern: str = CODE_STRICT,
               stop_words: list[str] = STOP_WORDS, vocab_size: int = VOCAB_SIZE, min_df: int = VOCAB_MIN_DF,
               raw_dictionary: bool = False):
    """Returns (features, code_mapping, fitted ML pipeline, metrics row)."""
    counts = lexicon_counts(None, lexicon, tokens="_runs")
    feature_map = F.create_map(*[x for k, c in counts.items() for x in (F.lit(k), c)])
    # text, runs and counts in steps: inside one projection every count would clean the text again
    base = (raw.withColumn("cleaned_notes", clean_text(text)).withColumn("_runs", word_runs("cleaned_notes"))
            .withColumn("medical_features", feature_map).withColumn("processed_codes", parse_code_set(codes, pattern))
            .drop("_runs"))
    dictionary = materialize(L.code_dictionary(raw, codes, raw=raw_dictionary, pattern=pattern))
    with_labels = L.one_hot_labels(base, dictionary, codes, pattern, "icd10_onehot", "icd10_indexes")
    model = feature_pipeline("cleaned_notes", stop_words, vocab_size, min_df).fit(with_labels)
    features = model.transform(with_labels)
    mapping = dictionary.select(F.col("code").alias("icd10_code"), "code_index")
    metrics = features.sparkSession.range(1).select(
        raw.select(F.count(F.lit(1))).scalar().alias("input_records"),
        features.select(F.count(F.lit(1))).scalar().alias("output_records"),
        dictionary.select(F.count(F.lit(1))).scalar().alias("unique_icd10_codes"),
        F.lit(len(model.stages[2].vocabulary)).alias("vocabulary_size"),
        F.lit(min_df).alias("min_document_frequency"),
        F.lit(len(features.columns)).alias("feature_count"),
    )
    return features, mapping, model, metrics


def split_and_write(features: DataFrame, id_col: str, out_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Assign the exact split; write it partitioned by ``split`` (when a
    folder is given) and return (split frame, split metrics row)."""
    s = assign_split(features, id_col)
    if out_dir:
        s.write.mode("overwrite").partitionBy("split").parquet(os.path.join(out_dir, "splits"))
        s = s.sparkSession.read.parquet(os.path.join(out_dir, "splits"))
    agg = s.agg(F.count(F.lit(1)).alias("total_records"),
                *[F.count_if(F.col("split") == k).alias(f"{k}_records") for k in ("train", "validation", "test")])
    metrics = agg.select("*", *[F.round(F.col(f"{k}_records") / F.col("total_records"), 6).alias(f"{k}_ratio")
                                for k in ("train", "validation", "test")])
    return s, metrics


def validation_reports(df: DataFrame, cols: RecordColumns = RecordColumns()) -> dict[str, DataFrame]:
    """All validation reports of a record table, by report name."""
    return {
        "validation_summary": R.quality_summary(df, cols),
        "missing_values": R.missing_values(df, [cols.id, cols.age, cols.gender, cols.text, cols.code]),
        "data_validation": R.rule_violations(df, cols),
        "gender_distribution": R.category_distribution(df, cols.gender, "Gender Distribution"),
        "age_distribution": R.age_distribution(df, cols.age),
        "icd10_distribution": R.prefix_distribution(df, cols.code),
        "los_distribution": R.stay_distribution(df, cols.stay),
        "severity_distribution": R.severity_distribution(df, cols.severity),
        "invalid_records": R.invalid_records(df, cols),
        "report_metadata": R.report_metadata(df, cols),
    }


def write_validation_reports(df: DataFrame, out_dir: str, cols: RecordColumns = RecordColumns()) -> list[str]:
    """Write every report as CSV with a header; returns the report names.
    Aggregate reports become one file each; the record extract keeps its
    parallelism."""
    from ..sources.files import write_report_csv

    reports = validation_reports(df, cols)
    for name, rep in reports.items():
        write_report_csv(rep, os.path.join(out_dir, name), single_file=(name != "invalid_records"))
    return list(reports)


def model_features(df: DataFrame, text: str = "doctor_notes", age: str | None = "age",
                   gender: str | None = "gender", vector: str = "tfidf_features",
                   out: str = "features") -> DataFrame:
    """Text vector followed by the engineered block. Training and scoring use
    this one definition, on the raw text."""
    from pyspark.ml.feature import VectorAssembler

    from .features import ENGINEERED_NAMES, engineered_block

    with_block = engineered_block(df, text, age, gender)
    va = VectorAssembler(inputCols=[vector] + ENGINEERED_NAMES, outputCol=out)
    return va.transform(with_block).drop(*ENGINEERED_NAMES)


def train_and_evaluate(split_df: DataFrame, n_labels: int, id_col: str = "patient_id",
                       truth: str = "icd10_onehot", kind: str = "gbt", threshold: float = 0.5,
                       runs_path: str | None = None, run_id: str = "run", parallelism: int = 4, **params):
    """Fit one model per label on train (+ validation rows for early stopping
    with GBT), evaluate on test, optionally append params and metrics to the
    run table. Returns (models, metrics row)."""
    from pyspark.ml.functions import vector_to_array

    from . import boosting as BO
    from . import models as MO
    from . import runs as H

    if kind == "gbt":
        train = split_df.where(F.col("split") != "test").withColumn("is_val", F.col("split") == "validation")
        models = BO.fit_labels(train.withColumn("_dense", vector_to_array("features")), n_labels, id_col, "_dense", truth, "is_val", **params)
    else:
        models = MO.fit_binary_relevance(split_df.where(F.col("split") == "train"), n_labels, kind, truth=truth,
                                         parallelism=parallelism, **params)
    scored = materialize(MO.score(models, split_df.where(F.col("split") == "test")))
    metrics = MO.evaluate(scored, threshold, id_col, truth)
    if runs_path:
        row = metrics.collect()[0].asDict()  # one row of a handful of numbers
        H.append_runs(H.run_rows(split_df.sparkSession, run_id, {"classifier": kind, **params}, row), runs_path)
    return models, metrics


def score_uploads_table(uploads: DataFrame, pipeline_model, models: list, codes: list[str],
                        text: str = "doctor_notes") -> DataFrame:
    """The scoring-app batch flow: text vector from the fitted feature
    pipeline, engineered block, per-label probabilities, then the batch table.
    Text and block are cleaned as in training, so a model meets the features
    it was fitted on. A row without a note is kept with status 'Error'."""
    from . import models as MO
    from .scoring import batch_scores

    ok = uploads.where(F.col(text).isNotNull())
    cleaned = ok.withColumn("cleaned_notes", clean_text(text))
    vec = pipeline_model.transform(cleaned)
    feats = model_features(vec, text, "age", "gender")
    scored = MO.score(models, feats)
    good = batch_scores(scored, codes, row="patient_id", note=text)
    bad = uploads.where(F.col(text).isNull()).select(
        "patient_id", F.lit(None).cast("string").alias("doctor_notes"), F.lit("ERROR").alias("top_prediction"),
        F.lit(0.0).alias("confidence"), F.lit("ERROR").alias("all_predictions"), F.lit("Error").alias("status"))
    return good.unionByName(bad)
