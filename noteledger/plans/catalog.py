"""Named queries over the input tables: one per operator family.

Each entry takes (spark, sf_dir) and returns a DataFrame over the whole tables;
a query that reads one role in several branches writes that role first. Column names equal those of the SQL twins in
:mod:`noteledger.plans.oracle`. Lexicons and patterns are parameters of the
operators; the word lists below are chosen from words that occur in the
``documents`` table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.codes import code_pieces, parse_code_set
from ..functions.rules import RecordColumns, input_errors
from ..operators import features as FE
from ..operators import labels as L
from ..operators import metrics as M
from ..operators import reports as R
from ..operators import runs as H
from ..operators import scoring as S
from ..operators import split as SP
from ..operators import stages as ST
from ..operators import vectorize as V
from ..session import materialize
from ..sources import roles
from ..sources.tables import read_table, spread

# the rules look at the note's length, so no text is in the shuffle
RECORD_LEN_COLS = RecordColumns(id="record_id", age="age", gender="category", text="note_len", code="code",
                                stay="stay", text_length="note_len")

# Lexicon groups for the input documents (four languages).
DATA_LEXICON = {
    "en_words": ["the", "of", "and", "to", "in", "is", "that", "for"],
    "fr_words": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "pour"],
    "de_words": ["der", "die", "und", "den", "von", "zu", "das"],
    "es_words": ["el", "los", "del", "las", "por", "con"],
}

# Phrase groups: earlier multi-word phrases hide the words inside them.
DATA_PHRASES = {
    "en_phrases": ["of the", "in the", "the", "and", "is"],
    "fr_phrases": ["de la", "de", "la", "les", "des"],
    "de_phrases": ["in der", "der", "die", "und"],
    "es_phrases": ["de la", "de los", "que", "el", "los"],
}

THRESHOLD = 0.5


def _ids(spark, d):
    # id-only work is cheap per row: no spreading needed
    return read_table(spark, d, "documents").select("doc_id")


def _docs(spark, d):
    # text operators are CPU-bound: use all cores even on a narrow input
    return spread(read_table(spark, d, "documents"), "doc_id")


# -- reports ----------------------------------------------------------------

# what the validity rules look at, with the note's length for the note
RULE_COLUMNS = ["record_id", "age", "category", "note_len", "code", "stay"]


def q_quality_summary(spark, d):
    return R.quality_summary(roles.records(spark, d, RULE_COLUMNS), RECORD_LEN_COLS)


def q_report_metadata(spark, d):
    return R.report_metadata(roles.records(spark, d, RULE_COLUMNS), RECORD_LEN_COLS)


def q_missing_values(spark, d):
    cols = {c: c for c in ["record_id", "age", "category"]}
    cols["note"] = "note_chars"  # NULL exactly when the note is
    cols.update({c: c for c in ["code", "stay", "quality", "toxic"]})
    return R.missing_values(roles.records(spark, d, list(cols.values())), cols)


def q_rule_violations(spark, d):
    return R.rule_violations(roles.records(spark, d, RULE_COLUMNS), RECORD_LEN_COLS)


def q_invalid_records(spark, d):
    """Failing records are found on lengths; their texts are fetched last."""
    found = R.invalid_records(roles.records(spark, d, RULE_COLUMNS), RECORD_LEN_COLS, keep=RULE_COLUMNS).drop("note_len")
    notes = read_table(spark, d, "documents").select(F.col("doc_id").alias("record_id"), F.col("text").alias("note"))
    return (found.join(notes, "record_id", "left")
            .select("record_id", "age", "category", "note", "code", "stay", "validation_issue")
            .orderBy("validation_issue", "record_id"))


def q_validation_errors(spark, d):
    rec = roles.records(spark, d, ["record_id", "age", "note_strip_len"])
    errs = input_errors(None, "age", stripped_length="note_strip_len")
    return rec.select("record_id", F.size(errs).alias("n_errors"), F.array_join(errs, "; ").alias("errors"))


def q_category_distribution(spark, d):
    return R.category_distribution(read_table(spark, d, "documents"), "lang", "Language Distribution")


def q_prefix_distribution(spark, d):
    return R.prefix_distribution(roles.records(spark, d, ["code"]), "code")


def q_age_buckets(spark, d):
    cust = read_table(spark, d, "customer").select(roles.age_of_balance().alias("age"))
    return R.age_distribution(cust, "age")


def q_stay_buckets(spark, d):
    return R.stay_distribution(read_table(spark, d, "part"), "p_size")


def q_severity_buckets(spark, d):
    return R.severity_distribution(roles.severity(spark, d), "severity_score")


CODED = ["record_id", "codes"]


def _visits(spark, d, columns):
    """Columns of the visits role written once to the checkpoint folder, for
    queries that read them in several branches (counts, groups, subqueries).
    This is the one eager step of these queries."""
    return materialize(roles.visits(spark, d, columns))


def q_dataset_metadata(spark, d):
    return R.dataset_metadata(_visits(spark, d, ["age", "gender", "codes", "note_chars"]), note_length="note_chars")


def q_dataset_metrics(spark, d):
    return R.dataset_metrics(_visits(spark, d, ["age", "gender", "codes", "note_chars"]), note_length="note_chars")


def q_profile(spark, d):
    return R.profile(roles.records(spark, d, ["age", "category", "note_chars"]), "age", "category", text_length="note_chars")


def q_histogram_value(spark, d):
    return R.histogram(read_table(spark, d, "events"), F.col("value"), 20, "value")


def q_histogram_codes(spark, d):
    v = _visits(spark, d, CODED)
    return R.histogram(v, F.size(code_pieces("codes")), 10, "codes_per_record")


def q_top_codes(spark, d):
    return R.top_counts(R.code_counts(roles.visits(spark, d, CODED)), "code", 10)


def q_codes_per_record(spark, d):
    return R.codes_per_record(roles.visits(spark, d, CODED))


# -- text -------------------------------------------------------------------

def q_clean_text(spark, d):
    c = T.clean_text("text")
    return _docs(spark, d).select("doc_id", c.alias("cleaned"), F.length(c).alias("note_length"))


def q_clean_text_app(spark, d):
    return _docs(spark, d).select("doc_id", T.clean_text_app("text").alias("cleaned_app"))


def q_lexicon_counts(spark, d):
    docs = _docs(spark, d).select("doc_id", T.clean_text("text").alias("clean"))
    toks = docs.select("doc_id", T.word_runs("clean").alias("runs"))
    counts = T.lexicon_counts(None, DATA_LEXICON, tokens="runs")
    return toks.select("doc_id", *[c.alias(k) for k, c in counts.items()])


def q_lexicon_presence(spark, d):
    docs = _docs(spark, d).select("doc_id", F.lower(T.clean_text_app("text")).alias("low"))
    return docs.select("doc_id", *[T.substring_presence("low", w, lowered=True).alias(k.replace("_words", "_present"))
                                   for k, w in DATA_LEXICON.items()])


def q_entities(spark, d):
    docs = _docs(spark, d).select("doc_id", T.doubled_text("text").alias("doubled"))
    return docs.select("doc_id", *[F.array_join(T.entities_in("doubled", p), ", ").alias(k)
                                   for k, p in DATA_PHRASES.items()])


def q_text_metrics(spark, d):
    return _docs(spark, d).select("doc_id", *[c.alias(k) for k, c in T.text_metrics("text").items()])


def q_preview(spark, d):
    return _docs(spark, d).select("doc_id", T.preview("text").alias("preview"))


def q_feature_map(spark, d):
    """Lexicon features as one map column (8 keys), then counts read back
    from the map with a default of 0."""
    docs = _docs(spark, d).select("doc_id", T.word_runs(T.clean_text("text")).alias("runs"))
    counts = T.lexicon_counts(None, DATA_LEXICON, tokens="runs")
    m = F.create_map(*[x for k, c in counts.items() for x in (F.lit(k), c)])
    feats = docs.select("doc_id", m.alias("features"))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("features")),
                                    lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")
    return feats.select("doc_id", text.alias("feature_map"),
                        *[F.coalesce(F.col("features")[f"{k}_count"], F.lit(0)).alias(f"{k}_count")
                          for k in DATA_LEXICON])


def q_preprocess_metrics(spark, d):
    """The preprocess stage run over all documents, and what it counts of
    itself: rows in and out, distinct codes, the fitted vocabulary, columns."""
    code = F.concat(F.upper(F.substring("lang", 1, 1)), F.lpad((F.col("n_chars") % 100).cast("string"), 2, "0"))
    raw = _docs(spark, d).select("doc_id", "text", code.alias("codes"))
    return ST.preprocess(raw, "doc_id", "text", "codes", DATA_LEXICON)[3]


def engineered_records(spark, d, app: bool = False):
    """doc_id and the engineered block: counts are made on the text before the age is joined."""
    block = FE.app_engineered_block if app else FE.engineered_block
    docs = block(_docs(spark, d).select("doc_id", "text", "lang"), "text", None, "lang", DATA_LEXICON, "en")
    age = read_table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), roles.age_of_balance().cast("double").alias("_age"))
    value = (F.col("_age") - 50.0) / 20.0 if app else F.col("_age")
    return (docs.drop("text", "lang").join(age, "doc_id", "left")
            .withColumn(FE.ENGINEERED_NAMES[0], F.coalesce(value, F.lit(0.0))).select("doc_id", *FE.ENGINEERED_NAMES))


def q_engineered_train(spark, d):
    return engineered_records(spark, d)


def q_engineered_app(spark, d):
    return engineered_records(spark, d, app=True)


def q_ensemble_join(spark, d):
    """Dense and engineered block of every embedding; without a record the latter is 0."""
    emb = read_table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "label", "embedding")
    joined = emb.join(engineered_records(spark, d), "doc_id", "left").fillna(0.0, FE.ENGINEERED_NAMES)
    return joined.select("doc_id", "label", F.size("embedding").alias("dense_width"), F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("dense_first"),
                         *FE.ENGINEERED_NAMES)


# -- codes and labels -------------------------------------------------------

def q_code_parse(spark, d):
    v = roles.visits(spark, d, CODED)
    valid = parse_code_set("codes")
    return v.select("record_id", F.size(code_pieces("codes")).alias("n_pieces"),
                    F.size(valid).alias("n_valid"), F.array_join(valid, "|").alias("valid_codes"))


def q_code_dictionary(spark, d):
    return L.code_dictionary(roles.visits(spark, d, CODED))


def q_code_dictionary_raw(spark, d):
    return L.code_dictionary(roles.visits(spark, d, CODED), raw=True)


def q_one_hot(spark, d):
    v = _visits(spark, d, CODED)
    oh = L.one_hot_labels(v, materialize(L.code_dictionary(v)))
    return oh.select("record_id", F.aggregate("labels", F.lit(0), lambda a, x: a + x).alias("n_labels"),
                     F.array_join(F.transform("labels", lambda x: x.cast("string")), "").alias("one_hot"))


def q_label_pairs(spark, d):
    v = _visits(spark, d, CODED)
    return L.label_pairs(v, materialize(L.code_dictionary(v)), "record_id")


def q_label_union(spark, d):
    v = materialize(SP.assign_split(roles.visits(spark, d, CODED), "record_id"))
    return L.label_union(v)


# -- vectorizing ------------------------------------------------------------

def _tokens(spark, d):
    return V.token_frame(_docs(spark, d), "doc_id", "text")


def q_tokens_filtered(spark, d):
    t = _tokens(spark, d)
    return t.select("doc_id", F.array_join("tokens", "|").alias("tokens"),
                    F.array_join("filtered", "|").alias("filtered"),
                    F.size("tokens").alias("n_tokens"), F.size("filtered").alias("n_filtered"))


def q_term_df_idf(spark, d):
    return V.term_df_idf(_tokens(spark, d))


def q_tfidf_long(spark, d):
    return V.tfidf_long(_tokens(spark, d), "doc_id")


# -- split, sample, folds ---------------------------------------------------

def q_split_assign(spark, d):
    return SP.assign_split(_ids(spark, d), "doc_id").select("doc_id", "split")


def q_split_metrics(spark, d):
    s = SP.assign_split(_ids(spark, d), "doc_id")
    agg = s.agg(F.count(F.lit(1)).alias("total_records"),
                *[F.count_if(F.col("split") == k).alias(f"{k}_records") for k in ("train", "validation", "test")])
    return agg.select("*", *[F.round(F.col(f"{k}_records") / F.col("total_records"), 6).alias(f"{k}_ratio")
                             for k in ("train", "validation", "test")])


def q_split_stats(spark, d):
    return R.split_statistics(materialize(SP.assign_split(roles.visits(spark, d, ["record_id", "age", "gender", "codes", "note_chars"]), "record_id")))


def q_sample_500(spark, d):
    return SP.sample_rows(_ids(spark, d), "doc_id", 500)


def q_kfold(spark, d):
    return SP.kfold(_ids(spark, d), "doc_id", 5)


def q_strat_fold(spark, d):
    v = materialize(roles.visits(spark, d, CODED).select("record_id", F.size(parse_code_set("codes")).alias("n_labels")))
    return SP.stratified_fold(v, "record_id", "n_labels", 5).select("record_id", "n_labels", "fold")


# -- scoring ----------------------------------------------------------------

def _codes(spark, d):
    return roles.label_codes(roles.label_count(spark, d))


def _wide(spark, d):
    return roles.scored_rows(spark, d, roles.label_count(spark, d))


def q_top3_per_row(spark, d):
    return S.top_k(_wide(spark, d), _codes(spark, d), 3, THRESHOLD, inclusive=True)


def q_batch_scores(spark, d):
    return S.batch_scores(_wide(spark, d), _codes(spark, d))


def q_packaged_pred(spark, d):
    return S.packaged_predictions(_wide(spark, d), _codes(spark, d), THRESHOLD, as_text=True)


def q_confidence_levels(spark, d):
    top = S.top_k(_wide(spark, d), _codes(spark, d), 3, THRESHOLD, inclusive=True)
    return S.with_confidence(top.select("row_id", "rank", "code", "score"))


def q_batch_summary(spark, d):
    return S.batch_summary(S.batch_scores(_wide(spark, d), _codes(spark, d)))


def q_batch_errors(spark, d):
    """Orders as an upload: a record without a note cannot be scored, stays in
    the batch as an error and counts as one."""
    notes = roles.visits(spark, d, ["record_id", "note_chars"])
    share = (F.col("note_chars") % 100) / 100
    wide = notes.select(F.col("record_id").alias("row_id"),
                        F.when(F.col("note_chars") > 0, F.array(share, F.lit(1.0) - share)).alias("scores"))
    return S.batch_summary(S.batch_scores(wide, ["A00", "B01"]))


def q_top_predictions(spark, d):
    """Top 10 predicted codes over the successfully scored rows."""
    b = S.batch_scores(_wide(spark, d), _codes(spark, d)).where(F.col("status") == "Success")
    counts = b.groupBy(F.col("top_prediction").alias("code")).agg(F.count(F.lit(1)).alias("count"))
    return R.top_counts(counts, "code", 10)


def q_category_counts(spark, d):
    top = S.top_k(_wide(spark, d), _codes(spark, d), 3, THRESHOLD, inclusive=True)
    return S.category_counts(top, "code")


# -- metrics ----------------------------------------------------------------

def _long(spark, d):
    return M.with_prediction(M.to_long(_wide(spark, d), codes=_codes(spark, d)), THRESHOLD)


def q_hamming(spark, d):
    return M.element_metrics(_long(spark, d))


def q_subset_accuracy(spark, d):
    return M.subset_accuracy(_wide(spark, d), THRESHOLD)


def q_micro_prf(spark, d):
    return M.micro_prf(_long(spark, d))


def q_macro_prf(spark, d):
    return M.macro_prf(_long(spark, d))


def q_label_accuracy(spark, d):
    return M.label_accuracy(_long(spark, d))


def q_label_accuracy_stats(spark, d):
    return M.label_accuracy_stats(_long(spark, d))


def q_roc_auc(spark, d):
    return M.roc_auc_micro(_long(spark, d))


def q_roc_auc_label(spark, d):
    return M.roc_auc_by_label(_long(spark, d))


def q_confusion(spark, d):
    return M.confusion_by_label(_long(spark, d))


def q_roc_points(spark, d):
    return M.roc_points(_long(spark, d))


def q_sparse_micro(spark, d):
    emb = read_table(spark, d, "embeddings")
    truth = emb.select(F.col("vec_id").alias("row_id"), "label")
    pred = _long(spark, d).where(F.col("y_pred") == 1).select("row_id", "label")
    n_rows = emb.select(F.count(F.lit(1))).scalar()
    return M.sparse_micro(truth, pred, n_rows, roles.label_count(spark, d))


def q_evaluation_report(spark, d):
    """All evaluation metrics of the scored rows in one row."""
    long = _long(spark, d)
    el = M.element_metrics(long)
    mi = M.micro_prf(long)
    ma = M.macro_prf(long)
    st = M.label_accuracy_stats(long)
    auc = M.roc_auc_micro(long)
    sub = M.subset_accuracy(_wide(spark, d), THRESHOLD)
    cols = {
        "overall_accuracy": sub.select("subset_accuracy"),
        "element_accuracy": el.select("element_accuracy"),
        "hamming_loss": el.select("hamming_loss"),
        "precision_micro": mi.select("precision_micro"),
        "recall_micro": mi.select("recall_micro"),
        "f1_micro": mi.select("f1_micro"),
        "precision_macro": ma.select("precision_macro"),
        "recall_macro": ma.select("recall_macro"),
        "f1_macro": ma.select("f1_macro"),
        "per_label_accuracy_mean": st.select("per_label_accuracy_mean"),
        "per_label_accuracy_std": st.select("per_label_accuracy_std"),
        "per_label_accuracy_min": st.select("per_label_accuracy_min"),
        "per_label_accuracy_max": st.select("per_label_accuracy_max"),
        "roc_auc_micro": auc.select("roc_auc_micro"),
    }
    return spark.range(1).select(*[df.scalar().alias(k) for k, df in cols.items()])


# -- run table ----------------------------------------------------------------

def q_run_metrics_flat(spark, d):
    return H.flatten_numeric(H.source_quality_reports(spark, d), "run_id", "report", "data_quality")


def q_best_run(spark, d):
    return H.best_runs(H.source_runs(spark, d), "quality_rate", 5)


def q_compare_runs(spark, d):
    runs = H.source_runs(spark, d)
    return H.compare_runs(runs, None, ["records", "mean_chars", "quality_rate", "toxic_rate"], ["top_lang"])


def q_label_metrics(spark, d):
    runs = H.evaluation_run(_long(spark, d), "eval")
    return H.metrics_with_prefix(runs, "accuracy_")


def q_confidence_series(spark, d):
    return H.confidence_series(read_table(spark, d, "events"), "ts", "value")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}
