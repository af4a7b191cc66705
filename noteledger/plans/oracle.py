"""SQL twins of the catalogue queries, in DuckDB's dialect.

They restate each query the direct way (global windows, UNION ALL, scalar
subqueries), so they check the distributed forms of the Spark operators.
Integer widths are cast to Spark's (``size``/``length`` are int,
``count``/``sum`` of ints are bigint), and every double is rounded as in the
Spark query.
"""

from __future__ import annotations

import re

from ..functions.patterns import (
    CODE_REPORT,
    CODE_STRICT,
    SPACE_CLASS,
    STOP_WORDS,
    WORD_CLASS,
)
from .catalog import DATA_LEXICON, DATA_PHRASES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS = SPACE_CLASS
CLEAN_DROP = "[^" + WORD_CLASS + WS + r"\-\.]"
STRIP = "^[" + WS + "]+|[" + WS + "]+$"


def clean_sql(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), {_q(CLEAN_DROP)}, ' ', 'g'), "
            f"{_q('[' + WS + ']+')}, ' ', 'g'))")


def clean_app_sql(x: str) -> str:
    s = f"regexp_replace({x}, {_q(STRIP)}, '', 'g')"
    s = f"regexp_replace({s}, {_q('[' + WS + ']+')}, ' ', 'g')"
    return f"regexp_replace({s}, {_q(CLEAN_DROP)}, ' ', 'g')"


def pieces_sql(x: str) -> str:
    return (f"list_filter(list_transform(string_split(coalesce({x}, ''), '|'), "
            f"lambda p: regexp_replace(p, {_q(STRIP)}, '', 'g')), lambda p: p <> '')")


def valid_sql(x: str) -> str:
    return f"list_filter({pieces_sql(x)}, lambda p: regexp_matches(p, {_q(CODE_STRICT)}))"


REPORT_RE = _q(CODE_REPORT)

RECORDS = """records AS (
  SELECT d.doc_id AS record_id,
         CAST(floor(c.c_acctbal / 100) AS INTEGER) AS age,
         d.lang AS category,
         d.text AS note,
         upper(substr(p.p_type, 1, 1)) || substr(p.p_brand, 7) || '.' || CAST(p.p_size % 10 AS VARCHAR) AS code,
         p.p_size AS stay,
         l.quality,
         l.toxic
  FROM documents d
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN part p ON p.p_partkey = d.doc_id
  LEFT JOIN customer c ON c.c_custkey = d.doc_id)"""

VISITS = """pc AS (SELECT p_partkey, upper(substr(p_type, 1, 1)) || substr(p_brand, 7) AS code FROM part),
sets AS (
  SELECT li.l_orderkey, array_to_string(list_sort(array_agg(DISTINCT pc.code)), '|') AS codes
  FROM lineitem li JOIN pc ON pc.p_partkey = li.l_partkey
  GROUP BY li.l_orderkey),
visits AS (
  SELECT o.o_orderkey AS record_id,
         CAST(floor(c.c_acctbal / 100) AS INTEGER) AS age,
         c.c_mktsegment AS gender,
         s.codes,
         d.text AS note
  FROM orders o
  LEFT JOIN sets s ON s.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey)"""

# Each rule once, as a three-valued column; ``flawless`` is true where all hold.
JUDGED = f"""{RECORDS},
rated AS (
  SELECT *, age BETWEEN 0 AND 120 AS age_ok, stay >= 0 AS stay_ok,
    length(trim(note)) >= 10 AS note_ok, regexp_matches(code, {REPORT_RE}) AS code_ok
  FROM records),
judged AS (SELECT *, coalesce(record_id IS NOT NULL AND age_ok AND stay_ok AND note_ok AND code_ok, false) AS flawless FROM rated)"""


def share(part: str, whole: str) -> str:
    """Percentage with two decimals."""
    return f"round(100.0 * CAST({part} AS DOUBLE) / {whole}, 2)"


SQL: dict[str, str] = {}

# -- reports ----------------------------------------------------------------

SQL["quality_summary"] = f"""WITH {JUDGED},
tally AS (
  SELECT count(*) AS total_records, count(DISTINCT record_id) AS unique_patients, count(DISTINCT code) AS unique_icd10_codes,
    count(record_id) AS valid_patient_ids, count(*) FILTER (age_ok) AS valid_ages, count(*) FILTER (stay_ok) AS valid_length_of_stay,
    count(*) FILTER (note_ok) AS valid_diagnosis_text, count(*) FILTER (code_ok) AS valid_icd10_codes,
    count(*) FILTER (flawless) AS fully_valid_records
  FROM judged)
SELECT 'Data Quality Report' AS report_type, tally.*, {share("fully_valid_records", "total_records")} AS overall_quality_score
FROM tally"""

SQL["report_metadata"] = f"""WITH {JUDGED},
tally AS (
  SELECT count(*) AS total_records_processed, count(DISTINCT record_id) AS unique_patients,
    count(DISTINCT code) AS unique_icd10_codes, count(DISTINCT category) AS unique_genders, count(*) FILTER (flawless) AS good
  FROM judged)
SELECT 'Data Validation Report' AS report_title, tally.* EXCLUDE (good),
  {share("good", "total_records_processed")} AS overall_data_quality_score
FROM tally"""


def _counted(category: str, counts: dict[str, str]) -> str:
    """One pass that counts the rows of each condition, turned into a row per condition."""
    tallies = ", ".join(f"count(*) FILTER ({condition}) AS {name}" for name, condition in counts.items())
    return f"""WITH {JUDGED},
tally AS (SELECT count(*) AS n, {tallies} FROM judged),
tall AS (UNPIVOT tally ON {", ".join(counts)} INTO NAME field_name VALUE invalid_count)
SELECT '{category}' AS metric_category, field_name, invalid_count, {share("invalid_count", "n")} AS error_percentage FROM tall"""


SQL["missing_values"] = _counted("Missing Values", {
    f"{c}": f"judged.{c} IS NULL" for c in ["record_id", "age", "category", "note", "code", "stay", "quality", "toxic"]})
SQL["rule_violations"] = _counted("Data Validation", {
    "invalid_age": "NOT age_ok", "negative_length_of_stay": "NOT stay_ok", "short_diagnosis_text": "NOT note_ok",
    "invalid_icd10_format": "NOT code_ok"})

# Rules in the order in which the first that fails names the issue.
ISSUES = [
    ("Missing patient_id", "record_id IS NULL"), ("Missing age", "age IS NULL"), ("Invalid age", "NOT age_ok"),
    ("Negative length of stay", "NOT stay_ok"), ("Short diagnosis text", "NOT note_ok"), ("Invalid ICD-10 format", "NOT code_ok"),
]
SQL["invalid_records"] = f"""WITH {JUDGED},
issue(ordinal, validation_issue) AS (VALUES {", ".join(f"({i}, {_q(name)})" for i, (name, _) in enumerate(ISSUES, 1))}),
first_issue AS (
  SELECT *, list_position([{", ".join(f"coalesce({test}, false)" for _, test in ISSUES)}], true) AS ordinal FROM judged)
SELECT record_id, age, category, note, code, stay, validation_issue
FROM first_issue JOIN issue USING (ordinal)
ORDER BY validation_issue, record_id"""

SQL["validation_errors"] = f"""WITH {RECORDS},
e AS (
  SELECT record_id, list_filter([
    CASE WHEN note IS NULL OR length(regexp_replace(note, {_q(STRIP)}, '', 'g')) < 10
         THEN 'Clinical notes must be at least 10 characters long' END,
    CASE WHEN age IS NOT NULL AND (age < 0 OR age > 120)
         THEN 'Patient age must be between 0 and 120' END], lambda m: m IS NOT NULL) AS errs
  FROM records)
SELECT record_id, CAST(len(errs) AS INTEGER) AS n_errors, array_to_string(errs, '; ') AS errors FROM e"""


def _grouped(section: str, key: str, name: str, source: str) -> str:
    """Groups by size, with each group's percentage of all rows."""
    return f"""SELECT '{section}' AS report_section, {key} AS {name}, count(*) AS count,
  {share("count(*)", "sum(count(*)) OVER ()")} AS percentage
FROM {source} GROUP BY ALL ORDER BY count DESC, {name}"""


def _bucketed(section: str, value: str, name: str, source: str, buckets: list[tuple[str, str, bool, str]]) -> str:
    """Rows per bucket (name, low, low excluded, high); values that no bucket holds are 'Unknown'."""
    rows = ", ".join(f"({i}, {_q(label)}, {low}::DOUBLE, {str(open_).lower()}, {high}::DOUBLE)" for i, (label, low, open_, high) in enumerate(buckets))
    return f"""WITH bucket(nth, label, low, low_open, high) AS (VALUES {rows}),
measured AS (SELECT {value} AS v FROM {source}),
placed AS (
  SELECT coalesce(nth, {len(buckets)}) AS nth, coalesce(label, 'Unknown') AS label
  FROM measured LEFT JOIN bucket ON v <= high AND (v > low OR v = low AND NOT low_open))
SELECT '{section}' AS report_section, label AS {name}, count(*) AS count, {share("count(*)", "sum(count(*)) OVER ()")} AS percentage
FROM placed GROUP BY nth, label ORDER BY nth"""


NO_LOW, NO_HIGH = "'-infinity'", "'infinity'"

SQL["category_distribution"] = _grouped("Language Distribution", "lang", "lang", "documents")
SQL["prefix_distribution"] = f"WITH {RECORDS}\n" + _grouped("ICD-10 Distribution", "left(code, 3)", "icd10_category", "records")
SQL["age_buckets"] = _bucketed("Age Distribution", "CAST(floor(c_acctbal / 100) AS INTEGER)", "age_group", "customer", [
    ("Under 18", NO_LOW, False, "17"), ("18-30", "18", False, "30"), ("31-50", "31", False, "50"), ("51-70", "51", False, "70"),
    ("Over 70", "70", True, NO_HIGH)])
SQL["stay_buckets"] = _bucketed("Length of Stay Distribution", "p_size", "los_group", "part", [
    ("1 day or less", NO_LOW, False, "1"), ("2-7 days", "2", False, "7"), ("8-14 days", "8", False, "14"), ("15-30 days", "15", False, "30"),
    ("Over 30 days", "30", True, NO_HIGH)])
SQL["severity_buckets"] = _bucketed("Severity Score Distribution", "value / 50", "severity_group", "events", [
    ("Low (1-2)", NO_LOW, False, "2.0"), ("Medium (2.1-5)", "2.1", False, "5.0"), ("High (5.1-8)", "5.1", False, "8.0"),
    ("Critical (>8)", "8.0", True, NO_HIGH)])

_CODES_LONG = f"""codes_long AS (SELECT unnest({pieces_sql('codes')}) AS code FROM visits),
code_counts AS (SELECT code, COUNT(*) AS count FROM codes_long GROUP BY code)"""

SQL["dataset_metadata"] = f"""WITH {VISITS},
{_CODES_LONG},
genders AS (SELECT coalesce(gender, 'NULL') AS g, COUNT(*) AS count FROM visits GROUP BY gender)
SELECT COUNT(*) AS num_records,
  (SELECT COUNT(*) FROM code_counts) AS total_unique_codes,
  CAST(MIN(age) AS VARCHAR) || '-' || CAST(MAX(age) AS VARCHAR) AS age_range,
  (SELECT string_agg(g || ':' || CAST(count AS VARCHAR), ', ' ORDER BY count DESC, g) FROM genders)
    AS gender_distribution,
  (SELECT string_agg(code || ':' || CAST(count AS VARCHAR), ', ' ORDER BY count DESC, code)
     FROM (SELECT * FROM code_counts ORDER BY count DESC, code LIMIT 20)) AS code_distribution,
  coalesce(bool_and(list_bool_and(list_transform({pieces_sql('codes')},
      lambda p: regexp_matches(p, {_q(CODE_STRICT)})))), true) AS all_icd10_valid,
  bool_and(note IS NOT NULL) AS no_null_notes,
  bool_and(coalesce(length(note) > 0, false)) AS no_empty_notes
FROM visits"""

SQL["dataset_metrics"] = f"""WITH {VISITS},
{_CODES_LONG},
genders AS (SELECT gender, COUNT(*) AS count FROM visits GROUP BY gender),
tot AS (SELECT SUM(count) AS n_codes, COUNT(*) AS n_distinct FROM code_counts)
SELECT COUNT(*) AS total_records,
  (SELECT n_distinct FROM tot) AS unique_icd10_codes,
  ROUND(CAST((SELECT n_codes FROM tot) AS DOUBLE) / COUNT(*), 2) AS avg_codes_per_record,
  CASE WHEN coalesce(bool_and(list_bool_and(list_transform({pieces_sql('codes')},
      lambda p: regexp_matches(p, {_q(CODE_STRICT)})))), true) THEN 1.0 ELSE 0.0 END::DOUBLE AS data_quality_score,
  CASE WHEN bool_and(note IS NOT NULL) THEN 1.0 ELSE 0.0 END::DOUBLE AS completeness_score,
  ROUND(AVG(age), 6) AS age_mean,
  ROUND(STDDEV_SAMP(age), 6) AS age_std,
  ROUND((SELECT CAST(MIN(count) AS DOUBLE) / MAX(count) FROM genders), 6) AS gender_balance,
  (SELECT string_agg(code || ':' || CAST(count AS VARCHAR), ', ' ORDER BY count DESC, code)
     FROM (SELECT * FROM code_counts ORDER BY count DESC, code LIMIT 5)) AS top_5_codes,
  ROUND((SELECT CAST(n_distinct AS DOUBLE) / n_codes FROM tot), 6) AS code_diversity
FROM visits"""

SQL["profile"] = f"""WITH {RECORDS}
SELECT MIN(age) AS min_age, MAX(age) AS max_age, COUNT(DISTINCT category) AS n_genders,
  CAST(MIN(length(note)) AS INTEGER) AS min_text_length,
  CAST(MAX(length(note)) AS INTEGER) AS max_text_length,
  (SELECT string_agg(DISTINCT category, ',' ORDER BY category) FROM records WHERE category IS NOT NULL) AS genders
FROM records"""


def _histogram(source: str, expr: str, bins: int, name: str) -> str:
    return f"""WITH v AS (SELECT CAST({expr} AS DOUBLE) AS x FROM {source}),
mm AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM v WHERE x IS NOT NULL),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0
                ELSE least(floor((x - lo) * {float(bins)} / (hi - lo)), {bins - 1}) END AS INTEGER) AS bin
      FROM v, mm WHERE x IS NOT NULL),
c AS (SELECT bin, COUNT(*) AS count FROM b GROUP BY bin),
e AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
SELECT '{name}' AS variable, e.bin,
  ROUND(lo + e.bin * (hi - lo) / {float(bins)}, 6) AS bin_start,
  ROUND(lo + (e.bin + 1) * (hi - lo) / {float(bins)}, 6) AS bin_end,
  coalesce(c.count, 0) AS count
FROM e CROSS JOIN mm LEFT JOIN c ON c.bin = e.bin
WHERE lo IS NOT NULL
ORDER BY e.bin"""


SQL["histogram_value"] = _histogram("events", "value", 20, "value")
SQL["histogram_codes"] = f"WITH {VISITS},\n" + _histogram(
    "visits", f"len({pieces_sql('codes')})", 10, "codes_per_record")[5:]

SQL["top_codes"] = f"""WITH {VISITS},
{_CODES_LONG}
SELECT code, count FROM code_counts ORDER BY count DESC, code LIMIT 10"""

SQL["codes_per_record"] = f"""WITH {VISITS}
SELECT CAST(len({pieces_sql('codes')}) AS INTEGER) AS n_codes, COUNT(*) AS records
FROM visits GROUP BY 1 ORDER BY 1"""

# -- text -------------------------------------------------------------------

SQL["clean_text"] = f"""SELECT doc_id, {clean_sql('text')} AS cleaned,
  CAST(length({clean_sql('text')}) AS INTEGER) AS note_length
FROM documents"""

SQL["clean_text_app"] = f"SELECT doc_id, {clean_app_sql('text')} AS cleaned_app FROM documents"


def _in_list(words: list[str]) -> str:
    return "(" + ", ".join(_q(w) for w in words) + ")"


_runs = f"string_split_regex({clean_sql('text')}, {_q('[^' + WORD_CLASS + ']+')})"
SQL["lexicon_counts"] = "WITH r AS (SELECT doc_id, " + _runs + " AS runs FROM documents)\nSELECT doc_id, " + ",\n  ".join(
    f"CAST(len(list_filter(runs, lambda x: x IN {_in_list(w)})) AS INTEGER) AS {k}_count, "
    f"CAST(len(list_filter(runs, lambda x: x IN {_in_list(w)})) > 0 AS INTEGER) AS {k}_present"
    for k, w in DATA_LEXICON.items()) + "\nFROM r"

SQL["lexicon_presence"] = (
    f"WITH c AS (SELECT doc_id, lower(coalesce({clean_app_sql('text')}, '')) AS low FROM documents)\nSELECT doc_id, "
    + ",\n  ".join(
        "(" + " + ".join(f"CAST(contains(low, {_q(w)}) AS INTEGER)" for w in dict.fromkeys(words)) + ")"
        + f" AS {k.replace('_words', '_present')}"
        for k, words in DATA_LEXICON.items())
    + "\nFROM c")


def _entities_sql(phrases: list[str]) -> str:
    """Phrases whose tokens occur in a row among the text's word and separator tokens.

    The text is cut at every border between a word and other characters, so a
    phrase is found where its own tokens stand one after the other. Of phrases
    that fit at one place the first listed counts, and the scan goes on after it.
    """
    alternatives = "|".join(_regex(p) for p in phrases)
    # RE2 has no look-around: mark each border (a zero-width place) with a control character, and match whole marked tokens
    marked = f"regexp_replace(lower(coalesce(text, '')), {_q('([' + WORD_CLASS + ']+)')}, chr(1) || '\\1' || chr(2), 'g')"
    found = f"regexp_extract_all({marked}, {_q('(' + alternatives + ')')})"
    return f"array_to_string(list_sort(list_distinct([translate(x, chr(1) || chr(2), '') for x in {found}])), ', ')"


def _regex(phrase: str) -> str:
    """The phrase with border marks around each word."""
    return "".join(f"\x01{part}\x02" if re.match(r"\w", part) else re.escape(part) for part in re.findall(r"\w+|\W+", phrase))


SQL["entities"] = "SELECT doc_id, " + ",\n  ".join(
    f"{_entities_sql(p)} AS {k}" for k, p in DATA_PHRASES.items()) + "\nFROM documents"

_words = f"list_filter(string_split_regex(coalesce(text, ''), {_q('[' + WS + ']+')}), lambda x: x <> '')"
_sent = f"list_filter(string_split(coalesce(text, ''), '.'), lambda s: regexp_matches(s, {_q('[^' + WS + ']')}))"
SQL["text_metrics"] = f"""WITH m AS (SELECT doc_id, text, {_words} AS w, {_sent} AS s FROM documents)
SELECT doc_id,
  CAST(len(w) AS INTEGER) AS word_count,
  CAST(len(s) AS INTEGER) AS sentence_count,
  ROUND(CAST(len(w) AS DOUBLE) / NULLIF(len(s), 0), 6) AS avg_sentence_length,
  CAST(len(list_distinct(w)) AS INTEGER) AS unique_words,
  CAST(length(text) AS INTEGER) AS text_length
FROM m"""

SQL["preview"] = """SELECT doc_id,
  CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS preview
FROM documents"""

# -- codes and labels -------------------------------------------------------

SQL["code_parse"] = f"""WITH {VISITS}
SELECT record_id,
  CAST(len({pieces_sql('codes')}) AS INTEGER) AS n_pieces,
  CAST(len({valid_sql('codes')}) AS INTEGER) AS n_valid,
  array_to_string({valid_sql('codes')}, '|') AS valid_codes
FROM visits"""

_DICT = f"""dict AS (
  SELECT code, row_number() OVER (ORDER BY code) - 1 AS code_index
  FROM (SELECT DISTINCT unnest({valid_sql('codes')}) AS code FROM visits))"""

SQL["code_dictionary"] = f"WITH {VISITS},\n{_DICT}\nSELECT code, code_index FROM dict"

SQL["code_dictionary_raw"] = f"""WITH {VISITS},
raw AS (SELECT DISTINCT unnest(list_filter(string_split(codes, '|'), lambda x: x IS NOT NULL AND x <> '')) AS code
        FROM visits)
SELECT code, row_number() OVER (ORDER BY code) - 1 AS code_index FROM raw"""

SQL["one_hot"] = f"""WITH {VISITS},
{_DICT},
arr AS (SELECT list(code ORDER BY code_index) AS a FROM dict),
oh AS (SELECT record_id, list_transform(arr.a, lambda c: CAST(list_contains({valid_sql('codes')}, c) AS INTEGER)) AS l
       FROM visits, arr)
SELECT record_id, CAST(list_sum(l) AS INTEGER) AS n_labels,
  array_to_string(list_transform(l, lambda x: CAST(x AS VARCHAR)), '') AS one_hot
FROM oh"""

SQL["label_pairs"] = f"""WITH {VISITS},
{_DICT},
e AS (SELECT record_id, unnest(list_distinct({valid_sql('codes')})) AS code FROM visits)
SELECT e.record_id, e.code, dict.code_index FROM e JOIN dict ON dict.code = e.code"""

SQL["label_union"] = f"""WITH {VISITS}
SELECT DISTINCT unnest({valid_sql('codes')}) AS code FROM visits ORDER BY code"""

# -- vectorizing ------------------------------------------------------------

_STOP = _in_list(STOP_WORDS)
_TOK = f"""tok0 AS (SELECT doc_id, string_split_regex(lower({clean_sql('text')}), '\\s') AS tokens FROM documents),
tok AS (SELECT doc_id, tokens, list_filter(tokens, lambda x: x NOT IN {_STOP}) AS filtered FROM tok0)"""

SQL["tokens_filtered"] = f"""WITH {_TOK}
SELECT doc_id, array_to_string(tokens, '|') AS tokens, array_to_string(filtered, '|') AS filtered,
  CAST(len(tokens) AS INTEGER) AS n_tokens, CAST(len(filtered) AS INTEGER) AS n_filtered
FROM tok"""

_VOCAB = f"""{_TOK},
n AS (SELECT COUNT(*) AS n FROM tok),
tc AS (SELECT term, COUNT(*) AS total_count FROM (SELECT unnest(filtered) AS term FROM tok) GROUP BY term),
dfc AS (SELECT term, COUNT(*) AS df FROM (SELECT unnest(list_distinct(filtered)) AS term FROM tok) GROUP BY term),
ranked AS (
  SELECT tc.term, dfc.df, tc.total_count,
         row_number() OVER (ORDER BY tc.total_count DESC, tc.term) - 1 AS term_index
  FROM tc JOIN dfc ON dfc.term = tc.term WHERE dfc.df >= 2),
vocab AS (SELECT ranked.*, ln((CAST(n.n AS DOUBLE) + 1) / (CAST(df AS DOUBLE) + 1)) AS idf
          FROM ranked, n WHERE term_index < 1000)"""

SQL["term_df_idf"] = f"""WITH {_VOCAB}
SELECT term, term_index, df, total_count, ROUND(idf, 6) AS idf FROM vocab"""

SQL["tfidf_long"] = f"""WITH {_VOCAB},
tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM (SELECT doc_id, unnest(filtered) AS term FROM tok) GROUP BY doc_id, term)
SELECT tf.doc_id, tf.term, vocab.term_index, tf.tf, ROUND(tf.tf * vocab.idf, 6) AS tfidf
FROM tf JOIN vocab ON vocab.term = tf.term"""

# -- split, sample, folds ---------------------------------------------------


def _hash(col: str) -> str:
    return f"md5('42:' || CAST({col} AS VARCHAR))"


def _split_case(src: str, key: str) -> str:
    return f"""r AS (SELECT *, row_number() OVER (ORDER BY {_hash(key)}, {key}) AS rk FROM {src}),
c AS (SELECT COUNT(*) AS n, CAST(ceil(CAST(0.3 AS DOUBLE) * COUNT(*)) AS BIGINT) AS n_rest FROM {src}),
c2 AS (SELECT n, n - n_rest AS n_train, n_rest - CAST(ceil(CAST(0.5 AS DOUBLE) * n_rest) AS BIGINT) AS n_val FROM c),
s AS (SELECT r.*, CASE WHEN rk <= n_train THEN 'train' WHEN rk <= n_train + n_val THEN 'validation'
                       ELSE 'test' END AS split FROM r, c2)"""


SQL["split_assign"] = f"WITH {_split_case('documents', 'doc_id')}\nSELECT doc_id, split FROM s"

SQL["split_stats"] = f"""WITH {VISITS},
{_split_case('visits', 'record_id')},
per AS (SELECT split, COUNT(*) AS records, AVG(age) AS a, AVG(length(note)) AS nl, SUM(len({pieces_sql('codes')})) AS nc FROM s GROUP BY split),
sexes AS (SELECT split, coalesce(gender, 'NULL') AS g, count(*) AS c FROM s GROUP BY ALL),
told AS (SELECT split, string_agg(g || ':' || c, ', ' ORDER BY c DESC, g) AS gender_distribution FROM sexes GROUP BY split),
dc AS (SELECT split, COUNT(DISTINCT code) AS unique_codes
       FROM (SELECT split, unnest({pieces_sql('codes')}) AS code FROM s) GROUP BY split)
SELECT per.split, records,
  ROUND(CAST(records AS DOUBLE) / (SELECT SUM(records) FROM per), 6) AS ratio,
  ROUND(a, 6) AS mean_age, ROUND(nl, 6) AS mean_note_length, gender_distribution,
  coalesce(dc.unique_codes, 0) AS unique_codes,
  ROUND(CAST(nc AS DOUBLE) / records, 6) AS codes_per_record
FROM per LEFT JOIN dc ON dc.split = per.split LEFT JOIN told ON told.split = per.split
ORDER BY per.split"""

SQL["sample_500"] = f"SELECT doc_id FROM documents ORDER BY {_hash('doc_id')}, doc_id LIMIT 500"

SQL["kfold"] = f"""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {_hash('doc_id')}, doc_id) - 1 AS r0 FROM documents),
c AS (SELECT COUNT(*) // 5 AS q, COUNT(*) % 5 AS rem FROM documents)
SELECT doc_id, CAST(CASE WHEN r0 < rem * (q + 1) THEN r0 // (q + 1)
                        ELSE rem + (r0 - rem * (q + 1)) // q END AS INTEGER) AS fold
FROM r, c"""

SQL["strat_fold"] = f"""WITH {VISITS},
v AS (SELECT record_id, CAST(len({valid_sql('codes')}) AS INTEGER) AS n_labels FROM visits)
SELECT record_id, n_labels,
  CAST((row_number() OVER (PARTITION BY n_labels ORDER BY {_hash('record_id')}, record_id) - 1) % 5 AS INTEGER)
    AS fold
FROM v"""

# -- scoring ----------------------------------------------------------------

LONG = f"""long AS (
  SELECT e.vec_id AS row_id, CAST(t.k AS INTEGER) AS label,
         chr(CAST(65 + t.k % 26 AS INTEGER)) || printf('%02d', t.k) AS code,
         ROUND(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(CAST(-8 AS DOUBLE) * CAST(e.embedding[t.k + 1] AS DOUBLE))), 6)
           AS score,
         CAST(e.label = t.k AS INTEGER) AS y_true
  FROM embeddings e, (SELECT unnest(range((SELECT max(label) + 1 FROM embeddings))) AS k) t),
lp AS (SELECT *, CAST(score > 0.5 AS INTEGER) AS y_pred FROM long)"""

_TOP3 = """top3 AS (
  SELECT row_id, CAST(rk AS INTEGER) AS rank, label, code, score, score >= 0.5 AS above_threshold
  FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, label) AS rk FROM long)
  WHERE rk <= 3)"""

SQL["top3_per_row"] = f"WITH {LONG},\n{_TOP3}\nSELECT * FROM top3"

_BATCH = f"""batch AS (
  SELECT row_id AS patient_id,
    arg_min(code, rank) AS top_prediction,
    arg_min(score, rank) AS confidence,
    string_agg(printf('%s(%.3f)', code, ROUND(score, 3)), '; ' ORDER BY rank) AS all_predictions,
    'Success' AS status
  FROM top3 GROUP BY row_id)"""

SQL["batch_scores"] = f"WITH {LONG},\n{_TOP3},\n{_BATCH}\nSELECT * FROM batch"

SQL["packaged_pred"] = f"""WITH {LONG}
SELECT row_id,
  coalesce(string_agg(code, '|' ORDER BY label) FILTER (WHERE score > 0.5), '') AS predicted_codes,
  CAST(COUNT(*) FILTER (WHERE score > 0.5) AS INTEGER) AS n_predicted,
  coalesce(string_agg(code || ':' || printf('%.6f', score), ',' ORDER BY label) FILTER (WHERE score > 0.5), '')
    AS probabilities,
  coalesce(ROUND(AVG(score) FILTER (WHERE score > 0.5), 6), 0.0) AS confidence
FROM long GROUP BY row_id"""

SQL["confidence_levels"] = f"""WITH {LONG},
{_TOP3}
SELECT row_id, rank, code, score,
  CASE WHEN score >= 0.8 THEN 'High' WHEN score >= 0.6 THEN 'Medium' ELSE 'Low' END AS confidence_level,
  printf('%.1f%%', ROUND(score * 100.0, 1)) AS confidence_percent
FROM top3"""

SQL["batch_summary"] = f"""WITH {LONG},
{_TOP3},
{_BATCH}
SELECT COUNT(*) AS total_records,
  COUNT(*) FILTER (WHERE status = 'Success') AS successful,
  COUNT(*) FILTER (WHERE status = 'Error') AS errors,
  coalesce(ROUND(CAST(COUNT(*) FILTER (WHERE status = 'Success') AS DOUBLE) * 100.0 / COUNT(*), 2), 0.0)
    AS success_rate
FROM batch"""

SQL["top_predictions"] = f"""WITH {LONG},
{_TOP3},
{_BATCH}
SELECT top_prediction AS code, COUNT(*) AS count FROM batch WHERE status = 'Success'
GROUP BY 1 ORDER BY count DESC, code LIMIT 10"""

SQL["category_counts"] = f"""WITH {LONG},
{_TOP3}
SELECT substr(code, 1, 1) AS category, COUNT(*) AS count FROM top3 GROUP BY 1 ORDER BY count DESC, category"""

# -- metrics ----------------------------------------------------------------


def _safe(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / ({den}) END"


_CONF = """CAST(COUNT(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS BIGINT) AS tp,
  CAST(COUNT(*) FILTER (WHERE y_true = 0 AND y_pred = 1) AS BIGINT) AS fp,
  CAST(COUNT(*) FILTER (WHERE y_true = 1 AND y_pred = 0) AS BIGINT) AS fn,
  CAST(COUNT(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS BIGINT) AS tn"""

SQL["hamming"] = f"""WITH {LONG}
SELECT ROUND(AVG(CAST(y_true = y_pred AS DOUBLE)), 6) AS element_accuracy,
  ROUND(1 - AVG(CAST(y_true = y_pred AS DOUBLE)), 6) AS hamming_loss
FROM lp"""

SQL["subset_accuracy"] = f"""WITH {LONG},
r AS (SELECT row_id, bool_and(y_true = y_pred) AS ok FROM lp GROUP BY row_id)
SELECT ROUND(AVG(CAST(ok AS DOUBLE)), 6) AS subset_accuracy, COUNT(*) AS rows FROM r"""


def _prf_select(src: str, suffix: str) -> str:
    p = _safe("tp", "tp + fp")
    r = _safe("tp", "tp + fn")
    return f"""SELECT tp, fp, fn, tn,
  ROUND({p}, 6) AS precision{suffix},
  ROUND({r}, 6) AS recall{suffix},
  ROUND(CASE WHEN ({p}) + ({r}) = 0 THEN 0.0 ELSE 2.0 * ({p}) * ({r}) / (({p}) + ({r})) END, 6) AS f1{suffix}
FROM {src}"""


SQL["micro_prf"] = f"""WITH {LONG},
c AS (SELECT {_CONF} FROM lp)
{_prf_select('c', '_micro')}"""

SQL["macro_prf"] = f"""WITH {LONG},
c AS (SELECT label, {_CONF} FROM lp GROUP BY label),
m AS (SELECT {_safe('tp', 'tp + fp')} AS p, {_safe('tp', 'tp + fn')} AS r FROM c)
SELECT ROUND(AVG(p), 6) AS precision_macro, ROUND(AVG(r), 6) AS recall_macro,
  ROUND(AVG(CASE WHEN p + r = 0 THEN 0.0 ELSE 2.0 * p * r / (p + r) END), 6) AS f1_macro,
  COUNT(*) AS labels
FROM m"""

SQL["label_accuracy"] = f"""WITH {LONG}
SELECT 'accuracy_' || code AS metric_key, code, ROUND(AVG(CAST(y_true = y_pred AS DOUBLE)), 6) AS accuracy,
  CAST(SUM(y_true) AS BIGINT) AS positives
FROM lp GROUP BY code HAVING SUM(y_true) > 0 ORDER BY code"""

SQL["label_accuracy_stats"] = f"""WITH {LONG},
a AS (SELECT label, AVG(CAST(y_true = y_pred AS DOUBLE)) AS acc FROM lp GROUP BY label)
SELECT ROUND(AVG(acc), 6) AS per_label_accuracy_mean, ROUND(STDDEV_POP(acc), 6) AS per_label_accuracy_std,
  ROUND(MIN(acc), 6) AS per_label_accuracy_min, ROUND(MAX(acc), 6) AS per_label_accuracy_max
FROM a"""

SQL["roc_auc"] = f"""WITH {LONG},
sc AS (SELECT score, SUM(y_true) AS pos, SUM(1 - y_true) AS neg FROM long GROUP BY score),
cum AS (SELECT *, coalesce(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS below FROM sc)
SELECT ROUND(SUM(pos * (below + 0.5 * neg)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)), 6) AS roc_auc_micro,
  CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives
FROM cum"""

SQL["roc_auc_label"] = f"""WITH {LONG},
sc AS (SELECT label, score, SUM(y_true) AS pos, SUM(1 - y_true) AS neg FROM long GROUP BY label, score),
cum AS (SELECT *, coalesce(SUM(neg) OVER (PARTITION BY label ORDER BY score
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM sc)
SELECT label, ROUND(SUM(pos * (below + 0.5 * neg)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)), 6) AS roc_auc
FROM cum GROUP BY label"""

SQL["confusion"] = f"""WITH {LONG}
SELECT label, {_CONF} FROM lp GROUP BY label ORDER BY label"""

SQL["roc_points"] = f"""WITH {LONG},
sc AS (SELECT label, score, SUM(y_true) AS pos, SUM(1 - y_true) AS neg FROM long GROUP BY label, score),
tot AS (SELECT label, SUM(pos) AS P, SUM(neg) AS N FROM sc GROUP BY label),
cum AS (SELECT label, score,
          SUM(pos) OVER (PARTITION BY label ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
          SUM(neg) OVER (PARTITION BY label ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp
        FROM sc)
SELECT cum.label, score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  ROUND(CAST(tp AS DOUBLE) / P, 6) AS tpr, ROUND(CAST(fp AS DOUBLE) / N, 6) AS fpr
FROM cum JOIN tot ON tot.label = cum.label"""

SQL["sparse_micro"] = f"""WITH {LONG},
truth AS (SELECT DISTINCT vec_id AS row_id, label FROM embeddings),
pred AS (SELECT DISTINCT row_id, label FROM lp WHERE y_pred = 1),
k AS (SELECT (SELECT COUNT(*) FROM truth JOIN pred USING (row_id, label)) AS tp,
             (SELECT COUNT(*) FROM truth) AS nt, (SELECT COUNT(*) FROM pred) AS np,
             (SELECT COUNT(*) FROM embeddings) AS nr),
c AS (SELECT tp, np - tp AS fp, nt - tp AS fn, nr * (SELECT max(label) + 1 FROM embeddings) - tp - (np - tp) - (nt - tp) AS tn FROM k)
{_prf_select('c', '_micro')}"""

# -- run table --------------------------------------------------------------

_SRC = """j AS (SELECT d.source, d.lang, d.n_chars, d.text, l.quality, l.toxic
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

_FLAT = [
    ("total_records", "COUNT(*)"),
    ("valid_texts", "COUNT(*) FILTER (WHERE length(trim(text)) >= 10)"),
    ("text_chars_min", "MIN(n_chars)"),
    ("text_chars_max", "MAX(n_chars)"),
    ("label_counts_quality", "COUNT(*) FILTER (WHERE quality = 1)"),
    ("label_counts_toxic", "COUNT(*) FILTER (WHERE toxic = 1)"),
    ("label_counts_labelled", "COUNT(quality)"),
]
SQL["run_metrics_flat"] = f"WITH {_SRC}\n" + "\nUNION ALL\n".join(
    f"""SELECT source AS run_id, 'metric' AS kind, 'data_quality_{k}' AS key, CAST(NULL AS VARCHAR) AS value,
  ROUND(CAST({e} AS DOUBLE), 6) AS num FROM j GROUP BY source""" for k, e in _FLAT)

_PER = f"""{_SRC},
per AS (SELECT source AS run_id,
          CAST(COUNT(*) AS DOUBLE) AS records,
          ROUND(AVG(n_chars), 6) AS mean_chars,
          ROUND(AVG(CAST(quality IS NOT NULL AS DOUBLE)), 6) AS labelled_share,
          ROUND(AVG(quality), 6) AS quality_rate,
          ROUND(AVG(toxic), 6) AS toxic_rate
        FROM j GROUP BY source)"""

SQL["best_run"] = f"""WITH {_PER}
SELECT run_id, 'quality_rate' AS metric, ROUND(quality_rate, 6) AS value
FROM per WHERE quality_rate IS NOT NULL ORDER BY quality_rate DESC, run_id LIMIT 5"""

SQL["compare_runs"] = f"""WITH {_PER}
SELECT run_id, ROUND(records, 6) AS records, ROUND(mean_chars, 6) AS mean_chars,
  ROUND(quality_rate, 6) AS quality_rate, ROUND(toxic_rate, 6) AS toxic_rate, top_lang
FROM per JOIN (
  SELECT source AS run_id, lang AS top_lang FROM documents GROUP BY source, lang
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) = 1) USING (run_id)
ORDER BY run_id"""

SQL["label_metrics"] = f"""WITH {LONG}
SELECT 'eval' AS run_id, 'accuracy_' || code AS key, ROUND(AVG(CAST(y_true = y_pred AS DOUBLE)), 6) AS num
FROM lp GROUP BY code HAVING SUM(y_true) > 0 ORDER BY key"""

SQL["confidence_series"] = """SELECT CAST(ts AS DATE) AS day, ROUND(AVG(value), 6) AS avg_confidence, COUNT(*) AS n
FROM events GROUP BY 1 ORDER BY 1"""

# -- documents and runs (composite reports) ---------------------------------

_FM_KEYS = sorted([f"{k}_{s}" for k in DATA_LEXICON for s in ("count", "present")])


def _fm_expr(key: str) -> str:
    group, kind = key.rsplit("_", 1)
    n = f"len(list_filter(runs, lambda x: x IN {_in_list(DATA_LEXICON[group])}))"
    return f"CAST({n} AS INTEGER)" if kind == "count" else f"CAST({n} > 0 AS INTEGER)"


SQL["feature_map"] = (
    "WITH r AS (SELECT doc_id, " + _runs + " AS runs FROM documents)\nSELECT doc_id, "
    + " || ',' || ".join(f"'{k}:' || CAST({_fm_expr(k)} AS VARCHAR)" for k in _FM_KEYS) + " AS feature_map,\n  "
    + ",\n  ".join(f"{_fm_expr(k + '_count')} AS {k}_count" for k in DATA_LEXICON)
    + "\nFROM r")


def _block(app: bool) -> str:
    """CTE ``block``: the engineered columns per document."""
    if app:
        clean = clean_app_sql("text")
        counts = [" + ".join(f"CAST(contains(lower(c), {_q(w)}) AS INTEGER)" for w in dict.fromkeys(words)) for words in DATA_LEXICON.values()]
        age, length = "(floor(c_acctbal / 100) - 50) / 20", "(length(c) - 200) / 100"
    else:
        clean = clean_sql("text")
        runs = f"string_split_regex(c, {_q('[^' + WORD_CLASS + ']+')})"
        counts = [f"len(list_filter({runs}, lambda x: x IN {_in_list(words)}))" for words in DATA_LEXICON.values()]
        age, length = "floor(c_acctbal / 100)", "length(c)"
    names = ["symptoms_count", "body_parts_count", "severity_count", "medical_terms_count"]
    return f"""cleaned AS (SELECT doc_id, lang, coalesce({clean}, '') AS c FROM documents),
block AS (
  SELECT doc_id, coalesce(CAST({age} AS DOUBLE), 0.0::DOUBLE) AS age_value, CAST({length} AS DOUBLE) AS note_length,
    {", ".join(f"CAST({c} AS DOUBLE) AS {n}" for c, n in zip(counts, names))},
    coalesce(CAST(lang = 'en' AS DOUBLE), 0.0::DOUBLE) AS gender_m
  FROM cleaned LEFT JOIN customer ON c_custkey = doc_id)"""


SQL["engineered_train"] = f"WITH {_block(False)}\nSELECT * FROM block"
SQL["engineered_app"] = f"WITH {_block(True)}\nSELECT * FROM block"
SQL["ensemble_join"] = f"""WITH {_block(False)}
SELECT vec_id AS doc_id, label, CAST(len(embedding) AS INTEGER) AS dense_width, round(CAST(embedding[1] AS DOUBLE), 6) AS dense_first,
  {", ".join(f"coalesce(block.{n}, 0.0::DOUBLE) AS {n}" for n in ["age_value", "note_length", "symptoms_count", "body_parts_count", "severity_count", "medical_terms_count", "gender_m"])}
FROM embeddings LEFT JOIN block ON block.doc_id = vec_id"""

SQL["preprocess_metrics"] = f"""WITH {_VOCAB}
SELECT (SELECT COUNT(*) FROM documents) AS input_records,
  (SELECT COUNT(*) FROM tok) AS output_records,
  (SELECT COUNT(DISTINCT upper(left(lang, 1)) || printf('%02d', n_chars % 100)) FROM documents) AS unique_icd10_codes,
  CAST((SELECT COUNT(*) FROM vocab) AS INTEGER) AS vocabulary_size,
  2 AS min_document_frequency,
  12 AS feature_count"""

SQL["batch_errors"] = """WITH b AS (
  SELECT count(*) AS total_records, count(*) FILTER (length(text) > 0) AS successful
  FROM orders LEFT JOIN documents ON doc_id = o_orderkey)
SELECT total_records, successful, total_records - successful AS errors,
  coalesce(round(100.0 * CAST(successful AS DOUBLE) / nullif(total_records, 0), 2), 0.0) AS success_rate
FROM b"""

SQL["split_metrics"] = f"""WITH {_split_case('documents', 'doc_id')},
cnt AS (SELECT COUNT(*) AS total_records,
        COUNT(*) FILTER (WHERE split = 'train') AS train_records,
        COUNT(*) FILTER (WHERE split = 'validation') AS validation_records,
        COUNT(*) FILTER (WHERE split = 'test') AS test_records FROM s)
SELECT *, ROUND(train_records / total_records, 6) AS train_ratio,
  ROUND(validation_records / total_records, 6) AS validation_ratio,
  ROUND(test_records / total_records, 6) AS test_ratio
FROM cnt"""


def _sub(name: str, col: str) -> str:
    return f"(SELECT {col} FROM ({SQL[name]}))"


SQL["evaluation_report"] = "SELECT " + ",\n  ".join(
    f"{_sub(q, c)} AS {a}" for q, c, a in [
        ("subset_accuracy", "subset_accuracy", "overall_accuracy"),
        ("hamming", "element_accuracy", "element_accuracy"),
        ("hamming", "hamming_loss", "hamming_loss"),
        ("micro_prf", "precision_micro", "precision_micro"),
        ("micro_prf", "recall_micro", "recall_micro"),
        ("micro_prf", "f1_micro", "f1_micro"),
        ("macro_prf", "precision_macro", "precision_macro"),
        ("macro_prf", "recall_macro", "recall_macro"),
        ("macro_prf", "f1_macro", "f1_macro"),
        ("label_accuracy_stats", "per_label_accuracy_mean", "per_label_accuracy_mean"),
        ("label_accuracy_stats", "per_label_accuracy_std", "per_label_accuracy_std"),
        ("label_accuracy_stats", "per_label_accuracy_min", "per_label_accuracy_min"),
        ("label_accuracy_stats", "per_label_accuracy_max", "per_label_accuracy_max"),
        ("roc_auc", "roc_auc_micro", "roc_auc_micro"),
    ])
