"""The cleaners, rules and reports as SQL functions of the session.

``register_functions`` defines scalar functions, ``register_reports`` table
functions over a registered view, so that the reports run as SQL::

    register_view(records, "records")
    register_reports(spark, "records", columns)
    spark.sql("SELECT * FROM report_quality()")

All are SQL-defined: Catalyst puts their bodies in place of the calls, so they
are planned as if they had been written out. They are temporary, and defining
them again replaces them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.patterns import (
    AGE_BUCKETS,
    CLEAN_DROP,
    CLEAN_GAP,
    CODE_REPORT,
    CODE_STRICT,
    MSG_BAD_AGE,
    MSG_SHORT_TEXT,
    SEVERITY_BUCKETS,
    SPACE_CLASS,
    SPACE_RUN,
    STAY_BUCKETS,
)
from ..functions.rules import RecordColumns


def _text(s: str) -> str:
    """A string literal without escapes."""
    if "'" in s:
        raise ValueError(f"no literal for {s!r}")
    return f"r'{s}'"


def _cases(tests: list[str], names: list[str]) -> str:
    """The first name whose test is true; the last name if none is."""
    whens = " ".join(f"WHEN {t} THEN {_text(n)}" for t, n in zip(tests, names, strict=False))
    return f"CASE {whens} ELSE {_text(names[len(tests)])} END"


STRIP = f"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$"

#: name: (parameters, type, body)
FUNCTIONS = {
    "clean_note": ("t STRING", "STRING", f"trim(regexp_replace(lower(coalesce(t, '')), {_text(CLEAN_GAP)}, ' '))"),
    "clean_note_app": ("t STRING", "STRING", f"regexp_replace(regexp_replace(regexp_replace(t, {_text(STRIP)}, ''), {_text(SPACE_RUN)}, ' '), {_text(CLEAN_DROP)}, ' ')"),
    "note_preview": ("t STRING", "STRING", "CASE WHEN length(t) > 100 THEN concat(substring(t, 1, 100), '...') ELSE t END"),
    "is_code": ("c STRING", "BOOLEAN", f"c RLIKE {_text(CODE_STRICT)}"),
    "is_report_code": ("c STRING", "BOOLEAN", f"c RLIKE {_text(CODE_REPORT)}"),
    "parse_codes": ("s STRING", "ARRAY<STRING>", f"filter(transform(split(coalesce(s, ''), '[|]'), p -> regexp_replace(p, {_text(STRIP)}, '')), p -> p RLIKE {_text(CODE_STRICT)})"),
    "age_group": ("a INT", "STRING", _cases(["a < 18", "a BETWEEN 18 AND 30", "a BETWEEN 31 AND 50", "a BETWEEN 51 AND 70", "a > 70"], AGE_BUCKETS)),
    "stay_group": ("s INT", "STRING", _cases(["s <= 1", "s BETWEEN 2 AND 7", "s BETWEEN 8 AND 14", "s BETWEEN 15 AND 30", "s > 30"], STAY_BUCKETS)),
    "severity_group": ("x DOUBLE", "STRING", _cases(["x <= 2.0D", "x BETWEEN 2.1D AND 5.0D", "x BETWEEN 5.1D AND 8.0D", "x > 8.0D"], SEVERITY_BUCKETS)),
    "validation_issue": (
        "id STRING, age INT, text_length INT, code STRING, stay INT", "STRING",
        "CASE WHEN id IS NULL THEN 'Missing patient_id' WHEN age IS NULL THEN 'Missing age' WHEN age < 0 OR age > 120 THEN 'Invalid age' "
        "WHEN stay < 0 THEN 'Negative length of stay' WHEN text_length < 10 THEN 'Short diagnosis text' "
        f"WHEN NOT code RLIKE {_text(CODE_REPORT)} THEN 'Invalid ICD-10 format' ELSE 'Valid' END"),
    "fully_valid": (
        "id STRING, age INT, text_length INT, code STRING, stay INT", "BOOLEAN",
        f"coalesce(id IS NOT NULL AND age BETWEEN 0 AND 120 AND stay >= 0 AND text_length >= 10 AND code RLIKE {_text(CODE_REPORT)}, false)"),
    "input_errors": (
        "stripped_length INT, age INT", "ARRAY<STRING>",
        f"filter(array(CASE WHEN stripped_length IS NULL OR stripped_length < 10 THEN {_text(MSG_SHORT_TEXT)} END, "
        f"CASE WHEN age < 0 OR age > 120 THEN {_text(MSG_BAD_AGE)} END), m -> m IS NOT NULL)"),
    "percent_of": ("part BIGINT, total BIGINT", "DOUBLE", "round(try_divide(CAST(part AS DOUBLE) * 100.0D, CAST(total AS DOUBLE)), 2)"),
}


def register_functions(spark: SparkSession) -> list[str]:
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(FUNCTIONS)


def report_queries(view: str, cols: RecordColumns = RecordColumns()) -> dict[str, tuple[str, str]]:
    """Table function name: (columns, query) of the reports on ``view``."""
    length = f"`{cols.text_length}`" if cols.text_length else f"length(trim(`{cols.text}`))"
    record = f"CAST(`{cols.id}` AS STRING), try_cast(`{cols.age}` AS INT), {length}, `{cols.code}`, try_cast(`{cols.stay}` AS INT)"
    judged = (f"SELECT `{cols.id}` AS id, `{cols.age}` AS age, `{cols.gender}` AS gender, `{cols.code}` AS code, `{cols.stay}` AS stay, {length} AS text_length, "
              f"fully_valid({record}) AS valid, validation_issue({record}) AS issue FROM {view}")

    def grouped(column: str, key: str, name: str, section: str) -> tuple[str, str]:
        return (f"report_section STRING, {name} STRING, count BIGINT, percentage DOUBLE",
                f"SELECT '{section}', {name}, count, percent_of(count, (SELECT count(*) FROM {view})) FROM (SELECT {key} AS {name}, count(*) AS count FROM {view} GROUP BY 1)")

    def counted(category: str, tests: dict[str, str]) -> tuple[str, str]:
        tallies = ", ".join(f"count_if({t}) AS `{n}`" for n, t in tests.items())
        return ("metric_category STRING, field_name STRING, invalid_count BIGINT, error_percentage DOUBLE",
                f"SELECT '{category}', field_name, invalid_count, percent_of(invalid_count, n) FROM (SELECT count(*) AS n, {tallies} FROM ({judged})) UNPIVOT (invalid_count FOR field_name IN ({', '.join(f'`{n}`' for n in tests)}))")

    return {
        "report_quality": (
            "report_type STRING, total_records BIGINT, unique_patients BIGINT, unique_icd10_codes BIGINT, valid_patient_ids BIGINT, valid_ages BIGINT, valid_length_of_stay BIGINT, "
            "valid_diagnosis_text BIGINT, valid_icd10_codes BIGINT, fully_valid_records BIGINT, overall_quality_score DOUBLE",
            "SELECT 'Data Quality Report', t.*, percent_of(valid, total) FROM (SELECT count(*) AS total, count(DISTINCT id), count(DISTINCT code), count(id), "
            "count_if(try_cast(age AS INT) BETWEEN 0 AND 120), count_if(try_cast(stay AS INT) >= 0), count_if(text_length >= 10), count_if(is_report_code(code)), count_if(valid) AS valid "
            f"FROM ({judged})) t"),
        "report_metadata": (
            "report_title STRING, total_records_processed BIGINT, unique_patients BIGINT, unique_icd10_codes BIGINT, unique_genders BIGINT, overall_data_quality_score DOUBLE",
            f"SELECT 'Data Validation Report', total, ids, codes, genders, percent_of(valid, total) FROM (SELECT count(*) AS total, count(DISTINCT id) AS ids, count(DISTINCT code) AS codes, count(DISTINCT gender) AS genders, count_if(valid) AS valid FROM ({judged}))"),
        "report_missing": counted("Missing Values", {str(c): f"{k} IS NULL" for c, k in zip(
            (cols.id, cols.age, cols.gender, cols.text_length or cols.text, cols.code, cols.stay), ("id", "age", "gender", "text_length", "code", "stay"), strict=True)}),
        "report_violations": counted("Data Validation", {
            "invalid_age": "try_cast(age AS INT) < 0 OR try_cast(age AS INT) > 120", "negative_length_of_stay": "try_cast(stay AS INT) < 0",
            "short_diagnosis_text": "text_length < 10", "invalid_icd10_format": "NOT is_report_code(code)"}),
        "report_issues": ("validation_issue STRING, count BIGINT", f"SELECT issue, count(*) FROM ({judged}) WHERE issue <> 'Valid' GROUP BY 1"),
        "report_ages": grouped(cols.age, f"age_group(try_cast(`{cols.age}` AS INT))", "age_group_name", "Age Distribution"),
        "report_stays": grouped(cols.stay, f"stay_group(try_cast(`{cols.stay}` AS INT))", "los_group", "Length of Stay Distribution"),
        "report_prefixes": grouped(cols.code, f"substring(`{cols.code}`, 1, 3)", "icd10_category", "ICD-10 Distribution"),
        "report_categories": grouped(cols.gender, f"`{cols.gender}`", "category", "Category Distribution"),
    }


def register_reports(spark: SparkSession, view: str, cols: RecordColumns = RecordColumns()) -> list[str]:
    """Define the reports of ``view``, whose columns ``cols`` names, as table functions; the scalar functions with them."""
    register_functions(spark)
    made = report_queries(view, cols)
    for name, (columns, query) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE ({columns}) RETURN {query}")
    return list(made)


def run_report(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {name}()")
