"""Data-quality reports and distributions (DataFrame -> DataFrame).

Each report is one aggregation pass. Where the SQL form of a report is a
``UNION ALL`` of single-metric aggregates (one scan and one exchange per
branch), the operator computes all metrics in one ``agg`` and unpivots the
one-row result. Percent denominators are scalar subqueries over the grouped
result, so the input is scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import all_codes_valid, code_pieces
from ..functions.generators import explode_rows
from ..functions.patterns import AGE_BUCKETS, CODE_STRICT, SEVERITY_BUCKETS, STAY_BUCKETS
from ..functions.rules import RecordColumns, Rules


def percent(part: Column, total) -> Column:
    """round(part * 100 / total, 2) as double; NULL when total is 0."""
    return F.round(F.try_divide(part.cast("double") * F.lit(100.0), total), 2)


def distinct_count(df: DataFrame, column: str) -> Column:
    """Exact number of different values of ``column``, as a scalar subquery.

    Whole numbers are bits of bitmaps, one of 4 kB per 32,768 neighbouring numbers, which tasks
    build partially and the shuffle merges; other values are counted as distinct groups. A report
    that asks for several such counts so reads its rows once per count, and none multiplies them.
    """
    if isinstance(df.schema[column].dataType, T.IntegralType):
        part, place = F.bitmap_bucket_number(F.col(column)), F.bitmap_bit_position(F.col(column))
        maps = df.where(F.col(column).isNotNull()).groupBy(part.alias("part")).agg(F.bitmap_construct_agg(place).alias("held"))
        return maps.select(F.coalesce(F.sum(F.bitmap_count("held")), F.lit(0))).scalar()
    # groups are counted one level up: two such counts side by side would be merged into one that multiplies rows
    return df.where(F.col(column).isNotNull()).select(column).distinct().select(F.count(F.lit(1))).scalar()


def quality_summary(df: DataFrame, cols: RecordColumns = RecordColumns(),
                    report_type: str = "Data Quality Report",
                    with_timestamp: bool = False) -> DataFrame:
    """One row: record counts, distinct ids/codes, per-rule valid counts,
    fully-valid count and quality percentage."""
    r = Rules(cols)
    agg = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(r.id_present()).alias("valid_patient_ids"),
        F.count_if(r.age_valid()).alias("valid_ages"),
        F.count_if(r.stay_valid()).alias("valid_length_of_stay"),
        F.count_if(r.text_valid()).alias("valid_diagnosis_text"),
        F.count_if(r.code_valid()).alias("valid_icd10_codes"),
        F.count_if(r.fully_valid()).alias("fully_valid_records"),
    )
    out = agg.select(
        F.lit(report_type).alias("report_type"),
        *([F.current_timestamp().alias("report_timestamp")] if with_timestamp else []),
        "total_records",
        distinct_count(df, cols.id).alias("unique_patients"),
        distinct_count(df, cols.code).alias("unique_icd10_codes"),
        *agg.columns[1:],
        percent(F.col("fully_valid_records"), F.col("total_records")).alias("overall_quality_score"),
    )
    return out


def report_metadata(df: DataFrame, cols: RecordColumns = RecordColumns(),
                    title: str = "Data Validation Report",
                    with_timestamp: bool = False) -> DataFrame:
    r = Rules(cols)
    agg = df.agg(
        F.count(F.lit(1)).alias("total_records_processed"),
        F.count_if(r.fully_valid()).alias("_valid"),
    )
    return agg.select(
        F.lit(title).alias("report_title"),
        *([F.current_timestamp().alias("generated_at")] if with_timestamp else []),
        "total_records_processed", distinct_count(df, cols.id).alias("unique_patients"),
        distinct_count(df, cols.code).alias("unique_icd10_codes"), distinct_count(df, cols.gender).alias("unique_genders"),
        percent(F.col("_valid"), F.col("total_records_processed")).alias("overall_data_quality_score"),
    )


def _metric_rows(agg: DataFrame, names: list[str], category: str) -> DataFrame:
    """Unpivot a one-row frame of counts into (category, field, count, %)."""
    long = agg.unpivot(["_n"], names, "field_name", "invalid_count")
    return long.select(
        F.lit(category).alias("metric_category"),
        "field_name",
        "invalid_count",
        percent(F.col("invalid_count"), F.col("_n")).alias("error_percentage"),
    )


def missing_values(df: DataFrame, columns, category: str = "Missing Values") -> DataFrame:
    """Per column: number and percent of NULLs, from a single aggregation.
    ``columns``: names, or {reported name: column} (e.g. a length column
    that is NULL exactly when the text is)."""
    cols = columns if isinstance(columns, dict) else {c: c for c in columns}
    agg = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[(F.count(F.lit(1)) - F.count(F.col(c))).alias(name) for name, c in cols.items()],
    )
    return _metric_rows(agg, list(cols), category)


def rule_violations(df: DataFrame, cols: RecordColumns = RecordColumns(),
                    category: str = "Data Validation") -> DataFrame:
    rules = Rules(cols).violations()
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(r.invalid).alias(r.name) for r in rules])
    return _metric_rows(agg, [r.name for r in rules], category)


def invalid_records(df: DataFrame, cols: RecordColumns = RecordColumns(),
                    keep: list[str] | None = None) -> DataFrame:
    """Rows failing any rule, with the first failing rule's name, ordered by it."""
    r = Rules(cols)
    keep = keep or [cols.id, cols.age, cols.gender, cols.text, cols.code, cols.stay]
    return (df.filter(r.any_issue())
            .select(*keep, r.first_issue().alias("validation_issue"))
            .orderBy("validation_issue", cols.id))


def distribution(df: DataFrame, key: Column, name: str, section: str,
                 order: list[str] | None = None) -> DataFrame:
    """Group count with percent of all rows (NULL group included).

    Ordered by count descending (then key), or by the position of the key in
    ``order`` for bucketed reports.
    """
    g = df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("count"))
    total = g.select(F.sum("count")).scalar()
    out = g.select(F.lit(section).alias("report_section"), name, "count",
                   percent(F.col("count"), total).alias("percentage"))
    if order:
        rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(name))
        return out.orderBy(rank, name)
    return out.orderBy(F.desc("count"), name)


def age_bucket(age) -> Column:
    a = (F.col(age) if isinstance(age, str) else age).try_cast("int")
    b = AGE_BUCKETS
    return (F.when(a < 18, b[0]).when(a.between(18, 30), b[1]).when(a.between(31, 50), b[2])
            .when(a.between(51, 70), b[3]).when(a > 70, b[4]).otherwise(b[5]))


def stay_bucket(stay) -> Column:
    s = (F.col(stay) if isinstance(stay, str) else stay).try_cast("int")
    b = STAY_BUCKETS
    return (F.when(s <= 1, b[0]).when(s.between(2, 7), b[1]).when(s.between(8, 14), b[2])
            .when(s.between(15, 30), b[3]).when(s > 30, b[4]).otherwise(b[5]))


def severity_bucket(score) -> Column:
    """Buckets with the gaps 2.0 < x < 2.1 and 5.0 < x < 5.1 left 'Unknown'."""
    x = (F.col(score) if isinstance(score, str) else score).try_cast("double")
    b = SEVERITY_BUCKETS
    return (F.when(x <= 2.0, b[0]).when(x.between(2.1, 5.0), b[1]).when(x.between(5.1, 8.0), b[2])
            .when(x > 8.0, b[3]).otherwise(b[4]))


def age_distribution(df: DataFrame, age: str = "age") -> DataFrame:
    return distribution(df, age_bucket(age), "age_group", "Age Distribution", AGE_BUCKETS)


def stay_distribution(df: DataFrame, stay: str = "length_of_stay") -> DataFrame:
    return distribution(df, stay_bucket(stay), "los_group", "Length of Stay Distribution", STAY_BUCKETS)


def severity_distribution(df: DataFrame, score: str = "severity_score") -> DataFrame:
    return distribution(df, severity_bucket(score), "severity_group", "Severity Score Distribution",
                        SEVERITY_BUCKETS)


def prefix_distribution(df: DataFrame, code: str = "icd10_code", length: int = 3) -> DataFrame:
    return distribution(df, F.substring(F.col(code), 1, length), "icd10_category", "ICD-10 Distribution")


def category_distribution(df: DataFrame, column: str, section: str, name: str | None = None) -> DataFrame:
    return distribution(df, F.col(column), name or column, section)


# ---------------------------------------------------------------------------
# code-set datasets


def code_counts(df: DataFrame, codes: str = "codes") -> DataFrame:
    """(code, count) over all pieces of all code sets."""
    return (explode_rows(df, code_pieces(codes), "code")
            .groupBy("code").agg(F.count(F.lit(1)).alias("count")))


def top_counts(counts: DataFrame, key: str, n: int) -> DataFrame:
    """Top n by count, ties by key (a bounded TakeOrderedAndProject)."""
    return counts.orderBy(F.desc("count"), key).limit(n)


def _ranked_string(counts: DataFrame, key: str, n: int | None = None) -> Column:
    """Scalar subquery: 'key:count, ...' ordered by count desc then key, of the
    top ``n`` or of every group. The groups are counted before they are folded,
    so the string is as long as the column's distinct values; for an open
    column take :func:`distribution`, which has a row per value."""
    src = top_counts(counts, key, n) if n else counts
    pairs = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("o"), F.col(key).alias("k"),
                                                 F.col("count").alias("c"))))
    s = F.array_join(F.transform(pairs, lambda p: F.concat(p["k"], F.lit(":"), p["c"].cast("string"))), ", ")
    return src.select(s).scalar()


def _note_length(note: str | None, note_length: str | None):
    if note_length:
        return F.col(note_length)
    return F.length(F.col(note)) if note else None


def dataset_metadata(df: DataFrame, codes: str = "codes", age: str = "age", gender: str = "gender",
                     note: str | None = None, pattern: str = CODE_STRICT, top_n: int = 20,
                     note_length: str | None = None) -> DataFrame:
    """One row: records, distinct codes, age range, gender counts, top codes,
    and the three all-rows checks (``note_length``: a precomputed length,
    NULL for a missing note, may replace ``note``)."""
    counts = code_counts(df, codes)
    genders = df.groupBy(F.col(gender).alias("g")).agg(F.count(F.lit(1)).alias("count"))
    n_len = _note_length(note, note_length)
    if n_len is not None:
        null_ok = F.bool_and(n_len.isNotNull())
        empty_ok = F.bool_and(F.coalesce(n_len > 0, F.lit(False)))
    else:
        null_ok = empty_ok = F.lit(None).cast("boolean")
    agg = df.agg(
        F.count(F.lit(1)).alias("num_records"),
        F.concat(F.min(age).cast("string"), F.lit("-"), F.max(age).cast("string")).alias("age_range"),
        F.coalesce(F.bool_and(all_codes_valid(F.col(codes), pattern)), F.lit(True)).alias("all_icd10_valid"),
        null_ok.alias("no_null_notes"),
        empty_ok.alias("no_empty_notes"),
    )
    return agg.select(
        "num_records",
        F.lit(counts.select(F.count(F.lit(1))).scalar()).alias("total_unique_codes"),
        "age_range",
        _ranked_string(genders.withColumn("g", F.coalesce(F.col("g"), F.lit("NULL"))), "g").alias(
            "gender_distribution"),
        _ranked_string(counts, "code", top_n).alias("code_distribution"),
        "all_icd10_valid", "no_null_notes", "no_empty_notes",
    )


def dataset_metrics(df: DataFrame, codes: str = "codes", age: str = "age", gender: str = "gender",
                    note: str | None = None, pattern: str = CODE_STRICT, top_n: int = 5,
                    note_length: str | None = None) -> DataFrame:
    """One row: average codes per record, age mean and sample std, gender
    balance (smallest / largest group), top codes, code diversity, 0/1 scores."""
    counts = code_counts(df, codes)
    genders = df.groupBy(F.col(gender).alias("g")).agg(F.count(F.lit(1)).alias("count"))
    n_codes = counts.select(F.sum("count")).scalar()
    n_distinct = counts.select(F.count(F.lit(1))).scalar()
    balance = genders.select(F.try_divide(F.min("count").cast("double"), F.max("count"))).scalar()
    n_len = _note_length(note, note_length)
    complete = F.bool_and(n_len.isNotNull()) if n_len is not None else F.lit(True)
    agg = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.avg(age).alias("_age_mean"),
        F.stddev_samp(age).alias("_age_std"),
        F.coalesce(F.bool_and(all_codes_valid(F.col(codes), pattern)), F.lit(True)).alias("_valid"),
        complete.alias("_complete"),
    )
    return agg.select(
        "total_records",
        F.lit(n_distinct).alias("unique_icd10_codes"),
        F.round(F.try_divide(F.lit(n_codes).cast("double"), F.col("total_records")), 2).alias(
            "avg_codes_per_record"),
        F.when(F.col("_valid"), 1.0).otherwise(0.0).alias("data_quality_score"),
        F.when(F.col("_complete"), 1.0).otherwise(0.0).alias("completeness_score"),
        F.round("_age_mean", 6).alias("age_mean"),
        F.round("_age_std", 6).alias("age_std"),
        F.round(F.lit(balance), 6).alias("gender_balance"),
        _ranked_string(counts, "code", top_n).alias("top_5_codes"),
        F.round(F.try_divide(F.lit(n_distinct).cast("double"), F.lit(n_codes)), 6).alias("code_diversity"),
    )


def profile(df: DataFrame, age: str = "age", gender: str = "gender", text: str = "note",
            text_length: str | None = None) -> DataFrame:
    """Ranges of a raw table: age, distinct genders, text length."""
    n_len = F.col(text_length) if text_length else F.length(text)
    genders = df.select(F.col(gender).alias("g")).where(F.col("g").isNotNull()).distinct()
    gender_list = genders.select(F.array_join(F.array_sort(F.collect_list("g")), ",")).scalar()
    return df.agg(
        F.min(age).alias("min_age"),
        F.max(age).alias("max_age"),
        F.count_distinct(F.col(gender)).alias("n_genders"),
        F.min(n_len).alias("min_text_length"),
        F.max(n_len).alias("max_text_length"),
    ).select("*", F.lit(gender_list).alias("genders"))


def histogram(df: DataFrame, value: Column, bins: int, name: str = "value") -> DataFrame:
    """Equal-width histogram over [min, max] with the top edge in the last bin.

    Every bin is listed, empty ones with count 0; the bin table has ``bins``
    rows whatever the data size.
    """
    v = df.select(value.cast("double").alias("x")).where(F.col("x").isNotNull())
    lo = v.select(F.min("x")).scalar()
    hi = v.select(F.max("x")).scalar()
    width = (F.lit(hi) - F.lit(lo))
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.lit(lo)) * F.lit(float(bins)) / width), F.lit(bins - 1)))
    counts = v.groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    start = F.lit(lo) + F.col("bin") * width / F.lit(float(bins))
    end = F.lit(lo) + (F.col("bin") + 1) * width / F.lit(float(bins))
    return (edges.join(counts, "bin", "left")
            .select(F.lit(name).alias("variable"), "bin",
                    F.round(start, 6).alias("bin_start"), F.round(end, 6).alias("bin_end"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count"))
            .where(F.lit(lo).isNotNull())
            .orderBy("bin"))


def codes_per_record(df: DataFrame, codes: str = "codes") -> DataFrame:
    """How many records carry 0, 1, 2, ... codes."""
    n = F.size(code_pieces(codes))
    return (df.groupBy(n.alias("n_codes")).agg(F.count(F.lit(1)).alias("records"))
            .orderBy("n_codes"))


def split_statistics(df: DataFrame, split: str = "split", age: str = "age", codes: str = "codes",
                     gender: str = "gender", note_length: str = "note_chars") -> DataFrame:
    """Per split: size, share of all rows, mean age, mean note length, gender
    counts ('value:count, ...', largest first), distinct codes, codes per record."""
    pieces = code_pieces(codes)
    per = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("records"),
        F.avg(age).alias("_age"),
        F.avg(note_length).alias("_len"),
        F.sum(F.size(pieces)).alias("_codes"),
    )
    distinct_codes = (explode_rows(df, pieces, "code", [split]).distinct()
                      .groupBy(split).agg(F.count(F.lit(1)).alias("unique_codes")))
    counts = df.groupBy(split, F.coalesce(F.col(gender), F.lit("NULL")).alias("g")).agg(F.count(F.lit(1)).alias("c"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("c")).alias("o"), "g", "c")))
    genders = counts.groupBy(split).agg(F.array_join(
        F.transform(ordered, lambda x: F.concat(x["g"], F.lit(":"), x["c"].cast("string"))), ", ").alias("genders"))
    total = per.select(F.sum("records")).scalar()
    return (per.join(distinct_codes, split, "left").join(genders, split, "left")
            .select(split, "records",
                    F.round(F.try_divide(F.col("records").cast("double"), total), 6).alias("ratio"),
                    F.round("_age", 6).alias("mean_age"),
                    F.round("_len", 6).alias("mean_note_length"),
                    F.col("genders").alias("gender_distribution"),
                    F.coalesce(F.col("unique_codes"), F.lit(0)).alias("unique_codes"),
                    F.round(F.try_divide(F.col("_codes").cast("double"), F.col("records")), 6).alias(
                        "codes_per_record"))
            .orderBy(split))


def value_rows(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(field, value, count) of every value of the ``columns`` ({reported name: column}), in one pass.

    The row form of the lists in :func:`profile` and :func:`dataset_metadata`, for columns with many values.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("field"), F.col(c).cast("string").alias("value")) for name, c in columns.items()])
    return explode_rows(df, pairs, "p").groupBy("p.field", "p.value").agg(F.count(F.lit(1)).alias("count"))
