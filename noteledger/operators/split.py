"""Exact, reproducible splits, samples and folds.

Rows are ordered by a seeded md5 of the record id (ties by the id), so the
assignment is identical on every run, on any cluster size and in SQL.
Sizes follow the train/test-split rule of the reference: the held-out part
is ceil(fraction * n), the rest is train; the held-out part is split again
into validation and test the same way. ``randomSplit`` is not used because
its sizes are only approximate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import SPLIT_HOLDOUT_TEST_FRACTION, SPLIT_SEED, SPLIT_TEST_FRACTION
from .ranking import exact_rank, seeded_hash


def with_rank(df: DataFrame, id_col: str, seed: int = SPLIT_SEED, partition_cols=None,
              out: str = "_rank") -> DataFrame:
    h = df.withColumn("_h", seeded_hash(id_col, seed))
    return exact_rank(h, "_h", id_col, partition_cols, out=out).drop("_h")


def assign_split(df: DataFrame, id_col: str, seed: int = SPLIT_SEED,
                 test_fraction: float = SPLIT_TEST_FRACTION,
                 holdout_test_fraction: float = SPLIT_HOLDOUT_TEST_FRACTION,
                 out: str = "split") -> DataFrame:
    """Adds ``split`` in {'train', 'validation', 'test'} with exact sizes."""
    n = df.select(F.count(F.lit(1))).scalar()
    n_rest = F.ceil(F.lit(float(test_fraction)) * n)
    n_train = n - n_rest
    n_test = F.ceil(F.lit(float(holdout_test_fraction)) * n_rest)
    n_val = n_rest - n_test
    ranked = with_rank(df, id_col, seed)
    r = F.col("_rank")
    label = F.when(r <= n_train, "train").when(r <= n_train + n_val, "validation").otherwise("test")
    return ranked.withColumn(out, label).drop("_rank")


def sample_rows(df: DataFrame, id_col: str, n: int = 500, seed: int = SPLIT_SEED) -> DataFrame:
    """min(n, rows) rows without replacement, reproducible: a top-n on the
    seeded hash (each task keeps its own n best, then one merge of n x tasks)."""
    return df.orderBy(seeded_hash(id_col, seed), F.col(id_col)).limit(n)


def kfold(df: DataFrame, id_col: str, k: int, seed: int = SPLIT_SEED, out: str = "fold") -> DataFrame:
    """Shuffled k-fold: contiguous chunks of the hashed order, the first
    n mod k folds one row larger (the usual k-fold sizes)."""
    n = df.select(F.count(F.lit(1))).scalar()
    q = F.floor(n / F.lit(k))
    rem = n - q * F.lit(k)
    big = rem * (q + 1)
    r0 = F.col("_rank") - 1
    fold = F.when(r0 < big, F.floor(r0 / (q + 1))).otherwise(rem + F.floor((r0 - big) / q))
    return with_rank(df, id_col, seed).withColumn(out, fold.cast("int")).drop("_rank")


def stratified_fold(df: DataFrame, id_col: str, strata: str, k: int, seed: int = SPLIT_SEED,
                    out: str = "fold") -> DataFrame:
    """Fold = (rank inside the stratum) mod k, so every stratum is spread
    evenly over the folds. The rank is exact and bucketed, so one large
    stratum is still ranked by many tasks."""
    ranked = with_rank(df, id_col, seed, partition_cols=[strata])
    return ranked.withColumn(out, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")
