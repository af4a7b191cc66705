"""Roles give every record once and read only the tables they are asked for."""

import re

import pytest

from noteledger.plans.catalog import QUERIES
from noteledger.sources import roles

from .conftest import SF_SMALL


def test_role_row_counts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert roles.records(spark, SF_SMALL, roles.RECORD_COLUMNS).count() == docs
    assert roles.visits(spark, SF_SMALL, roles.VISIT_COLUMNS).count() == orders


def test_unknown_columns_are_refused(spark):
    with pytest.raises(ValueError):
        roles.records(spark, SF_SMALL, ["nothing"])


@pytest.mark.parametrize(("query", "tables"), [
    ("prefix_distribution", {"documents", "part"}), ("validation_errors", {"documents", "customer"}),
    ("quality_summary", {"documents", "part", "customer"}), ("top_codes", {"orders", "lineitem", "part"}),
    ("code_parse", {"orders", "lineitem", "part"})])
def test_only_the_tables_asked_for_are_read(spark, query, tables):
    df = QUERIES[query](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"/(\w+)\.parquet", plan)) == tables
