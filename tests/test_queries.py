"""Every registered query against DuckDB on the same tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from rillwork.plans.catalog import BATCH
from rillwork.plans.oracle import ORACLE
from rillwork.plans.replays import REPLAYS

QUERIES = {**BATCH, **REPLAYS}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, sf_dir, name):
    assert name in ORACLE, "query without an oracle"
    assert difference(con, ORACLE[name], QUERIES[name](spark, sf_dir)) is None


def test_no_stray_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_is_lazy_and_has_rows(spark):
    df = entry.entry(spark)
    assert "username" in df.columns
    assert df.count() > 0
