"""Every catalogue query against its DuckDB oracle on the smallest tables
(row count, column names/types, order-insensitive values)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from oracle_check import compare, duck  # noqa: E402
from punctua.plans import registry  # noqa: E402

E.queries()
QUERIES, ORACLE = dict(registry.QUERIES), dict(registry.ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


# iterative jobs without an SQL equivalent (row-count check only)
NON_SQL = {"delay_model_comparison"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) - NON_SQL == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, msg


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["carrier", "origin", "destination", "avg_delay_min", "flights", "rank"]
    assert max(r["rank"] for r in rows) <= 10


def test_model_comparison_runs(spark):
    rows = QUERIES["delay_model_comparison"](spark, SF_SMALL).collect()
    assert sorted(r["model"] for r in rows) == ["gradient_boosting", "logistic_regression"]
    assert all(r["average_precision"] is None or 0.0 <= r["average_precision"] <= 1.0 for r in rows)
