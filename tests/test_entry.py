"""Driver contract: entry runs, every query has an oracle, and all agree at sf0.001."""

import os
import sys

import pytest
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tests"))

import oracle_check  # noqa: E402
from __spark_entry__ import QUERIES, entry, oracle_sql, queries  # noqa: E402


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == [
        "customer_id",
        "total_spent",
        "total_orders",
        "avg_order_value",
        "last_purchase_date",
        "first_purchase_date",
        "customer_lifetime_days",
        "customer_segment",
    ]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg, _ = oracle_check.compare(spark, con, name, queries()[name], oracle_sql()[name], SF_SMALL)
    assert ok, msg
