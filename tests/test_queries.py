"""Every registered query against its SQL counterpart."""

import compare
import pytest

from __spark_entry__ import entry
from paylake.checks.oracles import ORACLES
from paylake.checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []


def test_entry_has_rows(spark):
    assert entry(spark).count() == 1500


@pytest.mark.parametrize(
    ("part", "whole"),
    [
        ("affected_payments", "SELECT count(*) FROM orders"),
        ("affected_merchants", "SELECT count(*) FROM customer"),
        ("affected_gateways", "SELECT count(*) FROM nation"),
        ("affected_days", "SELECT count(DISTINCT o_orderdate) FROM orders"),
    ],
)
def test_batches_touch_a_small_part(con, part, whole):
    """Else a partial rebuild that forgot its keys would still look right."""
    number = con.execute(f"SELECT count(*) FROM ({ORACLES[part]})").fetchone()[0]
    assert 0 < 2 * number < con.execute(whole).fetchone()[0]


@pytest.mark.parametrize(
    "name", ["payment_performance", "merchant_performance", "gateway_performance", "financial_operations"]
)
def test_full_tables_are_no_partial_rebuilds(spark, con, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), con, ORACLES[f"incremental_{name}"]) != []
