"""Registered queries against their SQL counterparts.

The quick run covers one query per family on the smallest tables; set ALL_QUERIES=1 for
every one of them (``python check.py`` does the same with timings).
"""

import os

import pytest

import __spark_entry__ as driver
from check import compare, duck

SF_DIR = "/root/testdata/sf0.001"
QUICK = ["a01", "a05", "a07", "a13", "a14_growth_previous_year", "a17_weekday_hour_pivot", "a23", "a25", "a33_", "j02", "j04",
         "j05", "j08", "j10", "w02", "w03", "w09", "w10", "w11", "a34", "a36", "a37", "p05", "p06", "p08", "p10", "p23",
         "p24", "p25", "a26", "o06", "p27", "f11", "f15", "h01", "u04"]
NAMES = [n for n in driver.queries() if os.environ.get("ALL_QUERIES") or any(n.startswith(q) for q in QUICK)]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("the test tables are not here")
    return duck(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    message, good, _ = compare(spark, con, SF_DIR, name)
    assert good, message


def test_entry(spark):
    got = driver.entry(spark)
    assert got.columns == ["date", "unique_orders", "total_items", "total_revenue", "avg_order_value"]
    assert got.count() > 0


def test_every_counterpart_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
