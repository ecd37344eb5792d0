"""Year limits reach the scans of the queries that ask for years."""

import contextlib
import io
import re

import pytest

from millrace.plans.ds_views import DATES
from millrace.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
STARS = ["ssb_11", "ssb_12", "ssb_13", "ssb_31", "ssb_32", "ssb_33", "ssb_34", "ssb_42", "ssb_43"]


def ranges(df, column):
    """For each scan with the date column: is there a range on it among the pushed filters?"""
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain()
    scans = [line for line in shown.getvalue().split("\n") if "FileScan" in line and re.search(rf"FileScan parquet \[[^\]]*{column}", line)]
    return [f"GreaterThanOrEqual({column}" in line and f"LessThan({column}" in line for line in scans]


@pytest.mark.parametrize("name", [*(f"ds_{n}" for n in DATES), *STARS])
def test_orders_are_pruned(spark, name):
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    found = ranges(QUERIES[name](spark, FOLDER), "o_orderdate")
    assert found and all(found)


@pytest.mark.parametrize("name", ["attr_diff", "attr_top"])
def test_snapshots_are_pruned(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    found = ranges(QUERIES[name](spark, FOLDER), "l_shipdate")
    assert found and all(found)
