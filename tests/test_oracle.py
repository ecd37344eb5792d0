"""Every registered query with a SQL twin equals it on the smallest data set; the others run and give rows."""

import pytest

import millrace.plans  # noqa: F401
from millrace.registry import QUERIES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
TWINS = sorted(n for n, q in QUERIES.items() if q.sql)
ALONE = sorted(n for n, q in QUERIES.items() if not q.sql)


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", TWINS)
def test_twin(spark, con, name):
    assert compare(spark, con, name, FOLDER) is None


@pytest.mark.parametrize("name", ALONE)
def test_alone(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert len(set(df.columns)) == len(df.columns)
    df.collect()
