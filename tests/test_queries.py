"""Every registered query against its DuckDB twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_registration():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(duck, sql, df) == ""


@pytest.mark.parametrize("name", ["customer_features", "cumulative_regret", "split_stratified", "roc_curve", "knn_l2", "assemble_records"])
def test_result_does_not_depend_on_partitions(spark, duck, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert compare(duck, entry.oracle_sql()[name], entry.queries()[name](spark, FOLDER)) == ""
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
