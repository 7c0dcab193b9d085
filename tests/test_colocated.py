"""Bucketed joins: same rows as a plain join, and no exchange on any side."""

import uuid

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.colocated import left_join_colocated, save_colocated


@pytest.fixture
def db(spark, tmp_path):
    name = "t_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_same_rows_without_exchange(spark, db, tmp_path, hot_rows):
    facts = spark.range(600).selectExpr("if(id % 3 = 0, 7, if(id % 50 = 1, null, id % 40)) as k", "id as v")
    a = spark.range(30).selectExpr("id as k", "concat('a', id) as a").unionByName(spark.createDataFrame([(None, "none"), (3, "twice")], "k long, a string"))
    b = spark.range(10, 50).selectExpr("id as kb", "id * 2 as b")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = save_colocated(facts, f"{db}.f", "k", f"{tmp_path}/f", 4, hot_rows)
        others = [save_colocated(a, f"{db}.a", "k", f"{tmp_path}/a", 4, None), save_colocated(b, f"{db}.b", "kb", f"{tmp_path}/b", 4, None)]
        got = left_join_colocated(spark, f, others)
        want = facts.join(a, "k", "left").join(b, F.col("k") == F.col("kb"), "left").drop("kb")
        assert got.columns == want.columns == ["k", "v", "a", "b"] and rows(got) == rows(want)
        cool = got._jdf.queryExecution().executedPlan().toString().split("Union")[-1]
        assert (f.hot is None) == (hot_rows is None)
        if hot_rows is None:
            assert "Exchange" not in cool and "SelectedBucketsCount" in cool
        else:
            assert spark.read.parquet(f.hot).select("k").distinct().count() == 1 and spark.table(f"{db}.f").where("k = 7").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_what_does_not_fit(spark, db, tmp_path):
    t = spark.range(8).withColumnRenamed("id", "k")
    one = save_colocated(t, f"{db}.one", "k", f"{tmp_path}/1", 2)
    two = save_colocated(t.withColumn("x", F.lit(1)), f"{db}.two", "k", f"{tmp_path}/2", 4, None)
    with pytest.raises(ValueError):
        left_join_colocated(spark, one, [two])
    same = save_colocated(t.withColumn("x", F.lit(1)), f"{db}.same", "k", f"{tmp_path}/3", 2, None)
    with pytest.raises(ValueError):
        left_join_colocated(spark, one, [same, same])
