import json

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakeloom.session import scratch_path
from lakeloom.sources import catalog as K
from lakeloom.sources import files as S
from lakeloom.sources import synthetic as Y


def got(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def test_source_arguments(spark, tmp_path):
    path = str(tmp_path / "a.parquet")
    spark.range(3).write.parquet(path)
    assert S.scan_source(spark, file=path).count() == 3
    for bad in ({}, {"folder": "x", "file": "y"}, {"platform": "moon", "file": path}, {"platform": "catalog"}):
        with pytest.raises(ValueError):
            S.scan_source(spark, **bad)
    spark.range(2).createOrReplaceTempView("two")
    assert S.scan_source(spark, "catalog", table="two").count() == 2


def test_tree_reads_only_the_suffix(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t" / "a" / "b"))
    spark.range(2).write.option("compression", "gzip").parquet(str(tmp_path / "t" / "c"))
    assert S.scan_parquet_tree(spark, str(tmp_path / "t")).count() == 3
    with pytest.raises(ValueError):
        S.assert_same_schema([spark.range(1), spark.range(1).withColumn("x", F.lit(1))])


def test_na_stays_text(spark, tmp_path):
    path = tmp_path / "regions.csv"
    path.write_text("﻿region,note,index\nNA,,1.05\nEMEA,x,1.1\n", encoding="utf-8")
    out = S.scan_csv_na(spark, str(path), "region string, note string, index double")
    assert sorted(got(out)) == [("EMEA", "x", 1.1), ("NA", "", 1.05)]


def test_delimited_text(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("Sales;Item\n10;Item A\n-5;Item B\n")
    assert got(S.scan_csv_text(spark, str(path), ["Sales", "Item"])) == [("10", "Item A"), ("-5", "Item B")]


def test_documents(spark, tmp_path):
    (tmp_path / "d" / "sub").mkdir(parents=True)
    (tmp_path / "d" / "a.md").write_text("one\ntwo")
    (tmp_path / "d" / "sub" / "b.md").write_text("three")
    (tmp_path / "d" / "c.txt").write_text("no")
    rows = S.scan_documents(spark, str(tmp_path / "d")).collect()
    assert sorted(r["text"] for r in rows) == ["one\ntwo", "three"] and all(r["source"].endswith(".md") for r in rows)


def test_json_values_last_wins(spark, tmp_path):
    a, b = tmp_path / "a.json", tmp_path / "b.json"
    a.write_text(json.dumps({"x": 1, "y": 2.5}, indent=1))
    b.write_text(json.dumps({"x": 3}))
    assert sorted(got(S.scan_json_values(spark, [str(a), str(b)], ["x", "y"]), "name", "value")) == [("x", 3.0), ("y", 2.5)]
    c = tmp_path / "c.json"
    c.write_text('{"x": "seven", "on": true, "none": null, "list": [1, 2]}')
    assert sorted(got(S.scan_json_values(spark, [str(a), str(c)]), "name", "text", "value"))[:1] == [("list", "[1,2]", None)]
    assert dict(got(S.scan_json_values(spark, [str(a), str(c)]), "name", "text"))["x"] == "seven"
    values = {"n": np.int64(2), "s": {"b", "a"}, "l": np.array([1.5, 2.0])}
    out = S.save_values(spark, values, str(tmp_path / "v"))
    assert got(spark.read.json(out), "n", "s", "l") == [(2, "['a', 'b']", [1.5, 2.0])]


def test_payload(make):
    text = '{"data": [{"a": 1, "b": 2}, {"a": 3}, {"a": 5.5, "b": 6}]}'
    assert got(S.parse_payload(make("id int, p string", (1, text), (2, "junk")), "p", ["a", "b"], ["id"])) == [(1, 1.0, 2.0), (1, 5.5, 6.0)]
    rejected = S.rejected_payloads(make("id int, p string", (1, text), (2, "junk"), (3, None), (4, '{"data": []}')), "p", ["a", "b"], ["id"])
    assert sorted(got(rejected, "id", "reason")) == [(1, "missing b"), (2, "unreadable"), (3, "unreadable")]


def test_inventory(spark, tmp_path):
    (tmp_path / "i" / "sub").mkdir(parents=True)
    for name, text in (("a.csv", "12"), ("sub/b.CSV", "345"), ("c.exe", "x")):
        (tmp_path / "i" / name).write_text(text)
    assert sorted(got(S.file_inventory(spark, str(tmp_path / "i"), [".csv"]))) == [(".csv", 2, 5)]
    assert S.file_inventory(spark, str(tmp_path / "i")).count() == 2


def test_convert(spark, tmp_path):
    src = tmp_path / "a.csv"
    src.write_text("k,v\nNA,1\n")
    out = S.convert_to_parquet(spark, str(src), str(tmp_path / "a.parquet"), "k string, v int")
    assert got(spark.read.parquet(out)) == [("NA", 1)]
    with pytest.raises(AnalysisException):
        S.convert_to_parquet(spark, str(src), out, "k string, v int")
    (tmp_path / "b.csv").write_text("k\nx\n")
    made = S.convert_files(spark, [str(tmp_path / "b.csv"), out], str(tmp_path / "made"), {"b": "k string"})
    assert [p.split("/")[-1] for p in made] == ["b.parquet", "a.parquet"]
    for bad in ("x.xlsx", "x.csv"):
        with pytest.raises(ValueError):
            S.convert_to_parquet(spark, str(tmp_path / bad), str(tmp_path / "z"))


def test_partitioned_job(spark, tmp_path):
    for part, rows in (("one", [("10",), ("-5",)]), ("deep/two", [("7",)])):
        spark.createDataFrame(rows, "Sales string").write.parquet(str(tmp_path / "in" / part))
    S.partitioned_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), lambda df: df.filter(F.col("Sales").cast("int") > 0))
    assert sorted(got(spark.read.parquet(str(tmp_path / "out")), "Sales", "part")) == [("10", "one"), ("7", "deep/two")]


def test_monitoring(make):
    df = make("id int, x double, y int, p int", (1, 0.5, 1, 1), (1, 0.7, 0, 1))
    out = S.monitoring_log(df, ["x"], "y", "p", ["id"], F.lit("train"), "b1")
    assert out.columns == ["record_key", "x", "actual", "output", "dataset", "batch_id"]
    assert got(S.repeated_keys(out, "record_key")) == [("1-b1", 2)]


def test_rows_of(spark):
    assert sorted(r["id"] for r in S.rows_of(spark.range(5))) == [0, 1, 2, 3, 4]


@pytest.fixture
def db(spark):
    root = scratch_path(spark, "catalog-test")
    name = "t_" + root[-8:]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}'")
    yield name
    for d in (name, name + "_clone"):
        spark.sql(f"DROP DATABASE IF EXISTS {d} CASCADE")


def test_dispositions(spark, db):
    t = f"{db}.a"
    K.save_to_table(spark.range(3), t)
    with pytest.raises(AnalysisException):
        K.save_to_table(spark.range(3), t)
    K.save_to_table(spark.range(2), t, "APPEND")
    assert spark.table(t).count() == 5
    K.save_to_table(spark.range(1), t, "TRUNCATE")
    assert spark.table(t).count() == 1
    with pytest.raises(ValueError):
        K.save_to_table(spark.range(1), t, "MERGE")


def test_tables_rows_and_expiry(spark, db, tmp_path):
    t = f"{db}.people"
    K.create_table(spark, t, {"name": "STRING", "age": "INTEGER"})
    K.insert_rows(spark, t, [{"name": "a", "age": 1}, {"name": "b"}])
    assert sorted(got(spark.table(t)), key=str) == [("a", 1), ("b", None)]
    with pytest.raises(ValueError):
        K.insert_rows(spark, t, [{"nope": 1}])
    with pytest.raises(Exception):
        K.insert_rows(spark, t, [{"name": "c", "age": "text"}])
    K.create_temp_table(spark, f"{db}.tmp", [("k", "STRING", "REQUIRED"), ("v", "FLOAT", "NULLABLE")], hours=0)
    K.create_temp_table(spark, f"{db}.tmp", [("k", "STRING", "REQUIRED")], hours=0)
    assert spark.table(f"{db}.tmp").columns == ["k"]
    assert K.purge_expired(spark, db, now=9e9) == [f"{db}.tmp"]
    K.delete_table(spark, f"{db}.tmp")
    K.delete_table(spark, t)
    assert K.list_tables(spark, [db]) == []
    out = K.extract(spark.range(4), str(tmp_path / "x"))
    assert spark.read.option("header", "true").csv(out).count() == 4


def test_backup_and_failover(spark, db):
    K.save_to_table(spark.range(3), f"{db}.a")
    K.save_to_table(spark.range(4), f"{db}.b")
    path = scratch_path(spark, "backup-test")
    assert K.list_tables(spark, [db], ["b"]) == [(db, "b")]
    assert K.backup_tables(spark, K.list_tables(spark, [db]), path) == [(db, "a", "copied"), (db, "b", "copied")]
    assert all(d != db + "_clone" for d, _ in K.list_tables(spark)) and (db, "a") in K.list_tables(spark)
    K.delete_table(spark, f"{db}.a")
    assert K.backup_tables(spark, [(db, "a"), (db, "zzz")], path, "failover")[0] == (db, "a", "copied")
    assert spark.table(f"{db}.a").count() == 3
    with pytest.raises(ValueError):
        K.backup_tables(spark, [], path, "other")


def test_synthetic_is_stable(spark):
    ranges = {"sepal_length": (4, 7.9), "u": (0, 1)}
    a = Y.synthetic_uniform(spark, 1000, ranges, 3)
    assert a.exceptAll(Y.add_uniforms(spark.range(1000).repartition(9), ["id"], ranges, 3)).count() == 0
    r = a.agg(F.min("sepal_length").alias("lo"), F.max("sepal_length").alias("hi"), F.avg("u").alias("m")).first()
    assert 4 <= r["lo"] < 4.1 and 7.8 < r["hi"] < 7.9 and 0.45 < r["m"] < 0.55
    picks = spark.range(300).select(Y.choice_column(["id"], ["a", "b"], 1).alias("c"), Y.integer_column(["id"], -100, 100, 2).alias("n"))
    assert {r["c"] for r in picks.collect()} == {"a", "b"} and all(-100 <= r["n"] < 100 for r in picks.collect())


def test_shared_folder_follows_the_session(spark):
    from lakeloom.session import shared_folder

    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == named.rstrip("/") if named else folder
    assert scratch_path(spark, "x") != scratch_path(spark, "x") and scratch_path(spark, "x").startswith(folder)
