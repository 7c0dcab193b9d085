"""Logs of predictions: unique keys, rejected rows, repeated and interrupted appends."""

import pytest

from lakeloom.sources import prediction_log as L


def keys(df, *also):
    return sorted(tuple(r) for r in df.select("record_key", *also).collect())


def test_reasons_and_repeats(spark, make, tmp_path):
    path, schema = str(tmp_path), "record_key string, x long"
    first = make(schema, ("a", 1), ("b", 2), ("c", 3), ("c", 4), (None, 5), ("", 6))
    assert L.append_to_log(first, path, "b1") == {"kept": 3, "no_key": 1, "repeated": 2, "known": 0, "suspects": 0}
    second = make(schema, ("a", 7), ("c", 8), ("d", 9), ("b", 1), ("b", 1))
    got = L.append_to_log(second, path, "b2")
    assert (got["kept"], got["repeated"], got["known"]) == (2, 2, 1) and got["suspects"] >= 1
    assert L.append_to_log(second, path, "b2") == got
    log = L.read_log(spark, path, first)
    assert keys(log, "x", "batch") == [("", 6, "b1"), ("a", 1, "b1"), ("b", 2, "b1"), ("c", 8, "b2"), ("d", 9, "b2")]
    bad = L.read_log(spark, path, first, "rejected").where("batch = 'b2'")
    assert keys(bad, "reason") == [("a", L.KNOWN), ("b", L.REPEATED), ("b", L.REPEATED)]


def test_cut_off_append_is_done_again(spark, make, tmp_path):
    path, schema = str(tmp_path), "record_key string"
    rows = make(schema, ("a",), ("b",))
    L.append_to_log(rows, path, "b1")
    # rows and filter of a batch without its commit row
    make("record_key string, reason string", ("z", None), ("q", None)).write.parquet(f"{path}/rows/batch=b2/state=kept")
    make("slot long, bits long, power int", (0, -1, 0)).write.parquet(f"{path}/filters/batch=b2")
    assert keys(L.read_log(spark, path, rows)) == [("a",), ("b",)]
    assert L.append_to_log(make(schema, ("z",), ("a",)), path, "b2")["kept"] == 1
    assert keys(L.read_log(spark, path, rows)) == [("a",), ("b",), ("z",)]


def test_empty_batches_and_names(spark, make, tmp_path):
    path, none = str(tmp_path), make("record_key string", ("a",)).limit(0)
    with pytest.raises(FileNotFoundError):
        L.read_log(spark, path, none)
    assert set(L.append_to_log(none, path, "b0").values()) == {0}
    assert L.append_to_log(make("record_key string", ("a",)), path, "b1")["kept"] == 1
    for name in ("", "a/b", "ä"):
        with pytest.raises(ValueError):
            L.append_to_log(none, path, name)
    with pytest.raises(ValueError):
        L.append_to_log(make("record_key string, Batch int", ("a", 1)), path, "b2")


def test_filters_rule_out_nearly_all_new_keys(spark, tmp_path):
    path = str(tmp_path)
    for i, (low, high) in enumerate(((0, 30_000), (29_990, 60_000), (59_000, 70_000))):
        got = L.append_to_log(spark.range(low, high).selectExpr("cast(id as string) record_key"), path, f"b{i}")
    assert got["known"] == 1_000 and got["kept"] == 10_000 and got["suspects"] < 1_000 + 0.05 * 20_000
    log = L.read_log(spark, path, spark.range(1).selectExpr("cast(id as string) record_key"))
    assert log.count() == log.select("record_key").distinct().count() == 70_000


def test_hot_key(spark, tmp_path):
    rows = spark.range(3_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) record_key")
    assert L.append_to_log(rows, str(tmp_path), "b1") == {"kept": 2_000, "no_key": 0, "repeated": 1_000, "known": 0, "suspects": 0}
