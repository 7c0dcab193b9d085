"""Checked writes, stored sketches and incremental copies."""

import pytest

from lakeloom.operators.gate import read_published, write_checked
from lakeloom.operators.quality import Expectation, Suite, validate
from lakeloom.operators.sketches import distinct_from_sketches, store_sketches
from lakeloom.sources.sync import read_copy, sync_partitions

E = Expectation
CHECKS = (
    E("column_values_to_not_be_null", {"column": "a"}), E("column_values_to_be_between", {"column": "a", "min_value": 0, "max_value": 9, "mostly": 0.5}),
    E("column_values_to_match_regex", {"column": "b", "regex": "^x"}), E("column_values_to_be_in_set", {"column": "b", "value_set": ["x1", "x2"]}),
    E("column_values_to_be_unique", {"column": "a", "mostly": 0.1}), E("column_distinct_values_to_equal_set", {"column": "b", "value_set": ["x1"]}),
    E("column_sum_to_be_between", {"column": "a", "min_value": 1}), E("table_columns_to_match_set", {"column_set": ["a", "b"]}),
    E("column_min_to_be_between", {"column": "a", "min_value": 0}), E("table_row_count_to_equal", {"value": 5}),
)


def key(rows):
    return sorted(map(str, rows))


def test_results_are_those_of_validate(make, tmp_path):
    rows = make("a long, b string", (1, "x1"), (None, "y"), (20, "x2"), (1, None), (3, "x9"))
    for level in ("warning", "critical"):
        suite = Suite("s", level, CHECKS)
        got = write_checked(rows, str(tmp_path / level), suite)
        assert key(got.results.collect()) == key(validate(rows, suite).collect())
        assert (got.kept, got.rejected) == (2, 3) and got.published == (level == "warning")
    assert "column_values_to_not_be_null(a)" in got.failed
    with pytest.raises(FileNotFoundError):
        read_published(rows.sparkSession, str(tmp_path / "critical"))
    good = read_published(rows.sparkSession, str(tmp_path / "warning"))
    assert key(good.collect()) == key(rows.where("b in ('x1') or a = 1").where("a is not null").collect())
    bad = {(r["a"], r["b"]): r["reasons"] for r in read_published(rows.sparkSession, str(tmp_path / "warning"), rejected=True).collect()}
    assert bad[(20, "x2")] == ["column_values_to_be_between(a)"] and len(bad[(None, "y")]) == 3 and bad[(3, "x9")] == ["column_values_to_be_in_set(b)"]


def test_source_is_read_once(spark, make, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(100).selectExpr("id as a", "'x1' as b").mapInArrow(count, "a long, b string")
    suite = Suite("s", "critical", (E("column_values_to_be_between", {"column": "a", "max_value": 200}), E("column_values_to_be_unique", {"column": "a"})))
    assert write_checked(rows, str(tmp_path), suite).published and seen.value == 100
    assert read_published(spark, str(tmp_path)).count() == 100


def test_versions_follow_each_other(make, tmp_path, spark):
    suite = Suite("s", "critical", (E("column_max_to_be_between", {"column": "a", "max_value": 9}),))
    for value, seen in ((1, 1), (20, 1), (5, 5)):
        write_checked(make("a long", (value,)), str(tmp_path), suite)
        assert read_published(spark, str(tmp_path)).first()["a"] == seen
    write_checked(make("a long", (1,)).limit(0), str(tmp_path), Suite("none", "warning", ()))
    assert read_published(spark, str(tmp_path)).count() == 0 and read_published(spark, str(tmp_path), rejected=True).count() == 0
    with pytest.raises(ValueError):
        write_checked(make("Status int", (1,)), str(tmp_path), suite)


def test_sketches_join_and_are_replaced(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("cast(id % 4 as int) as p", "id % 5000 as k", "if(id % 10 = 0, null, concat('v', id % 37)) as s")
    store_sketches(rows.where("p < 3"), ["p"], ["k", "s"], str(tmp_path))
    before = {r["column"]: r for r in distinct_from_sketches(spark, str(tmp_path)).collect()}
    store_sketches(rows.where("p = 3"), ["p"], ["k", "s"], str(tmp_path))
    store_sketches(rows.where("p = 3"), ["p"], ["k", "s"], str(tmp_path))
    got = {r["column"]: r for r in distinct_from_sketches(spark, str(tmp_path)).collect()}
    assert got["k"]["n_distinct"] == pytest.approx(5000, rel=0.03) and got["s"]["n_distinct"] == 37
    assert got["k"]["rows"] == 40_000 and got["s"]["missing"] == 4_000 and before["k"]["rows"] == 30_000
    parts = {r["p"]: r["n_distinct"] for r in distinct_from_sketches(spark, str(tmp_path), ["p"]).where("column = 'k'").collect()}
    assert parts.keys() == {0, 1, 2, 3} and all(n == pytest.approx(1250, rel=0.03) for n in parts.values())
    counted = distinct_from_sketches(spark, str(tmp_path), count_missing=True).where("column = 's'").first()
    assert counted["n_distinct"] == 37 + 4_000


def table(make, *rows):
    return make("p string, q int, v double, n string", *rows)


ROWS = [("a", 1, 1.0, "x"), ("a", 1, 1.0, "x"), ("a", 2, None, None), (None, 1, 2.0, "y"), ("b", None, 3.0, "z")]


def same(spark, make, path, rows):
    like = table(make, *ROWS)
    return key(read_copy(spark, path, ["p", "q"], like).collect()) == key(table(make, *rows).collect() if rows else [])


def test_only_changes_are_copied(spark, make, tmp_path):
    path = str(tmp_path)
    go = lambda rows: tuple(sync_partitions(table(make, *rows) if rows else table(make, *ROWS).limit(0), path, ["p", "q"]).values())
    with pytest.raises(FileNotFoundError):
        same(spark, make, path, ROWS)
    assert go(ROWS) == (4, 0, 0) and same(spark, make, path, ROWS)
    assert go(list(reversed(ROWS))) == (0, 4, 0)
    changed = [*ROWS[:3], (None, 1, 2.5, "y"), ROWS[4]]
    assert go(changed) == (1, 3, 0) and same(spark, make, path, changed)
    assert go(changed[1:]) == (1, 3, 0) and same(spark, make, path, changed[1:])  # one of two equal rows is gone
    assert go(changed[3:]) == (0, 2, 2) and same(spark, make, path, changed[3:])
    assert go(ROWS) == (3, 1, 0) and same(spark, make, path, ROWS)
    assert go([]) == (0, 0, 4) and same(spark, make, path, [])


def test_an_interrupted_copy_goes_on(spark, make, tmp_path, monkeypatch):
    rows = spark.range(60).selectExpr("cast(id % 12 as int) as p", "id as v")
    writer = type(rows.write)
    calls, write = [], writer.parquet

    def stop(self, path, *args, **kwargs):
        if path.endswith("/data"):
            calls.append(path)
            if len(calls) == 3:
                raise RuntimeError("lost")
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(writer, "parquet", stop)
    with pytest.raises(RuntimeError):
        sync_partitions(rows, str(tmp_path), ["p"], at_once=3)
    done = read_copy(spark, str(tmp_path), ["p"], rows).select("p").distinct().count()
    left = sync_partitions(rows, str(tmp_path), ["p"], at_once=3)
    assert left["copied"] == 12 - done and left["kept"] == done > 0
    assert key(read_copy(spark, str(tmp_path), ["p"], rows).collect()) == key(rows.collect())
