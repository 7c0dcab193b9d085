from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import joins as J
from lakeloom.operators import rows as R
from lakeloom.operators import summaries as S


def got(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def test_dropna_and_sort(make):
    df = make("weight double, tin string", (None, "oats"), (0.0, "rye"), (7.5, None), (None, None))
    assert got(R.dropna_subset(df, "weight"), "tin") == [("rye",), (None,)]
    ships = make("berth int, ship string", (40, "kite"), (7, "wren"), (None, "tern"), (12, "rook"), (7, "lark"))
    assert got(R.top_k(ships, [F.col("berth").asc_nulls_last(), F.col("ship")], 4), "ship") == [("lark",), ("wren",), ("rook",), ("kite",)]


def test_sentinel(make):
    df = make("a string, n int", ("?", 1), ("x", None), ("y", 2))
    assert got(R.sentinel_dropna(df)) == [("y", 2)]


def test_filter_gt_reads_text(make):
    df = make("depth string, lake string", ("3.25", "Ohre"), ("", "Lom"), ("3", "Sazava"), (None, "Ub"), ("deep", "Rak"), ("1e2", "Vir"))
    assert got(R.filter_gt(df, "depth", 3), "lake") == [("Ohre",), ("Vir",)]


def test_drop_allnull(make):
    assert R.drop_allnull_columns(make("a int, b int", (1, None), (None, None))).columns == ["a"]


def test_keep_first_and_top(make):
    df = make("k string, o int, v string", ("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"))
    assert sorted(got(R.keep_first(df, ["k"], ["o"]))) == [("a", 1, "y"), ("b", 5, "z")]
    assert sorted(got(R.top_per_group(df, ["k"], [F.desc("o")], 1), "k", "v")) == [("a", "x"), ("b", "z")]


def test_mask_split_covers_everything(make):
    df = make("y boolean, t boolean, i int", (True, True, 1), (False, True, 2), (None, False, 3), (True, False, 4))
    parts = R.mask_split(df, F.col("y"), F.col("t"))
    assert {n: [r[0] for r in p.select("i").collect()] for n, p in parts.items()} == {
        "train_normal": [1], "train_other": [2], "test_normal": [4], "test_other": [3],
    }
    marked = R.mask_parts(df, F.col("y"), F.col("t"))
    assert {r["i"]: r["part"] for r in marked.collect()} == {1: "train_normal", 2: "train_other", 3: "test_other", 4: "test_normal"}


def test_date_slice(make):
    df = make("d string", ("1997-12-31",), ("1998-01-01",)).withColumn("d", F.col("d").cast("timestamp"))
    assert R.date_slice(df, "d", date(1998, 1, 1)).count() == 1


def test_sample_is_repeatable(spark):
    a = R.sample_rows(spark.range(500), ["id"], 20, 1)
    b = R.sample_rows(spark.range(500).repartition(9), ["id"], 20, 1)
    assert sorted(got(a)) == sorted(got(b)) and a.count() == 20


def test_split_random_share(spark):
    df = R.split_random(spark.range(10_000), ["id"], 0.8)
    share = df.agg(F.avg(F.col("is_train").cast("int"))).first()[0]
    assert 0.78 < share < 0.82


@pytest.mark.parametrize("slots,hot_rows", [(1, 0), (8, 500), (4096, 1500), (4096, 10_000)])
def test_split_stratified_is_exact_with_a_hot_stratum(spark, slots, hot_rows):
    df = spark.range(3000).withColumn("s", F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2995, "mid").when(F.col("id") < 2999, "few"))
    out = R.split_stratified(df, "s", ["id"], 0.9, slots=slots, hot_rows=hot_rows)
    assert out.count() == 3000
    sizes = {r["s"]: (r["n"], r["k"]) for r in out.groupBy("s").agg(F.count("id").alias("n"), F.count_if("is_train").alias("k")).collect()}
    assert sizes == {"hot": (2000, 1800), "mid": (995, 896), "few": (4, 4), None: (1, 1)}
    plain = R.split_stratified(df, "s", ["id"], 0.9)
    assert out.exceptAll(plain).count() == 0


def test_unpivot_and_pivot(make):
    wide = make("id int, a double, b double", (1, 1.0, None))
    assert got(R.unpivot_measures(wide, ["id"], ["a", "b"], "m", "v")) == [(1, "a", 1.0)]
    tags = make("k int, tag string, v double, o int", (1, "x", 1.0, 1), (1, "x", 2.0, 2), (1, "y", 3.0, 1), (1, "z", 9.0, 1))
    assert got(R.pivot_latest(tags, ["k"], "tag", "v", ["o"], ["x", "y"])) == [(1, 2.0, 3.0)]


# --- joins -----------------------------------------------------------------------------------------------


def test_left_join_all(make):
    a, b, c = (make(f"key int, val{i} string", (1, f"a{i}"), (2, f"b{i}")) for i in (1, 2, 3))
    out = J.left_join_all(a, [(b, "key"), (c, "key")])
    assert out.columns == ["key", "val1", "val2", "val3"] and sorted(got(out))[0] == (1, "a1", "a2", "a3")
    assert sorted(got(J.left_join_on([a, b, c], "key"))) == sorted(got(out))


def test_left_join_many_equals_left_join(make):
    left = make("k int, a string", (1, "x"), (1, "y"), (2, "z"), (None, "n"), (7, "q"))
    right = make("k int, b int", (1, 10), (1, 11), (3, 12), (None, 13), (7, None))
    want, out = left.join(right, "k", "left"), J.left_join_many(left, right, "k")
    assert out.columns == want.columns and sorted(got(out), key=str) == sorted(got(want), key=str)


def test_broadcast_small(make, spark):
    small = J.broadcast_small(make("k int", (1,), (2,)), 2)
    assert "BroadcastExchange" in spark.range(5).join(small, F.col("id") == F.col("k"))._jdf.queryExecution().executedPlan().toString()
    assert J.broadcast_small(spark.range(10), 3).count() == 10


def test_outer_joins(make):
    a, b = make("x int, p int", (1, 1), (2, 2)), make("y int, q int", (2, 5), (3, 6))
    out = J.full_outer_join(a, b, "x", "y")
    assert sorted(got(out), key=str) == sorted([(1, 1, None, None), (2, 2, 2, 5), (None, None, 3, 6)], key=str)
    same = J.full_outer_join(a, b.withColumnRenamed("y", "x"), "x", "x")
    assert sorted(got(same)) == [(1, 1, None), (2, 2, 5), (3, None, 6)] or len(got(same)) == 3


def test_natural_optional_anti(make):
    a, b = make("name string, f double", ("x", 1.0), ("y", 2.0)), make("name string, b int", ("x", 1))
    assert got(J.natural_inner_join(a, b)) == [("x", 1.0, 1)]
    with pytest.raises(ValueError):
        J.natural_inner_join(a, make("z int", (1,)))
    assert J.optional_left_join(a, None, "name") is a
    assert J.optional_left_join(a, b, "name").columns == ["name", "f", "b"]
    assert got(J.anti_join(a, b, "name")) == [("y", 2.0)]


def test_null_keys_match(make):
    a, b = make("k string, v int", ("x", 1), (None, 2)), make("k string, w int", (None, 9))
    assert sorted(got(J.null_safe_join(a, b, ["k"])), key=str) == sorted([("x", 1, None), (None, 2, 9)], key=str)
    assert len(got(J.left_join(a, b, "k").filter("w is not null"))) == 0


def test_grid(make):
    assert J.expand_grid(make("a int", (1,), (2,)), p=[0, 1], q=[0.1, 0.2, 0.3]).count() == 12


# --- summaries -------------------------------------------------------------------------------------------


def test_moments_both_forms(make):
    df = make("a double", (1.0,), (2.0,), (3.0,), (None,))
    assert got(S.moments(df, ["a"])) == [("a", 3, 2.0, 1.0, 1.0, 3.0)]
    assert S.moments(df, ["a"], population=True).first()["std"] == pytest.approx((2 / 3) ** 0.5)


def test_groups_below(make):
    df = make("region string, x int, y int", ("EU", 1, 1), ("EU", 2, None), ("NA", 1, 2), ("NA", 3, 4))
    assert got(S.groups_below(df, "region", ["x", "y"], 2)) == [("EU", 2, 1)]


def test_histogram_counts_everything(make):
    df = make("v double", *[(float(i),) for i in range(31)], (None,))
    out = got(S.histogram(df, "v", 30).orderBy("bin"))
    assert len(out) == 30 and sum(n for _, n in out) == 31 and out[29] == (29, 2)
    flat = got(S.histogram(make("v double", (2.0,), (2.0,)), "v", 4))
    assert sum(n for _, n in flat) == 2


def test_profile_and_patterns(make):
    df = make("a int, b string", (1, "x"), (None, "x"), (3, None), (None, None))
    rows = {r["column"]: r for r in S.profile_table(df, True).collect()}
    assert rows["a"]["n_missing"] == 2 and rows["a"]["mean"] == 2.0 and rows["b"]["n_distinct"] == 1
    assert sorted(got(S.missing_patterns(df, ["a", "b"]))) == [("00", 1), ("01", 1), ("10", 1), ("11", 1)]


def test_best_and_runs(make):
    trials = make("g int, name string, loss double", (1, "a", 0.5), (1, "b", 0.2), (1, "c", 0.2), (1, "d", None))
    assert got(S.best_by(trials, ["g"], "name", "loss")) == [(1, "b")]
    assert got(S.best_by(trials, ["g"], "name", "loss", smallest=False)) == [(1, "a")]
    runs = make("run_id string, status string", ("1", "FAILED"), ("2", "OK"), ("3", "OK"))
    failed = F.col("status") == "FAILED"
    assert sorted(got(S.run_summary(runs, failed))) == [(3, "failed", 1), (3, "passed", 2)]
    records = got(S.run_records(runs, failed, {"run_id": F.col("run_id"), "end_time": F.lit(None)}))
    assert records[0] == ("failed", '{"run_id":"1","end_time":"None"}')


def test_correlations(make):
    df = make("a double, b double", (1.0, 2.0), (2.0, 4.0), (3.0, 7.0))
    out = {(r["a"], r["b"]): r["r"] for r in S.corr_matrix(df, ["a", "b"]).collect()}
    assert out[("a", "a")] == pytest.approx(1.0) and out[("a", "b")] == out[("b", "a")] == pytest.approx(0.9933992677987828)
