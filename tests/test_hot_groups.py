"""The paths for groups too large for one task give the same results as the plain ones and as brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import features
from lakeloom.operators import ordering as O
from lakeloom.operators.evaluation import pr_curve, roc_auc, roc_curve
from lakeloom.operators.features import group_features


def got(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


@pytest.fixture(scope="module")
def table(spark):
    """Half of the rows belong to one key, some to no key; positions repeat."""
    rng = random.Random(7)
    rows = []
    for i in range(2000):
        key = "hot" if i % 2 else rng.choice(["a", "b", "c", None])
        rows.append((i, key, rng.randrange(60), rng.choice([None, 1.5, 2.0, -3.25, rng.random()]), rng.choice(["x", "y", "z", None])))
    return spark.createDataFrame(rows, "id int, k string, pos int, v double, s string").cache()


@pytest.mark.parametrize("rows_per_cut", [10_000, 300, 40])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running_sum(table, keys, rows_per_cut):
    df = table.withColumn("v", F.col("v").cast("decimal(20,10)"))
    out = O.running(df, keys, ["pos", "id"], F.col("pos"), {"total": "v"}, rows_per_cut=rows_per_cut)
    pdf = df.toPandas().sort_values(["pos", "id"])
    pdf["v"] = pdf["v"].astype(float)
    filled = pdf.assign(v=pdf["v"].fillna(0.0), seen=pdf["v"].notna())
    group = [pdf["k"].fillna("-")] if keys else [pd.Series(0, index=pdf.index)]
    total = filled.groupby(group)["v"].cumsum().where(filled.groupby(group)["seen"].cummax())
    want = dict(zip(pdf["id"], total))
    assert out.columns == [*df.columns, "total"]
    for r in out.collect():
        w = want[r["id"]]
        assert (r["total"] is None) == bool(np.isnan(w)) and (r["total"] is None or float(r["total"]) == pytest.approx(w))


@pytest.mark.parametrize("keys", [["k"], []])
def test_numbers_have_no_gaps(table, keys):
    out = O.numbered(table, keys, ["pos", "id"], F.col("pos"), rows_per_cut=100)
    plain = O.numbered(table, keys, ["pos", "id"], F.col("pos"))
    assert got(out) == got(plain)
    if not keys:
        assert sorted(r["row_id"] for r in out.collect()) == list(range(1, 2001))


@pytest.mark.parametrize("rows_per_cut", [300, 40])
def test_next_known(table, rows_per_cut):
    cut = O.next_known(table, ["k"], ["pos", "id"], F.col("pos"), "v", "n", rows_per_cut=rows_per_cut)
    plain = O.next_known(table, ["k"], ["pos", "id"], F.col("pos"), "v", "n")
    assert got(cut) == got(plain)
    pdf = table.toPandas().sort_values(["pos", "id"])
    want = pdf.groupby(pdf["k"].fillna("-"))["v"].bfill()
    want = dict(zip(pdf["id"], want))
    for r in plain.collect():
        assert r["n"] == pytest.approx(want[r["id"]]) if r["n"] is not None else np.isnan(want[r["id"]])


MEASURES = {
    "n_ids": ("nunique", "id"), "n_v": ("nunique", "v"), "ids": ("sum", "id"), "mid": ("median", "v"), "lo": ("q1", "v"), "hi": ("q3", "v"),
    "mid_pos": ("median", "pos"), "common": ("mode", "s"), "common_pos": ("mode", "pos"),
}


@pytest.mark.parametrize("hot_rows,rows_per_cut", [(600, 10_000), (600, 100), (0, 37)])
def test_group_features(table, hot_rows, rows_per_cut):
    plain = group_features(table, "k", MEASURES)
    spread = group_features(table, "k", MEASURES, hot_rows=hot_rows, rows_per_cut=rows_per_cut)
    assert spread.columns == plain.columns == ["k", *MEASURES]
    for a, b in zip(got(plain), got(spread)):
        assert a == pytest.approx(b, nan_ok=True)


def test_plain_group_features_against_pandas(table):
    pdf = table.toPandas()
    for r in group_features(table, "k", MEASURES).collect():
        g = pdf[pdf["k"].isna() if r["k"] is None else pdf["k"] == r["k"]]
        assert r["n_ids"] == g["id"].nunique() and r["ids"] == g["id"].sum()
        assert r["n_v"] == g["v"].nunique() + g["v"].isna().sum()
        for name, q in (("lo", 0.25), ("mid", 0.5), ("hi", 0.75)):
            assert r[name] == pytest.approx(g["v"].quantile(q))
        assert r["common"] == g["s"].mode()[0] and r["common_pos"] == g["pos"].mode()[0]


def test_curves_in_parts(spark):
    rng = random.Random(3)
    data = [(round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(1500)]
    df = spark.createDataFrame(data, "s double, y int")
    for curve in (roc_curve, pr_curve):
        assert got(curve(df, "s", "y")) == got(curve(df, "s", "y", rows_per_cut=10))
    pos = [s for s, y in data if y]
    neg = [s for s, y in data if not y]
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    for cut in (10, 10_000):
        assert roc_auc(df, "s", "y", rows_per_cut=cut).first()["auc"] == pytest.approx(pairs / len(pos) / len(neg))


def test_assembly_of_a_hot_device(spark):
    from lakeloom.streaming.messages import TAGS, assemble_batch

    rng = random.Random(5)
    rows = [(i, "hot" if i % 3 else "cold", rng.choice([*TAGS, "other"]), rng.choice([0.0, 1.0, 2.5]), str(i)) for i in range(1200)]
    df = spark.createDataFrame(rows, "i int, d string, tag string, v double, at string")
    names = dict(zip(TAGS, range(4)))
    want = []
    for device in ("hot", "cold"):
        record = [0.0] * 4
        for i, d, tag, v, at in rows:
            if d != device or tag not in names:
                continue
            record[names[tag]] = v
            if tag == TAGS[-1]:
                if all(x > 0 for x in record):
                    want.append((device, *record, at))
                record = [0.0] * 4
    for cut in (10_000, 50):
        assert got(assemble_batch(df, "d", ["i"], F.col("i"), "tag", "v", "at", rows_per_cut=cut)) == sorted(want, key=str)


NUMBERS = {"mid": ("median", "v"), "lo": ("q1", "v"), "hi": ("q3", "v"), "mid_pos": ("median", "pos"), "ids": ("sum", "id")}


@pytest.mark.parametrize("hot_rows,rows_per_cut", [(600, 10_000), (600, 20), (0, 37)])
def test_quantiles_selected_between_brackets(table, hot_rows, rows_per_cut):
    plain, spread = group_features(table, "k", NUMBERS), group_features(table, "k", NUMBERS, hot_rows=hot_rows, rows_per_cut=rows_per_cut)
    for a, b in zip(got(plain), got(spread)):
        assert a == pytest.approx(b, nan_ok=True)


@pytest.mark.parametrize("ends", [[0.0] * 6, [1e9] * 6, [-1e9, -1e9, 1e9, 1e9, 1e9, 1e9]])
def test_brackets_that_miss(table, monkeypatch, ends):
    monkeypatch.setattr(features, "_brackets", lambda df, columns, hot: [F.max(F.array(*[F.lit(e) for e in ends])).alias(f"__b_{c}") for c in columns])
    for a, b in zip(got(group_features(table, "k", NUMBERS)), got(group_features(table, "k", NUMBERS, hot_rows=600))):
        assert a == pytest.approx(b, nan_ok=True)


def test_few_values_reach_the_sort(spark):
    df = spark.range(200_000).selectExpr("id % 2 as k", "cast(hash(id) as double) as v")
    ends = df.groupBy("k").agg(*features._brackets(df, ["v"], 100_000))
    inside = df.join(ends, "k").filter(features._zone(F.col("v"), F.col("__b_v"))[1].isNotNull()).count()
    assert inside < 200_000 * 3 * 4 * 3 / 10_000
