import random
import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeloom.functions.scalars import match_probability
from lakeloom.operators import series as S


def got(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def day(y, m, d=1):
    return dt.date(y, m, d)


def test_resample_keeps_empty_months_and_backfill_fills_them(make):
    df = make("k string, d date, v double", ("a", day(2020, 1, 3), 1.0), ("a", day(2020, 1, 9), 3.0), ("a", day(2020, 4, 1), 9.0), ("b", day(2020, 2, 2), 5.0))
    monthly = S.resample_month(df, ["k"], "d", "v")
    assert sorted(got(monthly, "k", "month", "value"), key=str) == sorted(
        [("a", day(2020, 1), 2.0), ("a", day(2020, 2), None), ("a", day(2020, 3), None), ("a", day(2020, 4), 9.0), ("b", day(2020, 2), 5.0)], key=str
    )
    filled = S.backfill(monthly, ["k"], "month", "value")
    assert sorted(got(filled, "k", "value")) == [("a", 2.0), ("a", 9.0), ("a", 9.0), ("a", 9.0), ("b", 5.0)]


def test_running_mean_and_batches(make):
    df = make("k string, i int, click int", ("a", 1, 1), ("a", 2, 0), ("a", 3, 1), ("b", 1, 0))
    out = S.running_mean(df, ["k"], ["i"], F.col("i"), "click")
    assert sorted(got(out, "k", "i", "running_mean")) == [("a", 1, 1.0), ("a", 2, 0.5), ("a", 3, pytest.approx(2 / 3)), ("b", 1, 0.0)]
    assert sorted(got(S.batch_number(df, ["k"], ["i"], F.col("i"), 2), "k", "i", "batch")) == [("a", 1, 0), ("a", 2, 0), ("a", 3, 1), ("b", 1, 0)]


def test_regret(make):
    # levels: hs-grad 3, graduate 5; probabilities 0.4 and 0.8 on offer, the better one chosen
    df = make("p double, a double, b double", (0.8, 0.4, 0.8), (0.4, 0.4, 0.8))
    assert [round(r[0], 6) for r in df.select(S.regret("p", ["a", "b"])).collect()] == [0.0, 0.4]
    grid = make("x int, y int", (3, 5)).select(F.round(match_probability("x", "y"), 6))
    assert got(grid) == [(0.35,)]


def test_last_of_ties_is_selected(make):
    df = make("i int, ad string, pos int, score double", (1, "a", 0, 0.5), (1, "b", 1, 0.7), (1, "c", 2, 0.7), (2, "d", 0, 0.0), (3, "e", 0, -0.1))
    assert sorted(got(S.select_best(df, ["i"], "score", "pos", "ad")), key=str) == [(1, "c"), (2, "d"), (3, None)]


def test_seasonal_naive_repeats_the_last_year(make):
    months = [(day(2020 + i // 12, i % 12 + 1), float(i)) for i in range(30)]
    df = make("k string, month date, value double", *[("a", m, v) for m, v in months])
    out = dict(got(S.seasonal_naive(df, ["k"], "month", "value", 15).orderBy("month"), "month", "forecast"))
    assert len(out) == 15 and min(out) == day(2022, 7)
    assert out[day(2022, 7)] == 18.0 and out[day(2023, 7)] == 18.0 and out[day(2023, 6)] == 29.0


def test_forecast_grid_follows_a_clean_season(make):
    months = [(day(2015 + i // 12, i % 12 + 1), 100.0 + (i % 12)) for i in range(72)]
    df = make("k string, month date, value double", *[("a", m, v) for m, v in months], ("b", day(2020, 1), None))
    out = S.forecast_grid(df, {"k": "string"}, "month", "value", 24).orderBy("month").collect()
    assert len(out) == 24 and out[0]["month"] == day(2021, 1)
    for i, r in enumerate(out):
        assert r["forecast"] == pytest.approx(100 + i % 12, abs=1e-6) and r["lower"] <= r["forecast"] <= r["upper"]


def smoothed(y, alpha, gamma, season):
    """One grid point step by step."""
    level = sum(y[:season]) / len(y[:season])
    terms = [v - level for v in y[:season]] + [0.0] * (season - len(y))
    missed = []
    for i in range(season, len(y)):
        s = terms[i % season]
        missed.append(y[i] - (level + s))
        level = alpha * (y[i] - s) + (1 - alpha) * level
        terms[i % season] = gamma * (y[i] - level) + (1 - gamma) * s
    return (sum(m * m for m in missed) / len(missed) if missed else 0.0), level, terms


def test_forecast_grid_is_the_recurrence(make):
    rng = random.Random(8)
    data = {"a": [rng.uniform(1, 9) for _ in range(31)], "b": [5.0, None, 7.0], None: [float(i % 4) for i in range(9)], "void": [None, float("nan")]}
    months = [(k, dt.date(2020 + i // 12, i % 12 + 1, 1), v) for k, vs in data.items() for i, v in enumerate(vs)]
    rng.shuffle(months)
    grid = ((0.2, 0.4), (0.9, 0.1), (0.5, 0.5))
    got = {}
    for r in S.forecast_grid(make("k string, month date, value double", *months), {"k": "string"}, "month", "value", 7, season=4, grid=grid).collect():
        got.setdefault(r["k"], []).append(r)
    assert got.keys() == {"a", "b", None}
    for k, rows in got.items():
        known = [v for v in data[k] if v is not None]
        y = [sum(known) / len(known) if v is None else v for v in data[k]]
        error, level, terms = min((smoothed(y, a, g, 4) for a, g in grid), key=lambda r: r[0])
        rows.sort(key=lambda r: r["month"])
        assert [r["forecast"] for r in rows] == pytest.approx([level + terms[(len(y) + i) % 4] for i in range(7)])
        assert rows[0]["error"] == pytest.approx(error) and rows[0]["upper"] - rows[0]["lower"] == pytest.approx(2 * 1.96 * error**0.5)
        assert (rows[0]["month"].year * 12 + rows[0]["month"].month) - 2020 * 12 - 1 == len(y)
