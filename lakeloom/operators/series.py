"""Monthly resampling, backfill, running metrics and seasonal forecasts of many series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakeloom.functions.scalars import as_col
from lakeloom.operators.ordering import ROWS_PER_CUT, numbered, running


def resample_month(df: DataFrame, keys: Sequence[str], ts: str, value: Column | str, name: str = "value") -> DataFrame:
    """Month-start mean per series; months without rows are kept as missing."""
    month = F.trunc(F.col(ts), "month")
    monthly = df.groupBy(*keys, month.alias("month")).agg(F.avg(as_col(value)).alias(name))
    # from here on there is one row per series and month: each fills the gap up to the next one
    following = F.lead("month").over(W.partitionBy(*keys).orderBy("month"))
    gap = monthly.withColumn("__until", F.coalesce(F.add_months(following, -1), F.col("month")))
    filled = gap.select(*keys, "month", name, F.explode(F.expr("sequence(month, __until, interval 1 month)")).alias("__m"))
    return filled.select(
        *keys, F.col("__m").alias("month"), F.when(F.col("__m") == F.col("month"), F.col(name)).alias(name)
    )


def backfill(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Fill a missing value from the next known one of a resampled (short) series."""
    w = W.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(w))


def running_mean(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], position: Column, value: Column | str,
    name: str = "running_mean", rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Mean of the values so far, per key."""
    out = running(df, keys, order, position, {"__s": as_col(value), "__n": F.lit(1).cast("long")}, rows_per_cut=rows_per_cut)
    return out.withColumn(name, F.col("__s") / F.col("__n")).drop("__s", "__n")


def batch_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], position: Column, size: int,
    name: str = "batch", rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Every ``size`` consecutive rows of a key form one batch, counted from 0."""
    out = numbered(df, keys, order, position, "__rn", rows_per_cut=rows_per_cut)
    return out.withColumn(name, F.floor((F.col("__rn") - 1) / size)).drop("__rn")


def regret(p_selected: Column | str, p_available: Sequence[Column | str]) -> Column:
    """Best probability on offer less the chosen one, per impression row."""
    best = [as_col(p) for p in p_available]
    top = F.greatest(*best) if len(best) > 1 else best[0]
    return top - as_col(p_selected)


def select_best(
    df: DataFrame, keys: Sequence[str], score: str, position: str, item: str, name: str = "best", floor: float = 0.0
) -> DataFrame:
    """Item with the highest score of each key; the last listed one wins a tie.

    Scores below ``floor`` never win; a key without any other score has no best item.
    """
    best = F.max(F.when(F.col(score) >= floor, F.struct(score, position, item))).alias("b")
    return df.groupBy(*keys).agg(best).select(*keys, F.col(f"b.{item}").alias(name))


def seasonal_naive(df: DataFrame, keys: Sequence[str], month: str, value: str, steps: int, season: int = 12) -> DataFrame:
    """Each future month repeats the same month of the last full season."""
    last = F.max(month).over(W.partitionBy(*keys))
    tail = df.withColumn("__last", last).filter(F.months_between("__last", month) < season)
    reps = -(-steps // season)
    ahead = tail.select(
        *keys, "__last", F.explode(F.transform(F.sequence(F.lit(1), F.lit(reps)), lambda r: r * season)).alias("__by"),
        F.col(month).alias("__m"), F.col(value).alias("forecast"),
    )
    out = ahead.select(*keys, F.add_months("__m", F.col("__by")).alias(month), "forecast", "__last")
    return out.filter(F.months_between(month, "__last") <= steps).drop("__last")


def forecast_grid(
    df: DataFrame, keys: Mapping[str, str], month: str, value: str, steps: int, season: int = 12,
    grid: Sequence[tuple[float, float]] = tuple((a, g) for a in (0.1, 0.3, 0.5, 0.8) for g in (0.1, 0.3, 0.5, 0.8)),
) -> DataFrame:
    """Additive seasonal smoothing per series; the grid point with the lowest one-step error (of equal ones the first)
    forecasts.

    The recurrence is a fold over the series in order of its months, with the level, the seasonal terms and the sum of
    squared errors as its state; each grid point of a series is a row of its own. A series is a short monthly vector (a few
    hundred points), so the many series spread over the tasks. Missing values count as the series' mean; a series without
    known values has no forecast. Returns keys, month, forecast, lower, upper (1.96 residual deviations) and the error
    (mean square) of the best point.
    """
    names = list(keys)
    point = F.struct(F.col(month).cast("date").alias("m"), F.col(value).cast("double").alias("v"))
    series = df.groupBy(*names).agg(F.array_sort(F.collect_list(point)).alias("__s"))
    raw = F.transform("__s", lambda p: F.when(~F.isnan(p["v"]), p["v"]))
    known = F.filter(raw, lambda v: v.isNotNull())
    whole = series.select(*names, F.element_at("__s", -1)["m"].alias("__last"), raw.alias("__raw"), known.alias("__known")).where(F.size("__known") > 0)
    mean = _total("__known") / F.size("__known")
    ready = whole.withColumn("__mean", mean).select(*names, "__last", F.transform("__raw", lambda v: F.coalesce(v, F.col("__mean"))).alias("__y"))
    ready = ready.withColumn("__level", _total(F.slice("__y", 1, season)) / F.least(F.size("__y"), F.lit(season)))
    points = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(a)).alias("a"), F.lit(float(g)).alias("g")) for i, (a, g) in enumerate(grid)])
    fitted = ready.withColumn("__g", F.explode(points)).withColumn("__f", _smoothed(season))
    error = F.when(F.col("__f.n") > 0, F.col("__f.squares") / F.col("__f.n")).otherwise(F.lit(0.0))
    best = fitted.groupBy(*names).agg(F.min(F.struct(error.alias("error"), F.col("__g.i").alias("i"), F.col("__f.level").alias("level"), F.col("__f.seasonal").alias("seasonal"), F.size("__y").alias("size"), F.col("__last").alias("last"))).alias("__b"))
    ahead = best.select(*names, "__b.*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("__k"))
    forecast = F.col("level") + F.get("seasonal", (F.col("size") + F.col("__k") - 1) % season)
    spread = F.lit(1.96) * F.sqrt("error")
    return ahead.select(*names, F.add_months("last", F.col("__k")).alias(month), forecast.alias("forecast"), (forecast - spread).alias("lower"), (forecast + spread).alias("upper"), "error")


def _total(values: Column | str) -> Column:
    """Sum of an array from its first element on."""
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def _smoothed(season: int) -> Column:
    """The fold of one series (``__y``, ``__level``) for one grid point (``__g``)."""
    y, a, g = F.col("__y"), F.col("__g.a"), F.col("__g.g")
    first = F.transform(F.sequence(F.lit(0), F.lit(season - 1)), lambda i: F.when(i < F.size(y), F.get(y, i) - F.col("__level")).otherwise(F.lit(0.0)))
    start = F.struct(F.col("__level").alias("level"), first.alias("seasonal"), F.lit(0.0).alias("squares"), F.lit(0).alias("n"))
    later = F.when(F.size(y) > season, F.sequence(F.lit(season), F.size(y) - 1)).otherwise(F.array().cast("array<int>"))

    def step(state: Column, i: Column) -> Column:
        s = F.get(state["seasonal"], i % season)
        level = a * (F.get(y, i) - s) + (1 - a) * state["level"]
        missed = F.get(y, i) - (state["level"] + s)
        seasonal = F.transform(state["seasonal"], lambda old, j: F.when(j == i % season, g * (F.get(y, i) - level) + (1 - g) * s).otherwise(old))
        return F.struct(level.alias("level"), seasonal.alias("seasonal"), (state["squares"] + missed * missed).alias("squares"), (state["n"] + 1).alias("n"))

    return F.aggregate(later, start, step)
