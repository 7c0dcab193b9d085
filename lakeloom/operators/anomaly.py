"""Reconstruction losses, thresholds, flags and the threshold sweep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.scalars import as_col, row_l1

# fixed values: 1.00 to 2.95 in steps of 0.15
SCALARS = tuple(round(1 + 0.15 * i, 2) for i in range(14))


def with_loss(df: DataFrame, xs: Sequence[str], ys: Sequence[str], name: str = "loss") -> DataFrame:
    return df.withColumn(name, row_l1(xs, ys))


def loss_stats(df: DataFrame, loss: Column | str) -> Column:
    """Mean and population deviation of the known losses, as one scalar struct (mean, std)."""
    c = as_col(loss)
    return df.agg(F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias("s")).scalar()


def thresholds(df: DataFrame, loss: str, spreads: Sequence[float] = (0, 1, 3)) -> DataFrame:
    one = df.agg(F.avg(loss).alias("m"), F.stddev_pop(loss).alias("s"))
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(float(k)).alias("spread"), (F.col("m") + F.lit(float(k)) * F.col("s")).alias("threshold"))
                    for k in spreads
                ]
            )
        )
    )


def flag_anomalies(df: DataFrame, loss: str, threshold: Column | float, name: str = "prediction") -> DataFrame:
    """1 for a missing loss or one above the threshold, else 0."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return df.withColumn(name, F.when(F.col(loss).isNull() | (F.col(loss) > t), 1).otherwise(0))


def threshold_sweep(
    train_normal: DataFrame, test: DataFrame, loss: str, is_normal: str, scalars: Sequence[float] = SCALARS
) -> DataFrame:
    """Metrics of "loss below mean + k * std is normal" for every scalar k, in one pass over the test rows.

    The positive class for precision and recall is the normal one. In the four counts the normal class comes
    first: tn = normal kept, fp = normal flagged, fn = other kept, tp = other flagged.
    """
    scalars = sorted(float(k) for k in scalars)
    stats = loss_stats(train_normal, loss)
    rows = test.select(F.col(loss).alias("x"), F.col(is_normal).cast("boolean").alias("y")).withColumn("s", stats)

    def limit(k: Column) -> Column:
        return F.col("s.mean") + k * F.col("s.std")

    # how many limits a loss reaches; a missing loss reaches all. A handful of counts is all that is left then
    reached = F.lit(0)
    for k in scalars:
        reached = reached + F.when(F.col("x") < limit(F.lit(k)), 0).otherwise(1)
    counts = rows.groupBy("y", "s", reached.alias("reached")).agg(F.count(F.lit(1)).alias("n"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k).alias("std_scalar")) for i, k in enumerate(scalars)])
    below = F.col("reached") <= F.col("i")

    def total(hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))

    swept = (
        counts.select("y", "s", "reached", "n", F.inline(steps))
        .groupBy("std_scalar")
        .agg(
            F.max(limit(F.col("std_scalar"))).alias("threshold"),
            total(F.col("y") & below).alias("tn"),
            total(F.col("y") & ~below).alias("fp"),
            total(~F.col("y") & below).alias("fn"),
            total(~F.col("y") & ~below).alias("tp"),
        )
    )
    zero, tn = F.lit(0.0), F.col("tn")
    return swept.select(
        "std_scalar",
        "threshold",
        F.try_divide(tn + F.col("tp"), tn + F.col("fp") + F.col("fn") + F.col("tp")).alias("accuracy"),
        F.coalesce(F.try_divide(tn, tn + F.col("fn")), zero).alias("precision"),
        F.coalesce(F.try_divide(tn, tn + F.col("fp")), zero).alias("recall"),
        "tn", "fp", "fn", "tp",
    )


def threshold_select(sweep: DataFrame, min_tp: int) -> DataFrame:
    """The sweep row with the largest scalar that still catches ``min_tp`` anomalies; no row if none does."""
    whole = F.struct("std_scalar", *[c for c in sweep.columns if c != "std_scalar"])
    return sweep.filter(F.col("tp") >= min_tp).agg(F.max(whole).alias("r")).filter("r IS NOT NULL").select("r.*")
