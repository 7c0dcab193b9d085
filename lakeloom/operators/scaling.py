"""Scaling and imputation with a fitted parameter table that inference can reuse."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def minmax_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - min) / (max - min); a constant column gives 0; missing cells stay missing."""
    stats = _stats(df if fit_on is None else fit_on, columns, lambda c: (F.min(c), F.max(c)))
    return df.withColumns({c: _minmax(F.col(c), F.lit(a), F.lit(b)) for c, (a, b) in stats.items()})


def _minmax(c: Column, lo: Column, hi: Column) -> Column:
    return F.when(hi == lo, c.cast("double") - lo).otherwise((c.cast("double") - lo) / (hi - lo))


def zscore(df: DataFrame, columns: Sequence[str], population: bool = False, fit_on: DataFrame | None = None) -> DataFrame:
    """Centre and divide by the standard deviation; NULL for a constant column with the sample form,
    0 with the population form (a deviation of 0 is read as 1 there)."""
    std = F.stddev_pop if population else F.stddev_samp
    stats = _stats(df if fit_on is None else fit_on, columns, lambda c: (F.avg(c), std(c)))
    out = {}
    for c, (mean, dev) in stats.items():
        if population and dev == 0:
            dev = 1.0
        out[c] = F.try_divide(F.col(c).cast("double") - F.lit(mean), F.lit(dev))
    return df.withColumns(out)


def impute_mean(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    stats = _stats(df if fit_on is None else fit_on, columns, lambda c: (F.avg(c), F.avg(c)))
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, (m, _) in stats.items()})


def _stats(df: DataFrame, columns: Sequence[str], pair) -> dict[str, tuple]:
    """Two numbers per column in one pass: a single row on the driver, whatever the table size."""
    aggs = []
    for i, c in enumerate(columns):
        a, b = pair(c)
        aggs += [a.cast("double").alias(f"a{i}"), b.cast("double").alias(f"b{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(columns)}


@dataclass(frozen=True)
class Preprocessor:
    """Min-max scaling and mean imputation of numbers, mean imputation of category codes."""

    parameters: tuple[tuple[str, str, float | None, float | None, float | None], ...]
    SCHEMA = "column string, kind string, min double, max double, mean double"

    @classmethod
    def fit(cls, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> Preprocessor:
        columns = [*numeric, *categorical]
        row = train.agg(
            *[
                f(c).cast("double").alias(f"{n}{i}")
                for i, c in enumerate(columns)
                for n, f in (("lo", F.min), ("hi", F.max), ("mean", F.avg))
            ]
        ).first()
        return cls(
            tuple(
                (c, "numeric" if c in numeric else "categorical", row[f"lo{i}"], row[f"hi{i}"], row[f"mean{i}"])
                for i, c in enumerate(columns)
            )
        )

    def apply(self, df: DataFrame) -> DataFrame:
        """A column without any value in training stays missing."""
        out = {}
        for c, kind, lo, hi, mean in self.parameters:
            x = F.col(c).cast("double")
            if lo is None:
                out[c] = F.lit(None).cast("double")
            elif kind == "numeric":
                out[c] = _minmax(F.coalesce(x, F.lit(mean)), F.lit(lo), F.lit(hi))
            else:
                out[c] = F.coalesce(x, F.lit(mean))
        return df.withColumns(out)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(list(self.parameters), self.SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        rows = spark.read.schema(cls.SCHEMA).parquet(path).collect()
        return cls(tuple(tuple(r) for r in rows))
