"""Pseudo-random columns from hashed row keys: the same values on every run and partitioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.scalars import stable_hash, stable_uniform


def uniform_column(key: Sequence[Column | str], low: float, high: float, seed: int) -> Column:
    return F.lit(float(low)) + stable_uniform(*key, seed=seed) * F.lit(float(high - low))


def integer_column(key: Sequence[Column | str], low: int, high: int, seed: int) -> Column:
    """Whole numbers from ``low`` up to but not including ``high``."""
    return F.lit(low) + stable_hash(*key, seed=seed) % F.lit(high - low)


def choice_column(key: Sequence[Column | str], values: Sequence[str], seed: int) -> Column:
    at = (stable_hash(*key, seed=seed) % len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), at + 1)


def add_uniforms(df: DataFrame, key: Sequence[str], ranges: Mapping[str, tuple[float, float]], seed: int = 0) -> DataFrame:
    return df.withColumns({n: uniform_column(key, a, b, seed + i) for i, (n, (a, b)) in enumerate(ranges.items())})


def synthetic_uniform(spark: SparkSession, rows: int, ranges: Mapping[str, tuple[float, float]], seed: int = 0) -> DataFrame:
    """A table of ``rows`` rows, made in parallel."""
    return add_uniforms(spark.range(rows), ["id"], ranges, seed)


def synthetic_classes(df: DataFrame, key: Sequence[str], features: int, seed: int = 0) -> DataFrame:
    """Features centred at -1 or +1 by a random 0/1 target, for trying out classifiers."""
    target = stable_hash(*key, seed=seed) % 2
    shift = target * 2 - 1
    cols = {f"x{i}": shift + uniform_column(key, -2, 2, seed + 1 + i) for i in range(features)}
    return df.withColumns({"target": target, **cols})
