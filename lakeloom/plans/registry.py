"""Registry of queries over the supplied tables, each with its DuckDB statement where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """Lazy parquet tables of one data folder: ``t.orders``, ``t.lineitem`` and so on."""

    spark: SparkSession
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with its SQL twin."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def near(c: Column | str, places: int = 6) -> Column:
    """Rounded half up with a hair's breadth of tolerance, so that both engines agree on exact halves."""
    c = F.col(c) if isinstance(c, str) else c
    unit = float(10**places)
    return F.floor(c * F.lit(unit) + F.lit(0.5001)).cast("double") / F.lit(unit)


def near_sql(expression: str, places: int = 6) -> str:
    unit = 10**places
    return f"(CAST(floor(({expression}) * {unit}e0 + 0.5001e0) AS DOUBLE) / {unit}e0)"


def near_all(df: DataFrame, places: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """All double columns rounded by ``near``."""
    return df.withColumns({n: near(n, places) for n, k in df.dtypes if k == "double" and n not in skip})


def hash_sql(*keys: str, seed: int = 0) -> str:
    """SQL twin of ``stable_hash``."""
    text = " || '|' || ".join([f"'{seed}'", *keys])
    return f"CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT)"


def train_sql(*keys: str, seed: int = 0, fraction: float = 0.8) -> str:
    """SQL twin of ``split_random``."""
    return f"({hash_sql(*keys, seed=seed)} < {int(fraction * 2**48)})"
