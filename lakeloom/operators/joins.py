"""Left-join folds, outer, natural, null-safe and anti joins.

No side is broadcast by hand: Spark compares measured sizes with ``spark.sql.autoBroadcastJoinThreshold``
at run time, and splits hot partitions of the large side (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on, "left")


def left_join_all(first: DataFrame, others: Sequence[tuple[DataFrame, str | Sequence[str]]]) -> DataFrame:
    """Fold of left joins, each table with its own key."""
    for table, key in others:
        first = first.join(table, key, "left")
    return first


def left_join_on(tables: Sequence[DataFrame], key: str) -> DataFrame:
    return left_join_all(tables[0], [(t, key) for t in tables[1:]])


def left_join_many(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join whose right side may hold a hot key.

    Spark can neither broadcast the left side of a left join nor split a hot right partition. An inner join
    allows both, so matched rows come from one, and unmatched left rows are added from an anti join against
    the distinct keys.
    """
    matched = left.join(right, on, "inner")
    keys = right.select(on).filter(F.col(on).isNotNull()).distinct()
    alone = left.join(keys, on, "left_anti")
    filled = alone.select(
        *left.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name != on]
    )
    return matched.select(*filled.columns).unionByName(filled)


def broadcast_small(df: DataFrame, max_rows: int = 8_192) -> DataFrame:
    """The table marked for broadcast when it has at most ``max_rows`` rows, otherwise as it was.

    The rows are counted from a kept copy of at most ``max_rows + 1`` rows, so they are computed once. The
    default holds for rows of up to a 1,536-d vector (100 MB).
    """
    kept = df.limit(max_rows + 1).persist()
    if kept.count() <= max_rows:
        return F.broadcast(kept)
    kept.unpersist()
    return df


def optional_left_join(left: DataFrame, right: DataFrame | None, on: str | Sequence[str]) -> DataFrame:
    return left if right is None else left.join(right, on, "left")


def full_outer_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Same key name: one key column. Different names: both are kept, empty where unmatched."""
    if left_key == right_key:
        return left.join(right, left_key, "full")
    return left.join(right, left[left_key] == right[right_key], "full")


def natural_inner_join(left: DataFrame, right: DataFrame) -> DataFrame:
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    return left.join(right, shared, "inner")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join where a missing key matches a missing key."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    joined = left.join(renamed, match, how)
    if how in ("right", "full", "full_outer", "right_outer"):
        joined = joined.withColumns({k: F.coalesce(F.col(k), F.col(f"__r_{k}")) for k in keys})
    return joined.drop(*[f"__r_{k}" for k in keys])


def anti_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on, "left_anti")


def expand_grid(df: DataFrame, **lists: Sequence[object]) -> DataFrame:
    """Every row with every combination of the given short literal lists (parameter grids)."""
    for name, values in lists.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def lookup_all(df: DataFrame, lookups: Sequence[tuple[DataFrame, str]], keep: Sequence[Column | str] | None = None) -> DataFrame:
    """Enrich from lookup tables, then keep the wanted columns."""
    out = left_join_all(df, lookups)
    return out.select(*keep) if keep else out
