"""Running totals and ranks that stay parallel when one key holds most of the rows.

A plain window sorts a whole key in one task. That is fine up to ``ROWS_PER_CUT`` rows. Larger keys are cut at
ranges of their order columns, each (key, range) is windowed on its own, and the totals of the earlier ranges
are added. The rows of all other keys go through the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakeloom.functions.scalars import as_col
from lakeloom.session import materialize

ROWS_PER_CUT = 5_000_000
MAX_BROADCAST_KEYS = 500_000
_CUT = "__cut"


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of key columns with their prefixed copies."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys], F.lit(True))


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame | None:
    """Keys with more than ``rows`` rows, their columns prefixed ``__hot_``; None when there are none.

    There are never more than (all rows / rows) of them. They are kept, as several steps ask for them, and
    broadcast when their number allows it.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > rows)
    found = counted.select([F.col(k).alias("__hot_" + k) for k in keys]).persist()
    n = found.count()
    if n == 0:
        found.unpersist()
        return None
    return F.broadcast(found) if n <= MAX_BROADCAST_KEYS else found


def split_hot(df: DataFrame, keys: Sequence[str], rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys and, apart, rows of hot ones (None when there are none)."""
    hot = hot_keys(df, keys, rows)
    if hot is None:
        return df, None
    same = same_keys(keys, "__hot_")
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int, count: int) -> DataFrame:
    """Rows in ranges of about ``rows`` along keys and order, with the range's number; written once, as the numbers must
    stay the same for every step that uses them.

    Spark samples the true sort columns, so text, decimals and equal leading values are cut as well as numbers, and there
    are as many ranges as the rows need. Within a key the numbers rise along the order.
    """
    ranges = math.ceil(count / rows)
    ordered = df.repartitionByRange(ranges, *[F.col(k) for k in keys], *order)
    return materialize(ordered.withColumn(_CUT, F.spark_partition_id()), "ranges")


def _by_size(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows_per_cut: int,
    plain: Callable[[DataFrame], DataFrame], cut: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Send ordinary keys through the plain window and hot ones, in ranges, through the cut one."""
    cool, hot = (None, df) if not keys else split_hot(df, keys, rows_per_cut)
    if hot is None:
        return plain(cool)
    count = hot.count()
    if count <= rows_per_cut:
        return plain(hot) if cool is None else plain(cool).unionByName(plain(hot))
    done = cut(in_ranges(hot, keys, order, rows_per_cut, count))
    return done if cool is None else plain(cool).unionByName(done)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    position: Column | str | None,
    sums: Mapping[str, Column | str],
    *,
    rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Running sums from the first row of each key up to and including the current row.

    ``order`` must be a total order within a key; it alone decides. ``position`` (a number that rises with it) is not
    needed any more.
    """
    keys = list(keys)
    order = [as_col(o) for o in order]
    measures = {name: as_col(c) for name, c in sums.items()}
    names = [*df.columns, *[n for n in measures if n not in df.columns]]

    def window(*parts: str):
        return W.partitionBy(*parts).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)

    def plain(part: DataFrame) -> DataFrame:
        # without keys the one partition holds at most rows_per_cut rows
        w = window(*keys)
        return part.withColumns({name: F.sum(c).over(w) for name, c in measures.items()}).select(*names)

    def cut(placed: DataFrame) -> DataFrame:
        totals = placed.groupBy(*keys, _CUT).agg(*[F.sum(c).alias("__o_" + n) for n, c in measures.items()])
        # one row per range and key, so rows / rows_per_cut of them in a task
        before = W.partitionBy(*keys).orderBy(_CUT).rowsBetween(W.unboundedPreceding, -1)
        offsets = totals.select(
            *[F.col(k).alias("__k_" + k) for k in (*keys, _CUT)],
            *[F.sum("__o_" + n).over(before).alias("__o_" + n) for n in measures],
        )
        w = window(*keys, _CUT)
        local = placed.withColumns({name: F.sum(c).over(w) for name, c in measures.items()})

        def total(name: str) -> Column:
            # like sum(): missing values are skipped, and the result is missing only if nothing was seen
            here, earlier = F.col(name), F.col("__o_" + name)
            return F.coalesce(here + earlier, here, earlier)

        joined = local.join(offsets, same_keys([*keys, _CUT], "__k_"), "left")
        return joined.withColumns({n: total(n) for n in measures}).select(*names)

    return _by_size(df, keys, order, rows_per_cut, plain, cut)


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], position: Column | str | None = None,
    name: str = "row_id", *, rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Row numbers 1..n per key (or over the whole table when ``keys`` is empty)."""
    return running(df, keys, order, position, {name: F.lit(1).cast("long")}, rows_per_cut=rows_per_cut)


def next_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], position: Column | str | None,
    value: str, name: str, *, rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Value of the row, or else of the next row of the key that has one (backfill)."""
    keys = list(keys)
    names = [*df.columns, *([name] if name not in df.columns else [])]
    backwards = [F.col(o).desc() for o in order]

    def window(*parts: str):
        # read backwards: a frame that only grows costs one pass, an unbounded-following one does not
        return W.partitionBy(*parts).orderBy(*backwards).rowsBetween(W.unboundedPreceding, 0)

    def plain(part: DataFrame) -> DataFrame:
        return part.withColumn(name, F.last(value, ignorenulls=True).over(window(*keys))).select(*names)

    def cut(placed: DataFrame) -> DataFrame:
        known = F.when(F.col(value).isNotNull(), F.struct(*order))
        firsts = placed.groupBy(*keys, _CUT).agg(F.min_by(F.col(value), known).alias("__first"))
        later = W.partitionBy(*keys).orderBy(F.col(_CUT).desc()).rowsBetween(W.unboundedPreceding, -1)
        ahead = firsts.select(
            *[F.col(k).alias("__k_" + k) for k in (*keys, _CUT)],
            F.last("__first", ignorenulls=True).over(later).alias("__ahead"),
        )
        local = placed.withColumn(name, F.last(value, ignorenulls=True).over(window(*keys, _CUT)))
        joined = local.join(ahead, same_keys([*keys, _CUT], "__k_"), "left")
        return joined.withColumn(name, F.coalesce(F.col(name), F.col("__ahead"))).select(*names)

    return _by_size(df, keys, [F.col(o) for o in order], rows_per_cut, plain, cut)
