"""Group features with exact quantiles, modes and distinct counts that survive hot groups.

Quantile, mode and distinct-set buffers of one group live in one task. Groups up to ``HOT_ROWS`` rows take
that fast path in a single aggregation. Quantiles of larger groups are selected in two passes: a mergeable sketch brackets
each rank, then rows are counted between the brackets and only values inside them are told apart. Modes and distinct
counts come from counts by (group, value). So no task ever holds such a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.ordering import ROWS_PER_CUT, running, same_keys, split_hot
from lakeloom.session import materialize

HOT_ROWS = 500_000
Measure = tuple[str, str]  # (kind, column); kind: nunique, sum, median, q1, q3, mode
_SHARES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
_KINDS = {"nunique", "sum", "mode", *_SHARES}
_ACCURACY = 10_000


def group_features(
    df: DataFrame,
    key: str,
    measures: Mapping[str, Measure],
    hot_rows: int = HOT_ROWS,
    rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """One row per key with the named measures."""
    unknown = {k for k, _ in measures.values()} - _KINDS
    if unknown:
        raise ValueError(f"unknown measures {sorted(unknown)}")
    df = df.select(*dict.fromkeys([key, *(c for _, c in measures.values())]))
    cool, hot = split_hot(df, [key], hot_rows)
    out = _compact(cool, key, measures)
    return out if hot is None else out.unionByName(_spread(hot, key, measures, hot_rows, rows_per_cut))


def _compact(df: DataFrame, key: str, measures: Mapping[str, Measure]) -> DataFrame:
    """One aggregation; the three quantiles of a column share one buffer.

    Rows are moved to their key's task as they are: value buffers of partly seen groups would be larger.
    """
    df = df.repartition(key)
    aggs: list[Column] = [
        F.percentile(F.col(c), F.array(*[F.lit(s) for s in _SHARES.values()])).alias(f"__q_{c}")
        for c in dict.fromkeys(c for k, c in measures.values() if k in _SHARES)
    ]
    place = {k: i for i, k in enumerate(_SHARES)}
    out: list[Column] = [F.col(key)]
    for name, (kind, c) in measures.items():
        if kind in _SHARES:
            out.append(F.col(f"__q_{c}")[place[kind]].alias(name))
            continue
        if kind == "nunique":
            # a missing value counts as one more each time
            agg = (F.size(F.collect_set(c)) + F.count_if(F.col(c).isNull())).cast("long")
        elif kind == "sum":
            agg = F.coalesce(F.sum(c), F.lit(0))
        else:
            agg = F.mode(F.col(c), True)
        aggs.append(agg.alias(name))
        out.append(F.col(name))
    return df.groupBy(key).agg(*aggs).select(*out)


_VALUE_TYPES = {"i": "long", "x": "double", "s": "string"}


def _slot(df: DataFrame, column: str) -> str:
    """Which value column of the long form holds this column; each decimal type has one of its own."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return "i"
    if isinstance(kind, T.DecimalType):
        return f"d{kind.precision}_{kind.scale}"
    return "x" if isinstance(kind, (T.DoubleType, T.FloatType)) else "s"


def _slots(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Value columns of the long form and their types."""
    decimals = [df.schema[c].dataType for c in columns if isinstance(df.schema[c].dataType, T.DecimalType)]
    return _VALUE_TYPES | {f"d{d.precision}_{d.scale}": d.simpleString() for d in decimals}


def _brackets(df: DataFrame, columns: Sequence[str], hot_rows: int) -> list[Column]:
    """Per column a sketch's values a little below and above each share, by its error and two rows of a hot group."""
    slack = 3 / _ACCURACY + 2 / max(hot_rows, 1)
    at = [F.lit(x) for s in _SHARES.values() for x in (max(0.0, s - slack), min(1.0, s + slack))]
    return [F.percentile_approx(F.col(c).cast("double"), F.array(*at), F.lit(_ACCURACY)).alias(f"__b_{c}") for c in columns]


def _zone(v: Column, brackets: Column) -> tuple[Column, Column]:
    """How many bracket ends a value has passed (rises with the value), and the value itself if it is inside a bracket."""
    pairs = [(brackets[2 * i], brackets[2 * i + 1]) for i in range(len(_SHARES))]
    passed, inside = F.lit(0), F.lit(False)
    for lo, hi in pairs:
        passed = passed + (v >= lo).cast("int") + (v > hi).cast("int")
        inside = inside | ((v >= lo) & (v <= hi))
    return F.when(v.isNotNull(), passed), F.when(inside, v)


def _spread(df: DataFrame, key: str, measures: Mapping[str, Measure], hot_rows: int, rows_per_cut: int, bracketed: bool = True) -> DataFrame:
    """The same measures for groups too large for one task: one pass for sums and brackets, one for counts.

    All columns are counted in the second pass as rows (key, column, zone, value, count). A bracket that misses its rank,
    as a sketch might, is noticed, and the quantiles are then read off the counts of all values.
    """
    kinds = {c: {k for k, d in measures.values() if d == c} for _, c in measures.values()}
    narrow = [c for c, k in kinds.items() if bracketed and k & set(_SHARES) and not k - set(_SHARES) - {"sum"}]
    counted = [c for c, k in kinds.items() if k - {"sum"}]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, (k, c) in measures.items() if k == "sum"]
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *sums, *_brackets(df, narrow, hot_rows))
    if not counted:
        return out.select(key, *measures)
    out = materialize(out, "hot-groups") if narrow else out

    types = _slots(df, counted)

    def row(c: str) -> Column:
        slot, zone, value = _slot(df, c), F.lit(0), F.col(c)
        if c in narrow:
            slot, (zone, value) = "x", _zone(F.col(c).cast("double"), F.col(f"__b_{c}"))
        values = [(value if s == slot else F.lit(None)).cast(t).alias(s) for s, t in types.items()]
        return F.struct(F.lit(c).alias("__m"), zone.alias("__z"), *values)

    if narrow:  # one row per hot group, at most rows / hot_rows
        ends = out.select(F.col(key).alias("__key"), *[f"__b_{c}" for c in narrow])
        df = df.join(F.broadcast(ends), F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
    long = df.select(F.col(key).alias("__key"), F.inline(F.array(*[row(c) for c in counted])))
    counts = materialize(long.groupBy("__key", "__m", "__z", *types).agg(F.count(F.lit(1)).alias("__c")), "value-counts")

    aggs: list[Column] = []
    for name, (kind, c) in measures.items():
        v, mine = F.col(_slot(df, c)), F.col("__m") == c
        if kind == "nunique":
            n = F.when(v.isNull(), F.col("__c")).otherwise(F.lit(1))
            aggs.append(F.sum(F.when(mine, n)).alias(name))
        elif kind == "mode":
            ranked = F.struct((-F.col("__c")).alias("c"), v.alias("v"))
            best = F.min(F.when(mine & v.isNotNull(), ranked))["v"]
            aggs.append(best.cast(df.schema[c].dataType).alias(name))
    if aggs:
        out = _left_on_key(out, counts.groupBy("__key").agg(*aggs), key)

    numbers = [c for c, k in kinds.items() if k & set(_SHARES)]
    if numbers:
        rows = counts.filter(F.col("__m").isin(numbers)).withColumn("__v", F.coalesce(*[F.col(s).cast("double") for s in types if s != "s"]))
        known = rows.filter(F.col("__z").isNotNull() & (F.col("__m").isin(narrow) | F.col("__v").isNotNull()))
        found = exact_quantiles(known, ["__key", "__m"], "__v", "__c", _SHARES, rows_per_cut, zone="__z")
        if narrow:
            found = materialize(found, "hot-quantiles")
            missed = F.greatest(*[F.col(s).isNull() for s in _SHARES])
            if found.filter(missed).limit(1).count():
                return _spread(df.drop(*[f"__b_{c}" for c in narrow]), key, measures, hot_rows, rows_per_cut, False)
        wide = found.groupBy("__key").agg(
            *[
                F.max(F.when(F.col("__m") == c, F.col(kind))).alias(n)
                for n, (kind, c) in measures.items()
                if kind in _SHARES
            ]
        )
        out = _left_on_key(out, wide, key)
    return out.select(key, *measures)


def exact_quantiles(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    count: str,
    shares: Mapping[str, float],
    rows_per_cut: int = ROWS_PER_CUT,
    zone: str | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per key from rows of distinct values and their counts.

    With ``zone``, a number that rises with the value, values may be missing in zones where no quantile is wanted; a
    quantile that falls into such a zone is null.
    """
    keys = list(keys)
    order = [value] if zone is None else [zone, value]
    known = (counts if zone else counts.filter(F.col(value).isNotNull())).select(*keys, *order, count)
    upto = running(known, keys, order, None, {"__upto": F.col(count)}, rows_per_cut=rows_per_cut)
    place = F.struct(*order)
    totals = known.groupBy(*keys).agg(F.sum(count).alias("__total"))
    placed = upto.join(totals.withColumnsRenamed({k: "__t_" + k for k in keys}), same_keys(keys, "__t_"), "left")
    aggs: list[Column] = []
    for n, s in shares.items():
        at = F.lit(s) * (F.col("__total") - 1)
        aggs += [
            F.min(F.when(F.col("__upto") > F.floor(at), place))[value].alias(f"__lo_{n}"),
            F.min(F.when(F.col("__upto") > F.ceil(at), place))[value].alias(f"__hi_{n}"),
            F.max(at - F.floor(at)).alias(f"__w_{n}"),
        ]

    def between(n: str) -> Column:
        lo, hi, w = F.col(f"__lo_{n}"), F.col(f"__hi_{n}"), F.col(f"__w_{n}")
        return (lo + (hi - lo) * w).cast("double").alias(n)

    return placed.groupBy(*keys).agg(*aggs).select(*keys, *[between(n) for n in shares])


def _left_on_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
