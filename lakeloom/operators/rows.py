"""Row filters, de-duplication, sampling, splits, sorts and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from lakeloom.functions.scalars import HASH_RANGE, as_col, stable_hash
from lakeloom.operators.ordering import ROWS_PER_CUT, split_hot


def dropna_subset(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop(subset=list(columns))


def sentinel_dropna(df: DataFrame, sentinel: str = "?") -> DataFrame:
    """Read the sentinel text as missing, then drop rows with any missing cell."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.filter(
        _all([F.col(c).isNotNull() & (F.col(c) != sentinel) if c in text else F.col(c).isNotNull() for c in df.columns])
    )


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def filter_gt(df: DataFrame, column: str, bound: float) -> DataFrame:
    """Rows above a bound; text is read as a number, text that is none is dropped."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        c = c.try_cast("double")
    return df.filter(c > F.lit(bound))


def drop_allnull_columns(df: DataFrame) -> DataFrame:
    """Remove columns without a single value; one pass decides for all of them."""
    seen = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in df.columns]).first()
    return df.select([c for c in df.columns if seen[c]])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key in an explicit order; each map task already keeps one row per key."""
    w = W.partitionBy(*keys).orderBy(*[as_col(o) for o in order])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= 1).drop("__rn")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key; Spark trims each key to ``k`` rows before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def mask_parts(df: DataFrame, label: Column, split: Column, name: str = "part") -> DataFrame:
    """The part of each row (``train_normal``, ``test_normal``, ``train_other``, ``test_other``), in one pass; rows without
    a split have none."""
    side = F.when(split, "train").when(~split, "test")
    return df.withColumn(name, F.concat(side, F.when(F.coalesce(label, F.lit(False)), "_normal").otherwise("_other")))


def mask_split(df: DataFrame, label: Column, split: Column) -> dict[str, DataFrame]:
    """Normal and other rows of the train and test parts as four lazy filters; where all four are wanted, ``mask_parts``
    reads the table once."""
    normal = F.coalesce(label, F.lit(False))
    return {
        "train_normal": df.filter(split & normal),
        "test_normal": df.filter(~split & normal),
        "train_other": df.filter(split & ~normal),
        "test_other": df.filter(~split & ~normal),
    }


def date_slice(df: DataFrame, column: str, start: date) -> DataFrame:
    """Rows from a day on; the bound keeps the column bare so that it reaches the file scan."""
    kind = df.schema[column].dataType.simpleString()
    return df.filter(F.col(column) >= F.lit(start.isoformat()).cast(kind))


def scalar_lookup(df: DataFrame, name_column: str, name: str, value_column: str) -> Column:
    """Value of a named parameter as a scalar column, usable in another table's expressions."""
    return df.filter(F.col(name_column) == name).agg(F.max(value_column).alias("v")).scalar()


def sample_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows picked by a hash of their key: the same rows on every run and cluster size."""
    return (
        df.withColumn("__h", stable_hash(*key, seed=seed)).orderBy("__h", *key).limit(n).drop("__h")
    )


def split_random(df: DataFrame, key: Sequence[str], fraction: float, seed: int = 0, name: str = "is_train") -> DataFrame:
    """Mark about ``fraction`` of the rows, by key alone."""
    return df.withColumn(name, stable_hash(*key, seed=seed) < F.lit(int(fraction * HASH_RANGE)))


def split_stratified(
    df: DataFrame, stratum: str, key: Sequence[str], fraction: float, seed: int = 0,
    name: str = "is_train", hot_rows: int = ROWS_PER_CUT, slots: int = 4096,
) -> DataFrame:
    """Mark exactly ``round(fraction * n)`` rows of every stratum, those with the lowest hashes.

    A stratum above ``hot_rows`` rows is not sorted: its rows are counted by hash slot. Slots before the one in
    which its share ends are all in, later ones all out, and only that slot (about 1/slots) is ranked.
    """
    h = stable_hash(*key, seed=seed)
    cool, hot = split_hot(df, [stratum], hot_rows)
    whole = W.partitionBy(stratum)
    rank = F.row_number().over(whole.orderBy("__h", *key))
    want = F.bround(F.count(F.lit(1)).over(whole) * F.lit(fraction))
    out = cool.withColumn("__h", h).withColumn(name, rank <= want).select(*df.columns, name)
    return out if hot is None else out.unionByName(_split_by_slots(hot, stratum, key, fraction, h, name, slots))


def _split_by_slots(
    df: DataFrame, stratum: str, key: Sequence[str], fraction: float, h: Column, name: str, slots: int
) -> DataFrame:
    slotted = df.withColumns({"__h": h, "__slot": F.floor(h / (HASH_RANGE // slots))})
    counts = slotted.groupBy(stratum, "__slot").agg(F.count(F.lit(1)).alias("__c"))
    # at most ``slots`` rows per stratum reach one task here
    whole = W.partitionBy(stratum)
    upto = whole.orderBy("__slot").rowsBetween(W.unboundedPreceding, 0)
    placed = counts.select(
        F.col(stratum).alias("__s"),
        F.col("__slot").alias("__border"),
        F.bround(F.sum("__c").over(whole) * F.lit(fraction)).alias("__want"),
        (F.sum("__c").over(upto) - F.col("__c")).alias("__before"),
        F.sum("__c").over(upto).alias("__upto"),
    )
    # one row per stratum: the slot in which its share ends
    border = placed.filter((F.col("__before") < F.col("__want")) & (F.col("__upto") >= F.col("__want")))
    marked = slotted.join(border.drop("__upto"), F.col(stratum).eqNullSafe(F.col("__s")), "left")
    at_border = F.coalesce(F.col("__slot") == F.col("__border"), F.lit(False))
    sure = marked.filter(~at_border).withColumn(name, F.coalesce(F.col("__slot") < F.col("__border"), F.lit(False)))
    w = W.partitionBy(stratum, "__slot").orderBy("__h", *key)
    edge = marked.filter(at_border).withColumn(name, F.row_number().over(w) <= F.col("__want") - F.col("__before"))
    return sure.unionByName(edge).select(*df.columns, name)


def union_all(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def unpivot_measures(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns to rows; missing values give no row."""
    return df.unpivot(list(ids), list(values), name, value).filter(F.col(value).isNotNull())


def pivot_latest(df: DataFrame, keys: Sequence[str], tag: str, value: str, order: Sequence[str], tags: Sequence[str]) -> DataFrame:
    """One column per listed tag holding its latest value; map tasks keep one value per key and tag."""
    newest = F.struct(*order)
    return df.filter(F.col(tag).isin(list(tags))).groupBy(*keys).agg(
        *[
            F.max_by(F.when(F.col(tag) == t, F.col(value)), F.when(F.col(tag) == t, newest)).alias(t)
            for t in tags
        ]
    )
