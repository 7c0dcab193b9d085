"""Column pruning, renames, casts, recodes, rule fills and encodings."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.scalars import nan_to_null, row_sum
from lakeloom.operators.ordering import numbered

MAX_CATEGORIES = 10_000


def drop_columns_containing(df: DataFrame, *parts: str) -> DataFrame:
    """Drop every column whose name contains one of the given texts."""
    return df.select([F.col(f"`{c}`") for c in df.columns if not any(p in c for p in parts)])


def keep_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select([F.col(f"`{c}`") for c in df.columns if re.search(pattern, c)])


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.select([F.col(f"`{c}`") for c in df.columns if not re.search(pattern, c)])


def prefix_columns(df: DataFrame, prefix: str, exclude: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in exclude})


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def two_word_names(df: DataFrame) -> DataFrame:
    """``sepal length (cm)`` -> ``sepal_length``."""
    return df.toDF(*["_".join(c.split()[:2]) for c in df.columns])


def cast_columns(df: DataFrame, columns: Iterable[str], to: str) -> DataFrame:
    """Cast the listed columns; a value that does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in columns})


def cast_all(df: DataFrame, to: str = "string") -> DataFrame:
    return cast_columns(df, df.columns, to)


def nan_columns_to_null(df: DataFrame) -> DataFrame:
    """Missing floats are NULL everywhere in this library; call this after reading NaN data."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def cast_numeric(df: DataFrame, column: str) -> DataFrame:
    """Split numeric text into ``_int`` (whole numbers) and ``_float``, with an ``_is_numeric`` flag.

    The text column stays, so text that is no number is not lost.
    """
    number = F.col(column).try_cast("double")
    whole = number == F.floor(number)
    return df.withColumns(
        {
            f"{column}_int": F.when(whole, number.try_cast("long")),
            f"{column}_float": F.when(~whole, number),
            f"{column}_is_numeric": number.isNotNull(),
        }
    )


def rule_fill(df: DataFrame, rules: Sequence[tuple[str, Column, Column | str | int | float]]) -> DataFrame:
    """Fill empty cells by ordered rules ``(column, condition, value)``.

    Each rule sees the cells the earlier ones filled.
    """
    for column, condition, value in rules:
        filled = value if isinstance(value, Column) else F.lit(value)
        df = df.withColumn(column, F.when(F.col(column).isNull() & condition, filled).otherwise(F.col(column)))
    return df


def combine_text(df: DataFrame, pattern: str, delimiter: str, new_column: str) -> DataFrame:
    parts = [F.col(c) for c in df.columns if re.search(pattern, c)]
    return df.withColumn(new_column, F.concat_ws(delimiter, *parts))


def with_row_sum(df: DataFrame, columns: Sequence[str], name: str = "sum") -> DataFrame:
    return df.withColumn(name, row_sum(columns))


def explode_list(df: DataFrame, column: str, delimiter: str, item: str, position: str | None = None) -> DataFrame:
    """One row per list item, blanks and order kept as they are."""
    pieces = F.split(F.col(column), re.escape(delimiter), -1)
    keep = [c for c in df.columns if c != column]
    out = df.select(*keep, F.posexplode(pieces).alias("__at", item))
    return out.withColumnRenamed("__at", position) if position else out.drop("__at")


def keyed_patch(df: DataFrame, patches: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite single cells from a table ``(key, column, value)`` of known corrections.

    The corrections become one row per key before the join, so it never multiplies rows.
    """
    wide = patches.groupBy(key).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"__{c}") for c in columns]
    )
    types = dict(df.dtypes)
    return (
        df.join(wide, key, "left")
        .withColumns({c: F.coalesce(F.col(f"__{c}").try_cast(types[c]), F.col(c)) for c in columns})
        .select(*df.columns)
    )


def few_values(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list | None:
    """Sorted distinct values when there are at most ``limit``, otherwise None."""
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    return None if len(rows) > limit else sorted(r[0] for r in rows)


@dataclass
class LabelEncoder:
    """Codes 0..k-1 by sorted value for each column; missing values stay missing."""

    codes: dict[str, DataFrame]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> LabelEncoder:
        codes = {}
        for c in columns:
            values = few_values(df, c, limit)
            if values is not None:
                schema = T.StructType([T.StructField(c, df.schema[c].dataType), T.StructField("__code", T.LongType())])
                # at most ``limit`` rows, so safe to broadcast
                codes[c] = F.broadcast(df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(values)], schema))
            else:
                distinct = df.select(c).filter(F.col(c).isNotNull()).distinct()
                codes[c] = _ranked_codes(distinct, c)
        return cls(codes)

    def apply(self, df: DataFrame, suffix: str = "") -> DataFrame:
        for c, table in self.codes.items():
            coded = df.join(table, c, "left")
            if suffix:
                df = coded.withColumnRenamed("__code", c + suffix).select(*df.columns, c + suffix)
            else:
                df = coded.withColumn(c, F.col("__code")).select(*df.columns)
        return df


def _ranked_codes(distinct: DataFrame, c: str) -> DataFrame:
    """Codes for a column with too many values for the driver."""
    return numbered(distinct, [], [c], name="__n").select(c, (F.col("__n") - 1).alias("__code"))


def one_hot(df: DataFrame, exclude: Sequence[str] = (), limit: int = 1_000) -> DataFrame:
    """Text columns become ``column_value`` columns of 0.0 / 1.0; numbers pass through as doubles, ahead of them.

    A column with more than ``limit`` values becomes one sparse vector column ``column_onehot`` of the same zeros and
    ones, in the order of its values, and a last place for a missing one.
    """
    for f in df.schema:
        if f.name not in exclude and isinstance(f.dataType, T.StringType) and few_values(df, f.name, limit) is None:
            df = one_hot_vector(df, f.name, f.name + "_onehot", missing="last").drop(f.name)
    numbers: list[Column] = []
    out: list[Column] = []
    tail: list[Column] = []
    for f in df.schema:
        if f.name in exclude:
            tail.append(F.col(f.name))
        elif isinstance(f.dataType, T.StringType):
            values = few_values(df, f.name, limit)
            hit = F.col(f.name)
            out += [F.when(hit.eqNullSafe(v), 1.0).otherwise(0.0).alias(f"{f.name}_{v}") for v in values]
        elif isinstance(f.dataType, T.NumericType):
            numbers.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*numbers, *out, *tail)


def one_hot_vector(df: DataFrame, column: str, name: str, missing: str = "drop") -> DataFrame:
    """A sparse 0/1 vector of any number of categories, for columns too wide for one column each.

    Rows without a value are dropped; with ``missing="last"`` they stay and have the last place.
    """
    coded = LabelEncoder.fit(df, [column]).apply(df, "__code")
    if missing == "last":
        top = coded.filter(F.col(column).isNotNull()).agg(F.max(column + "__code")).first()[0]
        code = F.when(F.col(column).isNull(), F.lit(-1 if top is None else top) + 1).otherwise(F.col(column + "__code"))
        coded = coded.withColumn(column + "__code", code)
    else:
        coded = coded.na.drop(subset=[column])
    encoder = OneHotEncoder(inputCol=column + "__code", outputCol=name, dropLast=False)
    return encoder.fit(coded).transform(coded).drop(column + "__code")
