"""Data-quality suites compiled into one aggregation pass.

``critical`` suites raise when a check fails, ``warning`` suites only report.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_COLUMNS = (
    "suite", "level", "expectation", "column", "success", "observed", "unexpected_count", "unexpected_percent",
)


class CriticalQualityError(RuntimeError):
    """A critical suite failed."""


@dataclass(frozen=True)
class Expectation:
    """One check: its type and keyword arguments."""

    kind: str
    kwargs: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in _KNOWN:
            raise ValueError(f"unknown expectation {self.kind!r}")
        extra = set(self.kwargs) - _KNOWN[self.kind]
        if extra:
            raise ValueError(f"{self.kind}: unknown arguments {sorted(extra)}")


@dataclass(frozen=True)
class Suite:
    """Named list of expectations at one level."""

    name: str
    level: str
    expectations: tuple[Expectation, ...]

    def __post_init__(self) -> None:
        if self.level not in ("critical", "warning"):
            raise ValueError(f"unknown level {self.level!r}")


def suites_from_config(config: Mapping, step: str) -> dict[str, tuple[str, Suite]]:
    """Suites a step runs, as ``{suite: (file, Suite)}``, from ``{suites: …, steps: …}`` settings."""
    out = {}
    for name in config["steps"][step]:
        body = config["suites"][name]
        checks = tuple(
            Expectation(e["expectation_type"].removeprefix("expect_"), dict(e.get("kwargs", {})))
            for e in body["expectations"]
        )
        out[name] = (body["file"], Suite(name, name.rsplit(".", 1)[1], checks))
    return out


_RANGE = {"min_value", "max_value"}
# arguments each check accepts
_KNOWN: dict[str, set[str]] = {
    "column_values_to_not_be_null": {"column", "mostly"},
    "column_values_to_be_between": {"column", "mostly"} | _RANGE,
    "column_values_to_be_unique": {"column", "mostly"},
    "column_values_to_be_in_set": {"column", "mostly", "value_set"},
    "column_values_to_not_be_in_set": {"column", "mostly", "value_set"},
    "column_values_to_match_regex": {"column", "mostly", "regex"},
    "column_values_to_be_in_type_list": {"column", "type_list"},
    "column_to_exist": {"column"},
    "table_columns_to_match_set": {"column_set"},
    "table_row_count_to_be_between": set(_RANGE),
    "table_row_count_to_equal": {"value"},
    "column_distinct_values_to_equal_set": {"column", "value_set"},
    "column_distinct_values_to_be_in_set": {"column", "value_set"},
    "column_unique_value_count_to_be_between": {"column"} | _RANGE,
    "column_min_to_be_between": {"column"} | _RANGE,
    "column_max_to_be_between": {"column"} | _RANGE,
    "column_sum_to_be_between": {"column", "tolerance"} | _RANGE,
}


def validate(df: DataFrame, *suites: Suite) -> DataFrame:
    """One result row per expectation; nothing runs until the result is used.

    All expectations of all given suites share one pass. Only uniqueness and exact distinct counts add a
    grouped pass of their own.
    """
    parts: list[Column] = []
    rows: list[Column] = []

    def measure(c: Column) -> Column:
        name = f"m{len(parts)}"
        parts.append(c.alias(name))
        return F.col(name)

    for suite in suites:
        for e in suite.expectations:
            rows.append(_row(df, suite, e, measure))
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *parts)
    return one.select(F.inline(F.array(*rows)))


def fault(df: DataFrame, e: Expectation) -> tuple[Column, Column] | None:
    """When a row fails an expectation about single values, and which rows it looks at; None for other expectations."""
    k, name = e.kwargs, str(e.kwargs.get("column", ""))
    c = F.col(f"`{name}`") if name else None
    if e.kind == "column_values_to_not_be_null":
        return c.isNull(), F.lit(True)
    if e.kind == "column_values_to_be_between":
        bad = F.lit(False)
        if k.get("min_value") is not None:
            bad = bad | (c < F.lit(k["min_value"]))
        if k.get("max_value") is not None:
            bad = bad | (c > F.lit(k["max_value"]))
        return bad, c.isNotNull()
    if e.kind in ("column_values_to_be_in_set", "column_distinct_values_to_be_in_set"):
        return ~c.isin(_like(df, name, k["value_set"])), c.isNotNull()
    if e.kind == "column_values_to_not_be_in_set":
        return c.isin(_like(df, name, k["value_set"])), c.isNotNull()
    if e.kind == "column_values_to_match_regex":
        return ~c.rlike(str(k["regex"])), c.isNotNull()
    return None


def _row(df: DataFrame, suite: Suite, e: Expectation, measure: Callable[[Column], Column]) -> Column:
    k = e.kwargs
    name = str(k.get("column", ""))
    c = F.col(f"`{name}`") if name else None
    total = F.col("__rows")
    mostly = float(k.get("mostly", 1.0))

    def per_value(bad: Column, among: Column) -> Column:
        n_bad, n = measure(F.count_if(bad)), measure(F.count_if(among))
        share = F.coalesce(F.try_divide(n_bad, n), F.lit(0.0))
        return _result(suite, e, name, (F.lit(1.0) - share) >= F.lit(mostly) - 1e-12, n, n_bad, share * 100)

    def bounded(value: Column, slack: float = 0.0) -> Column:
        ok = value.isNotNull()
        if k.get("min_value") is not None:
            ok = ok & (value >= F.lit(k["min_value"]) - slack)
        if k.get("max_value") is not None:
            ok = ok & (value <= F.lit(k["max_value"]) + slack)
        return _result(suite, e, name, ok, value)

    def schema_check(ok: bool) -> Column:
        return _result(suite, e, name, F.lit(ok), F.lit(1 if ok else 0))

    kind = e.kind
    if kind == "column_to_exist":
        return schema_check(name in df.columns)
    if kind == "table_columns_to_match_set":
        return schema_check(set(df.columns) == set(k["column_set"]))
    if kind == "column_values_to_be_in_type_list":
        return schema_check(_type_name(df, name) in {str(t).lower() for t in k["type_list"]})
    if kind == "table_row_count_to_be_between":
        return bounded(total)
    if kind == "table_row_count_to_equal":
        return _result(suite, e, name, total == F.lit(k["value"]), total)
    single = fault(df, e)
    if single is not None:
        return per_value(*single)
    if kind == "column_distinct_values_to_equal_set":
        # no value list is gathered: strangers are counted, members are looked for one by one
        members = _like(df, name, k["value_set"])
        strangers = measure(F.count_if(~c.isin(members)))
        present = F.lit(0)
        for m in members:
            present = present + measure(F.coalesce(F.max(c == F.lit(m)), F.lit(False))).cast("int")
        return _result(suite, e, name, (strangers == 0) & (present == len(members)), present, strangers)
    if kind == "column_values_to_be_unique":
        twice = df.filter(c.isNotNull()).groupBy(c.alias("v")).agg(F.count(F.lit(1)).alias("n"))
        n_bad = twice.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("b")).scalar()
        n = measure(F.count(c))
        share = F.coalesce(F.try_divide(n_bad, n), F.lit(0.0))
        return _result(suite, e, name, (F.lit(1.0) - share) >= F.lit(mostly) - 1e-12, n, n_bad, share * 100)
    if kind == "column_unique_value_count_to_be_between":
        return bounded(df.agg(F.count_distinct(c).alias("n")).scalar())
    if kind == "column_min_to_be_between":
        return bounded(measure(F.min(c)))
    if kind == "column_max_to_be_between":
        return bounded(measure(F.max(c)))
    if kind == "column_sum_to_be_between":
        return bounded(measure(F.sum(c)), float(k.get("tolerance", 1e-9)))
    raise ValueError(kind)


def _result(
    suite: Suite, e: Expectation, column: str, success: Column, observed: Column,
    unexpected: Column | None = None, percent: Column | None = None,
) -> Column:
    return F.struct(
        F.lit(suite.name).alias("suite"),
        F.lit(suite.level).alias("level"),
        F.lit(e.kind).alias("expectation"),
        F.lit(column).alias("column"),
        F.coalesce(success, F.lit(False)).alias("success"),
        observed.cast("double").alias("observed"),
        (F.lit(None) if unexpected is None else unexpected).cast("long").alias("unexpected_count"),
        (F.lit(None) if percent is None else percent).cast("double").alias("unexpected_percent"),
    )


def _type_name(df: DataFrame, column: str) -> str:
    names = {
        T.StringType: "string", T.LongType: "bigint", T.IntegerType: "int", T.DoubleType: "double",
        T.FloatType: "float", T.BooleanType: "boolean",
    }
    kind = df.schema[column].dataType
    return names.get(type(kind), kind.simpleString())


def _like(df: DataFrame, column: str, values: Sequence[object]) -> list[object]:
    """Members that can occur in a column of this type; text never equals a number."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return [v for v in values if isinstance(v, (int, float)) and not isinstance(v, bool)]
    if isinstance(kind, T.StringType):
        return [v for v in values if isinstance(v, str)]
    return list(values)


def enforce(df: DataFrame, suite: Suite) -> list:
    """Run a suite; raise for a failed critical one. Returns its result rows (one per expectation)."""
    rows = validate(df, suite).collect()
    failed = [r for r in rows if not r["success"]]
    if failed and suite.level == "critical":
        raise CriticalQualityError("; ".join(f"{r['expectation']}({r['column']})" for r in failed))
    return rows


def minimum_rows(max_ratio_per_stock: float, max_risky_ratio: float) -> int:
    """Fewest rows that can add up to 1 under the per-row limits."""
    return math.ceil(1 / min(max_ratio_per_stock, max_risky_ratio))


def check_minimum_rows(df: DataFrame, minimum: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(minimum).cast("long").alias("minimum"), (F.col("n_rows") >= minimum).alias("success")
    )


def enforce_group_minimum(low: DataFrame, group: str, shown: int | None = None) -> None:
    """Raise when any group is listed; the message names them all, or the first ``shown``."""
    text = _few_rows_message(low, group, shown)
    if text:
        raise CriticalQualityError(text)


def _few_rows_message(low: DataFrame, group: str, shown: int | None) -> str:
    listed = low.select(group).orderBy(group)
    names = [str(r[group]) for r in (listed if shown is None else listed.limit(shown + 1)).collect()]
    if not names:
        return ""
    more = ", and more" if shown is not None and len(names) > shown else ""
    return f"not enough rows for {group}: {', '.join(names[:shown])}{more}"


def enforce_size(df: DataFrame, minimum: int, low: DataFrame, group: str, shown: int | None = None) -> None:
    """Both size checks of the model table; all errors are raised together."""
    errors = []
    if not check_minimum_rows(df, minimum).first()["success"]:
        errors.append("not enough rows for the share limits")
    few = _few_rows_message(low, group, shown)
    if few:
        errors.append(few)
    if errors:
        raise CriticalQualityError("; ".join(errors))


def soft_warnings(df: DataFrame, risky: str, group: str) -> DataFrame:
    """Rows for the two soft checks: no risky row at all, and only one group (a missing group is one, too)."""
    one = df.agg(
        F.count_if(~F.col(risky).eqNullSafe(F.lit(0))).alias("r"),
        F.count(F.lit(1)).alias("n"), F.count(group).alias("known"), F.min(group).alias("lo"), F.max(group).alias("hi"),
    )
    all_known, none_known = F.col("known") == F.col("n"), F.col("known") == 0
    single = (F.col("n") > 0) & (none_known | (all_known & (F.col("lo") == F.col("hi"))))
    return one.select(
        F.inline(
            F.array(
                F.struct(F.lit("no_risky_row").alias("check"), (F.col("r") == 0).alias("warn")),
                F.struct(F.lit("single_group").alias("check"), single.alias("warn")),
            )
        )
    )


def same_row_count(a: DataFrame, b: DataFrame) -> DataFrame:
    n_b = b.agg(F.count(F.lit(1)).alias("n")).scalar()
    return a.agg(F.count(F.lit(1)).alias("n_left")).withColumn("n_right", n_b).withColumn(
        "success", F.col("n_left") == F.col("n_right")
    )


def above_share(df: DataFrame, column: str, bound: float, allowed: int) -> DataFrame:
    """How many rows exceed a bound, and whether that is more than allowed."""
    return df.agg(F.count_if(F.col(column) > bound).alias("n_above")).withColumn(
        "warn", F.col("n_above") > allowed
    )


def rows_above(df: DataFrame, name: str, column: str, bound: float, allowed: int) -> DataFrame:
    """Names and values of the rows above a bound where more than ``allowed`` are, else no row."""
    above = df.filter(F.col(column) > bound)
    many = above.agg(F.count(F.lit(1)).alias("n")).scalar() > allowed
    return above.filter(many).select(name, column)


def report_json(results: DataFrame) -> DataFrame:
    """One JSON document per result row."""
    return results.select(F.to_json(F.struct(*[F.col(c) for c in RESULT_COLUMNS])).alias("report"))
