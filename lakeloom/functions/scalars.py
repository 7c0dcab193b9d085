"""Column functions: text, dates, arithmetic and stable hashing, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 48


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den``; a zero denominator gives NULL instead of an ANSI error."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def flag_nonzero(c: Column | str) -> Column:
    """1 when the value differs from 0, where a missing value counts as different."""
    return F.when(~as_col(c).eqNullSafe(F.lit(0)), 1).otherwise(0)


def nan_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def remove_newlines_lower(c: Column | str) -> Column:
    return F.lower(F.replace(as_col(c), F.lit("\n"), F.lit("")))


def strip_lower(c: Column | str) -> Column:
    return F.lower(F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", ""))


def dash_to_space(c: Column | str) -> Column:
    return F.replace(as_col(c), F.lit("-"), F.lit(" "))


def plus_to_number(c: Column | str) -> Column:
    """``"3+"`` -> 3.0; text that is no number gives NULL."""
    return F.replace(as_col(c), F.lit("+"), F.lit("")).try_cast("double")


def parse_message_time(c: Column | str) -> Column:
    """ISO time with or without a fraction and a closing ``Z``; anything else is NULL."""
    c = as_col(c)
    return F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")),
    )


def weekday_monday0(c: Column | str) -> Column:
    return F.weekday(as_col(c))


def days_between(end: Column | str, start: Column | str) -> Column:
    """Whole days from start to end, rounded down as a time difference is."""
    seconds = seconds_of(end) - seconds_of(start)
    return F.floor(seconds / 86400).cast("long")


def seconds_of(c: Column | str) -> Column:
    """Seconds since 1970 with their fraction, read off the wall clock: free of time zones, monotone in ``c``."""
    c = as_col(c)
    return (
        F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double") * 86400
        + F.hour(c) * 3600
        + F.minute(c) * 60
        + F.date_part(F.lit("SECOND"), c).cast("double")
    )


def floor_multiple(c: Column | str, multiple: int) -> Column:
    if multiple == 0:
        raise ZeroDivisionError("multiple must not be 0")
    return (F.floor(as_col(c) / F.lit(multiple)) * multiple).cast("long")


def match_probability(a: Column | str, b: Column | str, base: float = 0.85, decay: float = 0.25) -> Column:
    """Click probability that decays with the distance between two levels and never drops below 0."""
    distance = F.abs(as_col(a) - as_col(b)).cast("double")
    return F.greatest(F.lit(0.0), F.lit(base) - F.lit(decay) * distance)


def row_sum(cols: Sequence[Column | str]) -> Column:
    """Total over columns; missing cells count as 0, so an all-missing row gives 0."""
    return reduce(lambda x, y: x + y, [F.coalesce(as_col(c).cast("double"), F.lit(0.0)) for c in cols])


def row_l1(xs: Sequence[Column | str], ys: Sequence[Column | str]) -> Column:
    """Sum of absolute differences over paired columns; a missing cell makes the row NULL."""
    if len(xs) != len(ys):
        raise ValueError("column lists differ in length")
    return reduce(lambda p, q: p + q, [F.abs(as_col(x) - as_col(y)) for x, y in zip(xs, ys)])


def array_l1(x: Column | str, y: Column | str) -> Column:
    return F.aggregate(
        F.zip_with(as_col(x), as_col(y), lambda p, q: F.abs(p.cast("double") - q.cast("double"))),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )


def slices(c: Column | str, size: int) -> Column:
    """Array cut into consecutive slices of ``size`` elements."""
    c = as_col(c)
    starts = F.sequence(F.lit(1), F.greatest(F.size(c), F.lit(1)), F.lit(size))
    return F.when(F.size(c) > 0, F.transform(starts, lambda i: F.slice(c, i, F.lit(size)))).otherwise(
        F.array().cast("array<array<string>>")
    )


def stable_hash(*cols: Column | str, seed: int = 0) -> Column:
    """Integer in [0, 2**48) from the values alone, so it does not change with the partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[as_col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def stable_uniform(*cols: Column | str, seed: int = 0) -> Column:
    """Pseudo-uniform double in [0, 1)."""
    return stable_hash(*cols, seed=seed).cast("double") / F.lit(float(HASH_RANGE))


def recode(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep the others."""
    c = as_col(c)
    out = c
    if mapping:
        items = iter(mapping.items())
        k, v = next(items)
        chain = F.when(c == k, F.lit(v))
        for k, v in items:
            chain = chain.when(c == k, F.lit(v))
        out = chain.otherwise(c)
    return out


def recode_else(c: Column | str, keep: Sequence[str], other: str) -> Column:
    """Keep listed values, move everything else (missing values too) to ``other``."""
    c = as_col(c)
    return F.when(c.isin(list(keep)), c).otherwise(F.lit(other))


def with_suffix_when(c: Column | str, condition: Column, suffix: str) -> Column:
    c = as_col(c)
    return F.when(condition, F.concat(c, F.lit(suffix))).otherwise(c)


def template(text: str, **fields: Column | str) -> Column:
    """Fill ``{name}`` places of a fixed text with row values; missing values fill as empty text."""
    parts: list[Column] = []
    rest = text
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, closed, rest = tail.partition("}")
        if not closed or name not in fields:
            raise KeyError(f"no value for place {name!r}")
        if head:
            parts.append(F.lit(head))
        parts.append(F.coalesce(as_col(fields[name]).cast("string"), F.lit("")))
    if rest or not parts:
        parts.append(F.lit(rest))
    return F.concat(*parts)
