"""Aggregate columns whose results follow the tables' original pandas semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.scalars import as_col


def distinct_with_nulls(c: Column | str) -> Column:
    """Distinct values where every missing value counts as one more."""
    c = as_col(c)
    return F.count_distinct(c) + F.count_if(c.isNull())


def lowest_mode(c: Column | str) -> Column:
    """Most frequent value; the smallest one among ties; NULL for a group without values."""
    return F.mode(as_col(c), True)


def quantile(c: Column | str, q: float) -> Column:
    """Exact quantile with linear interpolation."""
    return F.percentile(as_col(c), F.lit(q))


def exact_sum(c: Column | str, scale: int = 4) -> Column:
    """Sum that does not depend on the order of addition; returned as double."""
    return F.sum(as_col(c).cast(f"decimal(28,{scale})")).cast("double")


def pearson(x: Column | str, y: Column | str) -> Column:
    """Correlation over rows where both are present; NULL when one side is constant."""
    x, y = as_col(x).cast("double"), as_col(y).cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)
