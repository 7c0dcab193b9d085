"""Model table, constraint slacks, objective and output of a given portfolio allocation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.joins import full_outer_join, lookup_all


@dataclass(frozen=True)
class Limits:
    """Right-hand sides of the constraints."""

    max_risky_stocks: int = 3
    max_risky_stocks_ratio: float = 0.25
    max_ratio_per_stock: float = 0.3
    min_ratio_per_stock: float = 0.01
    min_ratio_per_region: float = 0.2
    min_stocks_per_region: int = 2
    max_total_stocks: int = 8
    # a constraint may be hard, soft (penalised) or off
    max_number_risky: str = "hard"
    min_number_per_region: str = "soft"


def model_table(stocks: DataFrame, regions: DataFrame, industries: DataFrame) -> DataFrame:
    """Stocks with their expected return = industry return x region index."""
    joined = lookup_all(stocks, [(regions, "region"), (industries, "industry")])
    expected = F.col("avg_return").cast("double") * F.col("region_index")
    return joined.select("name", "region", "is_risky", expected.alias("expected_return"))


def stock_slacks(solution: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per stock: slack of the largest and of the smallest share it may have when bought."""
    return solution.select(
        "name",
        (F.lit(limits.max_ratio_per_stock) * F.col("buy") - F.col("fraction")).alias("tie_buy_and_fraction_lb"),
        (F.lit(limits.min_ratio_per_stock) * F.col("buy") - F.col("fraction")).alias("tie_buy_and_fraction_ub"),
    )


def _region_totals(solution: DataFrame) -> DataFrame:
    """Share (f) and number (b) of bought stocks per region, and those of risky ones (rf, rb)."""
    risky = F.col("is_risky") == 1
    share = F.col("fraction").cast("decimal(28,9)")
    return solution.groupBy("region").agg(
        F.sum(share).alias("f"),
        F.sum("buy").alias("b"),
        F.coalesce(F.sum(F.when(risky, share)), F.lit(0)).alias("rf"),
        F.coalesce(F.sum(F.when(risky, F.col("buy"))), F.lit(0)).alias("rb"),
    )


def region_slacks(solution: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per region: slack of the smallest share and the smallest number of stocks."""
    out = _region_totals(solution).select(
        "region",
        (F.lit(limits.min_ratio_per_region) - F.col("f").cast("double")).alias("min_fraction_per_region"),
        (F.lit(float(limits.min_stocks_per_region)) - F.col("b").cast("double")).alias("min_number_per_region"),
    )
    return out.drop("min_number_per_region") if limits.min_number_per_region == "off" else out


def total_slacks(solution: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The whole-portfolio constraints as rows (constraint_name, slack), added up from the region totals."""
    one = _region_totals(solution).agg(*[F.sum(c).cast("double").alias(c) for c in ("f", "b", "rf", "rb")])
    named = {"invest_all": F.lit(1.0) - F.col("f")}
    if limits.max_number_risky != "off":
        named["max_number_risky_sum"] = F.lit(float(limits.max_risky_stocks)) - F.col("rb")
    named["max_fraction_risky"] = F.lit(limits.max_risky_stocks_ratio) - F.col("rf")
    named["max_number_stocks"] = F.lit(float(limits.max_total_stocks)) - F.col("b")
    return one.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("constraint_name"), c.alias("slack")) for n, c in named.items()]))
    )


def constraint_slack(solution: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Every constraint as a row (constraint_name, entity, slack)."""
    per_stock = stock_slacks(solution, limits).unpivot(
        "name", ["tie_buy_and_fraction_lb", "tie_buy_and_fraction_ub"], "constraint_name", "slack"
    )
    regional = region_slacks(solution, limits)
    per_region = regional.unpivot("region", [c for c in regional.columns if c != "region"], "constraint_name", "slack")
    return (
        per_stock.select("constraint_name", F.col("name").alias("entity"), "slack")
        .unionByName(per_region.select("constraint_name", F.col("region").alias("entity"), "slack"))
        .unionByName(total_slacks(solution, limits).withColumn("entity", F.lit("all")))
    )


def penalty(shortfall: Column, weight: float, mode: str) -> Column:
    """Cost of a violated soft constraint; hard and switched-off ones cost nothing here."""
    return F.greatest(shortfall, F.lit(0.0)) * F.lit(weight if mode == "soft" else 0.0)


def objective(solution: DataFrame, limits: Limits = Limits(), risky_weight: float = 0.1, region_weight: float = 0.1) -> DataFrame:
    """Expected return of the allocation less the penalties of its soft constraints."""
    by_region = solution.groupBy("region").agg(
        F.sum((F.col("fraction") * F.col("expected_return")).cast("decimal(28,9)")).alias("earned"),
        F.sum("buy").cast("double").alias("b"),
        F.coalesce(F.sum(F.when(F.col("is_risky") == 1, F.col("buy"))), F.lit(0)).cast("double").alias("rb"),
    )
    short = penalty(F.lit(float(limits.min_stocks_per_region)) - F.col("b"), region_weight, limits.min_number_per_region)
    risky = penalty(F.sum("rb") - F.lit(float(limits.max_risky_stocks)), risky_weight, limits.max_number_risky)
    one = by_region.agg(F.sum("earned").cast("double").alias("expected_return"), (risky + F.sum(short)).alias("penalty"))
    return one.withColumn("objective", F.col("expected_return") - F.col("penalty"))


def merge_slacks(per_stock_lb: DataFrame, per_stock_ub: DataFrame, min_fraction: DataFrame, min_number: DataFrame | None, totals: DataFrame) -> DataFrame:
    """One wide report of all slacks; each constraint family fills its own columns."""
    stocks = full_outer_join(per_stock_lb, per_stock_ub, "name", "name").withColumnRenamed("name", "stock")
    merged = full_outer_join(stocks, min_fraction, "stock", "region")
    if min_number is not None:
        right = min_number.withColumnRenamed("region", "__region")
        # a stock row has no region: it finds none, since a missing key may only meet a missing key
        merged = merged.join(right, F.col("region").eqNullSafe(F.col("__region")), "full")
        merged = merged.withColumn("region", F.coalesce("region", "__region")).drop("__region")
    return full_outer_join(merged, totals, "stock", "constraint_name")


def totals_from_columns(one_row: DataFrame) -> DataFrame:
    """Side-by-side slacks to rows (constraint_name, slack); missing ones give no row."""
    return one_row.unpivot([], one_row.columns, "constraint_name", "slack").filter(F.col("slack").isNotNull())


def portfolio_output(solution: DataFrame, model: DataFrame, stocks: DataFrame, industries: DataFrame, regions: DataFrame) -> DataFrame:
    """Bought stocks with their share in whole percent (half to even) and all lookups."""
    bought = solution.filter(F.col("fraction") > 0).select("name", "fraction")
    return lookup_all(
        bought,
        [(model, "name"), (stocks.select("name", "industry"), "name"), (industries, "industry"), (regions, "region")],
        [
            "name",
            F.bround(F.col("fraction") * 100).alias("recommended portfolio percent"),
            "is_risky",
            "expected_return",
            "region",
            "region_index",
            "industry",
            F.col("avg_return").alias("industry average"),
        ],
    )


def describe_rows(output: DataFrame) -> DataFrame:
    """One readable line per bought stock."""
    return output.select(
        F.concat(
            F.lit("STOCK: "), F.col("name"), F.lit(" REGION: "), F.col("region"), F.lit(" RISKY: "),
            F.col("is_risky").cast("string"), F.lit(" PORTFOLIO: "),
            F.col("`recommended portfolio percent`").cast("string"), F.lit("%"),
        ).alias("line")
    )
