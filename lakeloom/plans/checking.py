"""Quality suites, thresholds and portfolio audit over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.aggregates import exact_sum
from lakeloom.operators import allocation as A
from lakeloom.operators import anomaly
from lakeloom.operators import quality as Q
from lakeloom.operators import summaries as S
from lakeloom.operators.rows import split_random
from lakeloom.plans.registry import Tables, near, near_all, near_sql, query, train_sql
from lakeloom.session import materialize

RESULT = "'{suite}' AS suite, '{level}' AS level, '{kind}' AS expectation, '{column}' AS \"column\""


def expected(kind: str, column: str, success: str, observed: str, bad: str = "CAST(NULL AS BIGINT)", share: str = "CAST(NULL AS DOUBLE)",
             table: str = "orders", suite: str = "orders.warning") -> str:
    head = RESULT.format(suite=suite, level=suite.split(".")[1], kind=kind, column=column)
    return (
        f"SELECT {head}, {success} AS success, CAST({observed} AS DOUBLE) AS observed, CAST({bad} AS BIGINT) AS unexpected_count, "
        f"{near_sql(share)} AS unexpected_percent FROM {table}"
    )


def share_sql(bad: str, n: str) -> str:
    return f"coalesce({bad} * 100.0e0 / nullif({n}, 0), 0)"


ORDER_CHECKS = (
    ("column_values_to_not_be_null", {"column": "o_custkey"}),
    ("column_values_to_be_between", {"column": "o_totalprice", "min_value": 1000, "max_value": 400000, "mostly": 0.7}),
    ("column_values_to_not_be_in_set", {"column": "o_orderstatus", "value_set": ["X", "P"]}),
    ("column_values_to_match_regex", {"column": "o_orderpriority", "regex": "^[1-5]-[A-Z ]+$"}),
    ("column_to_exist", {"column": "o_orderdate"}),
    ("table_row_count_to_be_between", {"min_value": 1, "max_value": 10**15}),
    ("column_unique_value_count_to_be_between", {"column": "o_orderpriority", "min_value": 5, "max_value": 5}),
    ("column_min_to_be_between", {"column": "o_orderkey", "min_value": 0}),
    ("column_max_to_be_between", {"column": "o_orderkey", "max_value": 100}),
    ("column_sum_to_be_between", {"column": "o_custkey", "min_value": 1}),
    ("column_values_to_be_in_type_list", {"column": "o_custkey", "type_list": ["bigint"]}),
)


def order_suite() -> Q.Suite:
    return Q.Suite("orders.warning", "warning", tuple(Q.Expectation(k, kw) for k, kw in ORDER_CHECKS))


_OUT = "count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000)"
_IN = "count(*) FILTER (WHERE o_orderstatus IN ('X', 'P'))"
_RE = "count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$'))"


@query("dq_suite", " UNION ALL ".join([
    expected("column_values_to_not_be_null", "o_custkey", "count(*) = count(o_custkey)", "count(*)", "count(*) - count(o_custkey)",
             share_sql("(count(*) - count(o_custkey))", "count(*)")),
    expected("column_values_to_be_between", "o_totalprice", f"1 - {_OUT} * 1.0e0 / count(*) >= 0.7", "count(*)", _OUT, share_sql(_OUT, "count(*)")),
    expected("column_values_to_not_be_in_set", "o_orderstatus", f"{_IN} = 0", "count(*)", _IN, share_sql(_IN, "count(*)")),
    expected("column_values_to_match_regex", "o_orderpriority", f"{_RE} = 0", "count(*)", _RE, share_sql(_RE, "count(*)")),
    expected("column_to_exist", "o_orderdate", "true", "max(1)"),
    expected("table_row_count_to_be_between", "", "count(*) >= 1", "count(*)"),
    expected("column_unique_value_count_to_be_between", "o_orderpriority", "count(DISTINCT o_orderpriority) = 5", "count(DISTINCT o_orderpriority)"),
    expected("column_min_to_be_between", "o_orderkey", "min(o_orderkey) >= 0", "min(o_orderkey)"),
    expected("column_max_to_be_between", "o_orderkey", "max(o_orderkey) <= 100", "max(o_orderkey)"),
    expected("column_sum_to_be_between", "o_custkey", "sum(o_custkey) >= 1", "sum(o_custkey)"),
    expected("column_values_to_be_in_type_list", "o_custkey", "true", "max(1)"),
]))
def dq_suite(t: Tables) -> DataFrame:
    return near_all(Q.validate(t.orders, order_suite()), skip=("observed",))


_MISS = "count(*) FILTER (WHERE c_acctbal <= 0)"


@query("dq_mostly", " UNION ALL ".join(
    expected("column_values_to_not_be_null", c, s, "count(*)", _MISS, share_sql(_MISS, "count(*)"), "customer", "customers.warning")
    for c, s in (("some", f"1 - {_MISS} * 1.0e0 / count(*) >= 0.55"), ("most", f"1 - {_MISS} * 1.0e0 / count(*) >= 0.999"))))
def dq_mostly(t: Tables) -> DataFrame:
    known = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    suite = Q.Suite("customers.warning", "warning", (
        Q.Expectation("column_values_to_not_be_null", {"column": "some", "mostly": 0.55}),
        Q.Expectation("column_values_to_not_be_null", {"column": "most", "mostly": 0.999}),
    ))
    return near_all(Q.validate(t.customer.select(known.alias("some"), known.alias("most")), suite), skip=("observed",))


_DUP = "(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1))"


@query("dq_unique", " UNION ALL ".join([
    expected("column_values_to_be_unique", "l_orderkey", f"{_DUP} = 0", "count(*)", _DUP, share_sql(_DUP, "count(*)"), "lineitem", "lines.warning"),
]))
def dq_unique(t: Tables) -> DataFrame:
    suite = Q.Suite("lines.warning", "warning", (Q.Expectation("column_values_to_be_unique", {"column": "l_orderkey"}),))
    return near_all(Q.validate(t.lineitem, suite), skip=("observed",))


_OTHER = "count(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'signup', 'purchase'))"


@query("dq_distinct_set", " UNION ALL ".join([
    expected("column_distinct_values_to_equal_set", "event_type", "false", "max(4)", _OTHER, "CAST(NULL AS DOUBLE)", "events", "events.warning"),
    expected("column_distinct_values_to_be_in_set", "event_type", "true", "count(*)", "max(0)", "max(0)", "events", "events.warning"),
    expected("table_columns_to_match_set", "", "true", "max(1)", table="events", suite="events.warning"),
]))
def dq_distinct_set(t: Tables) -> DataFrame:
    kinds = ["click", "view", "signup", "purchase"]
    suite = Q.Suite("events.warning", "warning", (
        Q.Expectation("column_distinct_values_to_equal_set", {"column": "event_type", "value_set": kinds}),
        Q.Expectation("column_distinct_values_to_be_in_set", {"column": "event_type", "value_set": [*kinds, "error"]}),
        Q.Expectation("table_columns_to_match_set", {"column_set": ["event_id", "ts", "user_id", "event_type", "value", "props"]}),
    ))
    return near_all(Q.validate(t.events, suite), skip=("observed",))


@query("dq_custom_min_rows", "SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS minimum, count(*) >= 4 AS success FROM supplier")
def dq_custom_min_rows(t: Tables) -> DataFrame:
    return Q.check_minimum_rows(t.supplier, Q.minimum_rows(0.3, 0.25))


@query("dq_group_minimum", """
SELECT s_nationkey, count(s_suppkey) AS s_suppkey, count(s_acctbal) AS s_acctbal FROM supplier GROUP BY 1 HAVING count(s_suppkey) < 4""")
def dq_group_minimum(t: Tables) -> DataFrame:
    return S.groups_below(t.supplier, "s_nationkey", ["s_suppkey", "s_acctbal"], 4)


@query("dq_soft_warnings", """
SELECT 'no_risky_row' AS "check", max(CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END) = 0 AS warn FROM supplier
UNION ALL SELECT 'single_group', min(s_nationkey) = max(s_nationkey) FROM supplier""")
def dq_soft_warnings(t: Tables) -> DataFrame:
    return Q.soft_warnings(t.supplier.withColumn("is_risky", F.when(F.col("s_acctbal") < 0, 1).otherwise(0)), "is_risky", "s_nationkey")


@query("dq_same_row_count", "SELECT (SELECT count(*) FROM orders) AS n_left, (SELECT count(*) FROM lineitem) AS n_right, (SELECT count(*) FROM orders) = (SELECT count(*) FROM lineitem) AS success")
def dq_same_row_count(t: Tables) -> DataFrame:
    return Q.same_row_count(t.orders, t.lineitem)


@query("dq_above_share", "SELECT count(*) FILTER (WHERE l_discount > 0.05) AS n_above, count(*) FILTER (WHERE l_discount > 0.05) > 2 AS warn FROM lineitem")
def dq_above_share(t: Tables) -> DataFrame:
    return Q.above_share(t.lineitem, "l_discount", 0.05, 2)


@query("dq_report", """
SELECT '{"suite":"s.warning","level":"warning","expectation":"table_row_count_to_equal","column":"","success":' || CASE WHEN count(*) = count(DISTINCT c_custkey) THEN 'true' ELSE 'false' END || ',"observed":' || CAST(CAST(count(*) AS DOUBLE) AS VARCHAR) || '}' AS report FROM customer""")
def dq_report(t: Tables) -> DataFrame:
    """Result rows as JSON documents; cells without a value are left out."""
    suite = Q.Suite("s.warning", "warning", (Q.Expectation("table_row_count_to_equal", {"value": t.customer.agg(F.count_distinct("c_custkey")).first()[0]}),))
    return Q.report_json(Q.validate(t.customer, suite))


@query("dq_rows_above", "SELECT l_orderkey, l_discount FROM lineitem WHERE l_discount > 0.09")
def dq_rows_above(t: Tables) -> DataFrame:
    """The lines themselves where too many are above a share."""
    return Q.rows_above(t.lineitem, "l_orderkey", "l_discount", 0.09, 2)


# --- losses and thresholds -------------------------------------------------------------------------------

LOSS_SQL = f"""
l AS (SELECT doc_id, quality = 1 AS is_normal, {train_sql("doc_id", seed=1)} AS is_train,
             CASE WHEN n_chars > 0 THEN abs(ln(CAST(n_chars AS DOUBLE)) - 6.5e0) + CASE WHEN quality = 1 THEN 0e0 ELSE 0.75e0 END END AS loss
      FROM labels JOIN documents USING (doc_id)),
st AS (SELECT avg(loss) AS m, stddev_pop(loss) AS s FROM l WHERE is_train AND is_normal)"""


def losses(t: Tables) -> DataFrame:
    """A loss per labelled document: distance of its log length from the usual one, more for bad ones."""
    joined = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    n = F.col("n_chars")
    loss = F.when(n > 0, F.abs(F.log(n.cast("double")) - 6.5) + F.when(F.col("quality") == 1, 0.0).otherwise(0.75))
    out = joined.select("doc_id", (F.col("quality") == 1).alias("is_normal"), loss.alias("loss"))
    return split_random(out, ["doc_id"], 0.8, 1)


def train_normal(rows: DataFrame) -> DataFrame:
    return rows.filter("is_train AND is_normal")


@query("thresholds", f"WITH {LOSS_SQL} SELECT CAST(k AS DOUBLE) AS spread, {near_sql('m + k * s')} AS threshold FROM st, (SELECT unnest([0, 1, 3]) AS k)")
def thresholds(t: Tables) -> DataFrame:
    return near_all(anomaly.thresholds(train_normal(losses(t)), "loss"), skip=("spread",))


@query("flag_anomalies", f"WITH {LOSS_SQL} SELECT doc_id, CASE WHEN loss IS NULL OR loss > (SELECT m + 1 * s FROM st) THEN 1 ELSE 0 END AS prediction FROM l")
def flag_anomalies(t: Tables) -> DataFrame:
    rows = losses(t)
    stats = anomaly.loss_stats(train_normal(rows), "loss")
    return anomaly.flag_anomalies(rows, "loss", stats["mean"] + stats["std"]).select("doc_id", "prediction")


SWEEP_SQL = f"""
{LOSS_SQL},
k AS (SELECT CAST(i * 15 + 100 AS DOUBLE) / 100 AS std_scalar FROM (SELECT unnest(range(14)) AS i)),
c AS (SELECT std_scalar, m + std_scalar * s AS threshold,
        count(*) FILTER (WHERE is_normal AND loss < m + std_scalar * s) AS tn, count(*) FILTER (WHERE is_normal AND NOT coalesce(loss < m + std_scalar * s, false)) AS fp,
        count(*) FILTER (WHERE NOT is_normal AND loss < m + std_scalar * s) AS fn, count(*) FILTER (WHERE NOT is_normal AND NOT coalesce(loss < m + std_scalar * s, false)) AS tp
      FROM l, st, k WHERE NOT is_train GROUP BY std_scalar, m, s),
sw AS (SELECT std_scalar, {near_sql("threshold")} AS threshold, {near_sql("(tn + tp) / (tn + fp + fn + tp)")} AS accuracy,
        {near_sql("coalesce(tn / nullif(tn + fn, 0), 0)")} AS precision, {near_sql("coalesce(tn / nullif(tn + fp, 0), 0)")} AS recall, tn, fp, fn, tp FROM c)"""


def sweep(t: Tables) -> DataFrame:
    rows = losses(t)
    return anomaly.threshold_sweep(train_normal(rows), rows.filter("NOT is_train"), "loss", "is_normal")


@query("threshold_sweep", f"WITH {SWEEP_SQL} SELECT * FROM sw")
def threshold_sweep(t: Tables) -> DataFrame:
    return near_all(sweep(t), skip=("std_scalar",))


@query("threshold_select", f"WITH {SWEEP_SQL} SELECT * FROM sw WHERE tp >= 1 ORDER BY std_scalar DESC LIMIT 1")
def threshold_select(t: Tables) -> DataFrame:
    return near_all(anomaly.threshold_select(sweep(t), 1), skip=("std_scalar",))


# --- portfolio -------------------------------------------------------------------------------------------

STOCK_SQL = """
stocks AS (SELECT s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS is_risky, r_name AS region, n_name AS industry, s_acctbal
           FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
regions AS (SELECT r_name AS region, 0.9e0 + r_regionkey * 0.05e0 AS region_index FROM region),
industries AS (SELECT n_name AS industry, n_nationkey + 1 AS avg_return FROM nation),
model AS (SELECT name, region, is_risky, CAST(avg_return AS DOUBLE) * region_index AS expected_return
          FROM stocks LEFT JOIN regions USING (region) LEFT JOIN industries USING (industry)),
pos AS (SELECT CAST(sum(CAST(greatest(s_acctbal, 0) AS DECIMAL(28,4))) AS DOUBLE) AS total FROM supplier),
sol AS (SELECT name, region, is_risky, expected_return, greatest(s_acctbal, 0) / (SELECT total FROM pos) AS fraction,
               CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS buy FROM model JOIN stocks USING (name, region, is_risky))"""


def stock_tables(t: Tables) -> dict[str, DataFrame]:
    """Suppliers as stocks, nations as industries."""
    nations = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("industry"), F.col("n_regionkey").alias("rk"))
    named = t.region.select(F.col("r_regionkey").alias("rk"), F.col("r_name").alias("region"))
    stocks = (
        t.supplier.join(nations, "s_nationkey", "left").join(named, "rk", "left")
        .select(F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 4 == 0, 1).otherwise(0).alias("is_risky"), "region", "industry", "s_acctbal")
    )
    regions = t.region.select(F.col("r_name").alias("region"), (F.lit(0.9) + F.col("r_regionkey") * 0.05).alias("region_index"))
    industries = t.nation.select(F.col("n_name").alias("industry"), (F.col("n_nationkey") + 1).alias("avg_return"))
    return {"stocks": stocks, "regions": regions, "industries": industries, "model": A.model_table(stocks, regions, industries)}


def portfolio(t: Tables) -> dict[str, DataFrame]:
    """The stock tables and an allocation in proportion to positive balances.

    The allocation is a table of its own, as a solver would leave it.
    """
    p = stock_tables(t)
    gain = F.greatest(F.col("s_acctbal"), F.lit(0.0))
    total = t.supplier.agg(exact_sum(gain).alias("total")).scalar()
    shares = p["stocks"].select("name", (gain / total).alias("fraction"), F.when(F.col("s_acctbal") > 0, 1).otherwise(0).alias("buy"))
    return {**p, "solution": materialize(p["model"].join(shares, "name"), "solution")}


LIMITS = A.Limits(max_total_stocks=80, max_risky_stocks=15)


@query("portfolio_model", f"WITH {STOCK_SQL} SELECT name, region, is_risky, {near_sql('expected_return')} AS expected_return FROM model")
def portfolio_model(t: Tables) -> DataFrame:
    return near_all(stock_tables(t)["model"])


SLACK_SQL = f"""
{STOCK_SQL},
by_region AS (SELECT region, CAST(sum(CAST(fraction AS DECIMAL(28,9))) AS DOUBLE) AS f, CAST(sum(buy) AS DOUBLE) AS b FROM sol GROUP BY 1),
one AS (SELECT CAST(sum(CAST(fraction AS DECIMAL(28,9))) AS DOUBLE) AS f, CAST(sum(buy) AS DOUBLE) AS b,
          CAST(sum(buy) FILTER (WHERE is_risky = 1) AS DOUBLE) AS rb, CAST(sum(CAST(fraction AS DECIMAL(28,9))) FILTER (WHERE is_risky = 1) AS DOUBLE) AS rf FROM sol)"""
TOTALS_SQL = """
SELECT 'invest_all' AS constraint_name, 'all' AS entity, 1.0e0 - f AS slack FROM one UNION ALL
SELECT 'max_number_risky_sum', 'all', 15.0e0 - rb FROM one UNION ALL
SELECT 'max_fraction_risky', 'all', 0.25e0 - rf FROM one UNION ALL
SELECT 'max_number_stocks', 'all', 80.0e0 - b FROM one"""


@query("constraint_slack", f"""
WITH {SLACK_SQL}, s AS (
SELECT 'tie_buy_and_fraction_lb' AS constraint_name, name AS entity, 0.3e0 * buy - fraction AS slack FROM sol UNION ALL
SELECT 'tie_buy_and_fraction_ub', name, 0.01e0 * buy - fraction FROM sol UNION ALL
SELECT 'min_fraction_per_region', region, 0.2e0 - f FROM by_region UNION ALL
SELECT 'min_number_per_region', region, 2.0e0 - b FROM by_region UNION ALL {TOTALS_SQL})
SELECT constraint_name, entity, {near_sql('slack')} AS slack FROM s""")
def constraint_slack(t: Tables) -> DataFrame:
    return near_all(A.constraint_slack(portfolio(t)["solution"], LIMITS))


@query("portfolio_objective", f"""
WITH {SLACK_SQL}, e AS (SELECT CAST(sum(CAST(fraction * expected_return AS DECIMAL(28,9))) AS DOUBLE) AS expected_return FROM sol),
p AS (SELECT coalesce(sum(greatest(2.0e0 - b, 0) * 0.1e0), 0) AS penalty FROM by_region)
SELECT {near_sql('expected_return')} AS expected_return, {near_sql('penalty')} AS penalty, {near_sql('expected_return - penalty')} AS objective FROM e, p""")
def portfolio_objective(t: Tables) -> DataFrame:
    return near_all(A.objective(portfolio(t)["solution"], LIMITS))


@query("merge_slacks", f"""
WITH {SLACK_SQL}, tot AS ({TOTALS_SQL})
SELECT name AS stock, {near_sql('0.3e0 * buy - fraction')} AS tie_buy_and_fraction_lb, {near_sql('0.01e0 * buy - fraction')} AS tie_buy_and_fraction_ub,
  NULL AS region, CAST(NULL AS DOUBLE) AS min_fraction_per_region, CAST(NULL AS DOUBLE) AS min_number_per_region, NULL AS constraint_name, CAST(NULL AS DOUBLE) AS slack FROM sol
UNION ALL SELECT NULL, NULL, NULL, region, {near_sql('0.2e0 - f')}, {near_sql('2.0e0 - b')}, NULL, NULL FROM by_region
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, constraint_name, {near_sql('slack')} FROM tot""")
def merge_slacks(t: Tables) -> DataFrame:
    sol = portfolio(t)["solution"]
    per_stock, regional = A.stock_slacks(sol, LIMITS), A.region_slacks(sol, LIMITS)
    return near_all(
        A.merge_slacks(
            per_stock.select("name", "tie_buy_and_fraction_lb"), per_stock.select("name", "tie_buy_and_fraction_ub"),
            regional.select("region", "min_fraction_per_region"), regional.select("region", "min_number_per_region"),
            A.total_slacks(sol, LIMITS),
        )
    )


@query("portfolio_output", f"""
WITH {STOCK_SQL}
SELECT sol.name, round_even(fraction * 100, 0) AS "recommended portfolio percent", sol.is_risky, {near_sql('expected_return')} AS expected_return,
       sol.region, {near_sql('region_index')} AS region_index, stocks.industry, avg_return AS "industry average"
FROM sol LEFT JOIN stocks ON sol.name = stocks.name LEFT JOIN industries ON stocks.industry = industries.industry
LEFT JOIN regions ON sol.region = regions.region WHERE fraction > 0""")
def portfolio_output(t: Tables) -> DataFrame:
    p = portfolio(t)
    out = A.portfolio_output(p["solution"], p["model"], p["stocks"], p["industries"], p["regions"])
    return out.withColumns({"expected_return": near("expected_return"), "region_index": near("region_index")})


@query("portfolio_lines", f"""
WITH {STOCK_SQL} SELECT 'STOCK: ' || name || ' REGION: ' || region || ' RISKY: ' || is_risky || ' PORTFOLIO: ' || CAST(round_even(fraction * 100, 0) AS VARCHAR) || '%' AS line
FROM sol WHERE fraction > 0""")
def portfolio_lines(t: Tables) -> DataFrame:
    p = portfolio(t)
    return A.describe_rows(A.portfolio_output(p["solution"], p["model"], p["stocks"], p["industries"], p["regions"]))
