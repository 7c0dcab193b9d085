"""Running metrics, regret, batches, resampling, backfill and forecasts over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.scalars import match_probability, seconds_of
from lakeloom.operators import series
from lakeloom.operators.ordering import next_known, running
from lakeloom.plans.registry import Tables, near, near_all, near_sql, query

ORDER = ["ts", "event_id"]


def clicks(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts", "user_id", F.when(F.col("event_type") == "click", 1).otherwise(0).cast("long").alias("click"))


@query("running_ctr", f"""
SELECT event_id, user_id, {near_sql("avg(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)", 9)} AS ctr
FROM events""")
def running_ctr(t: Tables) -> DataFrame:
    out = series.running_mean(clicks(t), ["user_id"], ORDER, seconds_of("ts"), "click", "ctr")
    return out.select("event_id", "user_id", near("ctr", 9).alias("ctr"))


@query("running_ctr_overall", f"""
SELECT event_id, {near_sql("avg(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)", 9)} AS ctr
FROM events""")
def running_ctr_overall(t: Tables) -> DataFrame:
    """One sequence over the whole table, cut into parts of 2,000 rows that run side by side."""
    out = series.running_mean(clicks(t), [], ORDER, seconds_of("ts"), "click", "ctr", rows_per_cut=2_000)
    return out.select("event_id", near("ctr", 9).alias("ctr"))


LEVELS = (1, 2, 3, 4, 5)


@query("cumulative_regret", """
WITH i AS (SELECT event_id, ts, user_id, user_id % 5 + 1 AS education, event_id % 5 + 1 AS shown FROM events),
r AS (SELECT *, (SELECT max(greatest(0.0, 0.85 - 0.25 * abs(a - education))) FROM (SELECT unnest([1, 2, 3, 4, 5]) AS a) WHERE a = shown OR (event_id + a) % 3 <> 0)
        - greatest(0.0, 0.85 - 0.25 * abs(shown - education)) AS regret FROM i)
SELECT event_id, user_id, CAST(sum(CAST(regret AS DECIMAL(12,4))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total_regret FROM r""")
def cumulative_regret(t: Tables) -> DataFrame:
    """Regret of the shown ad against the best ad on offer, summed up per user."""
    education, shown = F.col("user_id") % 5 + 1, F.col("event_id") % 5 + 1
    offered = [
        F.when((shown == a) | ((F.col("event_id") + a) % 3 != 0), match_probability(F.lit(a), education)).otherwise(0.0)
        for a in LEVELS
    ]
    lost = series.regret(match_probability(shown, education), offered).cast("decimal(12,4)")
    rows = t.events.select("event_id", "ts", "user_id", lost.alias("regret"))
    out = running(rows, ["user_id"], ORDER, seconds_of("ts"), {"total_regret": "regret"})
    return out.select("event_id", "user_id", F.col("total_regret").cast("double"))


@query("batch_metrics", """
SELECT user_id, (rn - 1) // 25 AS batch, count(*) AS n, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) GROUP BY 1, 2""")
def batch_metrics(t: Tables) -> DataFrame:
    out = series.batch_number(clicks(t), ["user_id"], ORDER, seconds_of("ts"), 25)
    return out.groupBy("user_id", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("click").alias("clicks"))


@query("select_best", """
SELECT user_id, arg_max(event_type, (value, event_id)) AS best FROM events GROUP BY 1""")
def select_best(t: Tables) -> DataFrame:
    return series.select_best(t.events, ["user_id"], "value", "event_id", "event_type")


MONTHLY = f"""
m AS (SELECT o_custkey, date_trunc('month', o_orderdate) AS month, avg(o_totalprice) AS value FROM orders GROUP BY 1, 2),
cal AS (SELECT o_custkey, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM m GROUP BY 1),
full_months AS (SELECT o_custkey, month, value FROM cal LEFT JOIN m USING (o_custkey, month))"""


@query("resample_month", f"""
WITH {MONTHLY} SELECT o_custkey, strftime(month, '%Y-%m') AS month, {near_sql('value')} AS value FROM full_months""")
def resample_month(t: Tables) -> DataFrame:
    """Monthly mean order value per customer; months without orders are kept empty."""
    out = series.resample_month(t.orders, ["o_custkey"], "o_orderdate", "o_totalprice")
    return out.select("o_custkey", F.date_format("month", "yyyy-MM").alias("month"), near("value").alias("value"))


@query("monthly_backfill", f"""
WITH {MONTHLY} SELECT o_custkey, strftime(month, '%Y-%m') AS month,
  {near_sql("first_value(value IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")} AS value FROM full_months""")
def monthly_backfill(t: Tables) -> DataFrame:
    monthly = series.resample_month(t.orders, ["o_custkey"], "o_orderdate", "o_totalprice")
    out = series.backfill(monthly, ["o_custkey"], "month", "value")
    return out.select("o_custkey", F.date_format("month", "yyyy-MM").alias("month"), near("value").alias("value"))


@query("event_backfill", """
SELECT event_id, event_type, first_value(CASE WHEN event_id % 4 = 0 THEN value END IGNORE NULLS) OVER (
  PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled FROM events""")
def event_backfill(t: Tables) -> DataFrame:
    """Backfill along raw rows, where five event types hold a fifth of all rows each."""
    rows = t.events.select("event_id", "ts", "event_type", F.when(F.col("event_id") % 4 == 0, F.col("value")).alias("known"))
    out = next_known(rows, ["event_type"], ORDER, seconds_of("ts"), "known", "filled", rows_per_cut=2_000)
    return out.select("event_id", "event_type", "filled")


def segment_months(t: Tables) -> DataFrame:
    monthly = series.resample_month(t.orders, ["o_orderpriority"], "o_orderdate", "o_totalprice")
    return series.backfill(monthly, ["o_orderpriority"], "month", "value")


@query("seasonal_naive", f"""
WITH m AS (SELECT o_orderpriority, date_trunc('month', o_orderdate) AS month, avg(o_totalprice) AS value FROM orders GROUP BY 1, 2),
cal AS (SELECT o_orderpriority, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM m GROUP BY 1),
f AS (SELECT o_orderpriority, month, first_value(value IGNORE NULLS) OVER (PARTITION BY o_orderpriority ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value
      FROM cal LEFT JOIN m USING (o_orderpriority, month)),
l AS (SELECT o_orderpriority, max(month) AS last FROM f GROUP BY 1)
SELECT o_orderpriority, strftime(month + to_months(CAST(12 * k AS INTEGER)), '%Y-%m') AS month, {near_sql('value')} AS forecast
FROM f JOIN l USING (o_orderpriority), (SELECT unnest(range(1, 18)) AS k)
WHERE month > last - INTERVAL 12 MONTH AND month + to_months(CAST(12 * k AS INTEGER)) <= last + INTERVAL 200 MONTH""")
def seasonal_naive(t: Tables) -> DataFrame:
    """200 months ahead per priority, each month repeating the same month of the last year."""
    out = series.seasonal_naive(segment_months(t), ["o_orderpriority"], "month", "value", 200)
    return out.select("o_orderpriority", F.date_format("month", "yyyy-MM").alias("month"), near("forecast").alias("forecast"))


GRID_SQL = ", ".join(f"({i}, {a}e0, {g}e0)" for i, (a, g) in enumerate((a, g) for a in (0.1, 0.3, 0.5, 0.8) for g in (0.1, 0.3, 0.5, 0.8)))


@query("seasonal_forecast", f"""
WITH RECURSIVE m AS (SELECT c_nationkey, date_trunc('month', o_orderdate) AS month, avg(o_totalprice) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
cal AS (SELECT c_nationkey, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM m GROUP BY 1),
f AS (SELECT c_nationkey, month, first_value(value IGNORE NULLS) OVER (PARTITION BY c_nationkey ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value
      FROM cal LEFT JOIN m USING (c_nationkey, month)),
y AS (SELECT c_nationkey, max(month) AS last, list(value ORDER BY month) AS y FROM f GROUP BY 1),
l AS (SELECT *, list_sum(y[1:12]) / len(y[1:12]) AS level FROM y),
g(grid, a, g) AS (VALUES {GRID_SQL}),
r AS (
  SELECT c_nationkey, grid, a, g, 12 AS i, level, list_transform(range(0, 12), lambda k: CASE WHEN k < len(y) THEN y[k + 1] - level ELSE 0e0 END) AS seasonal, 0e0 AS squares FROM l, g
  UNION ALL
  SELECT c_nationkey, grid, a, g, i + 1, next, list_transform(range(0, 12), lambda k: CASE WHEN k = i % 12 THEN g * (v - next) + (1 - g) * s ELSE seasonal[k + 1] END), squares + missed * missed
  FROM (SELECT r.*, l.y[i + 1] AS v, seasonal[i % 12 + 1] AS s, a * (l.y[i + 1] - seasonal[i % 12 + 1]) + (1 - a) * r.level AS next, l.y[i + 1] - (r.level + seasonal[i % 12 + 1]) AS missed
        FROM r JOIN l USING (c_nationkey) WHERE i < len(y))
), e AS (SELECT r.*, len(y) AS n, last, CASE WHEN len(y) > 12 THEN squares / (len(y) - 12) ELSE 0e0 END AS error FROM r JOIN l USING (c_nationkey) WHERE i = greatest(len(y), 12)),
b AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY error, grid) = 1)
SELECT c_nationkey, strftime(last + to_months(CAST(k AS INTEGER)), '%Y-%m') AS month, {near_sql("level + seasonal[CAST((n + k - 1) % 12 AS INTEGER) + 1]", 3)} AS forecast,
  {near_sql("level + seasonal[CAST((n + k - 1) % 12 AS INTEGER) + 1] - 1.96e0 * sqrt(error)", 3)} AS lower, {near_sql("sqrt(error)", 3)} AS deviation
FROM b, (SELECT unnest(range(1, 201)) AS k)""")
def seasonal_forecast(t: Tables) -> DataFrame:
    """Smoothed seasonal forecast with interval, 200 months ahead per customer nation."""
    orders = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    monthly = series.resample_month(orders, ["c_nationkey"], "o_orderdate", "o_totalprice")
    filled = series.backfill(monthly, ["c_nationkey"], "month", "value")
    out = series.forecast_grid(filled, {"c_nationkey": "int"}, "month", "value", 200)
    return out.select("c_nationkey", F.date_format("month", "yyyy-MM").alias("month"), near("forecast", 3).alias("forecast"), near("lower", 3).alias("lower"), near(F.sqrt("error"), 3).alias("deviation"))
