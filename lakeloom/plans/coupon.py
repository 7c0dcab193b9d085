"""Coupon domain over the supplied tables: transactions, feature tables and the training table.

Line items play transactions, parts play items, part sizes play coupons, orders play redemptions and
order priorities play campaigns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.scalars import days_between, flag_nonzero, safe_ratio, weekday_monday0
from lakeloom.operators import columns as C
from lakeloom.operators.features import group_features
from lakeloom.operators.joins import left_join_all, left_join_many
from lakeloom.plans.registry import Tables, near_all, near_sql, query
from lakeloom.session import materialize


def transactions(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey",
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("selling_price"),
        (-F.col("l_extendedprice") * F.col("l_discount")).alias("other_discount"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice") * F.col("l_tax")).otherwise(0.0).alias("coupon_discount"),
        F.col("l_shipdate").alias("date"),
    )
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
    return lines.join(orders, "l_orderkey").drop("l_orderkey")


def with_unit_prices(tx: DataFrame) -> DataFrame:
    return tx.withColumns(
        {
            "price_after_discount": safe_ratio("selling_price", "quantity"),
            "discount": safe_ratio("other_discount", "quantity"),
            "coupon_used": flag_nonzero("coupon_discount"),
        }
    ).withColumn("price_before_discount", F.col("price_after_discount") - F.col("discount"))


def with_date_parts(tx: DataFrame) -> DataFrame:
    return tx.withColumns(
        {"dayofmonth": F.dayofmonth("date"), "dayofweek": weekday_monday0("date"), "month": F.month("date")}
    )


CUSTOMER_MEASURES = {
    "no_of_unique_items": ("nunique", "item_id"),
    "no_of_items": ("sum", "item_id"),
    **{
        f"{kind}_{name}": (kind, column)
        for name, column in (
            ("quantity", "quantity"),
            ("price", "price_before_discount"),
            ("discount", "discount"),
            ("coupon_discount", "coupon_discount"),
        )
        for kind in ("median", "q1", "q3")
    },
    "total_coupon_used": ("sum", "coupon_used"),
    "mode_dayofmonth": ("mode", "dayofmonth"),
    "mode_dayofweek": ("mode", "dayofweek"),
    "mode_month": ("mode", "month"),
}
COUPON_MEASURES = {
    "no_of_item": ("nunique", "item_id"),
    "mode_brand": ("mode", "brand"),
    "mode_brand_type": ("mode", "brand_type"),
    "mode_category": ("mode", "category"),
    "no_of_customers": ("nunique", "customer_id"),
    "q1_quantity": ("q1", "quantity"),
    "q3_quantity": ("q3", "quantity"),
    **{
        f"{kind}_{name}": (kind, column)
        for name, column in (
            ("price", "price_before_discount"),
            ("other_discount", "discount"),
            ("coupon_discount", "coupon_discount"),
        )
        for kind in ("median", "q1", "q3")
    },
    "no_of_coupon_used": ("sum", "coupon_used"),
}


def customer_features(tx: DataFrame, **options: int) -> DataFrame:
    """18 measures per customer; ``tx`` has unit prices and date parts."""
    known = tx.filter(F.col("customer_id").isNotNull())
    return C.prefix_columns(group_features(known, "customer_id", CUSTOMER_MEASURES, **options), "customer_", ["customer_id"])


def coupon_features(coupon_items: DataFrame, tx: DataFrame, **options: int) -> DataFrame:
    """17 measures per coupon over all transactions of its items."""
    joined = left_join_many(coupon_items.filter(F.col("coupon_id").isNotNull()), tx, "item_id")
    return C.prefix_columns(group_features(joined, "coupon_id", COUPON_MEASURES, **options), "coupon_", ["coupon_id"])


def coupon_items(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_size").cast("long").alias("coupon_id"),
        F.col("p_partkey").alias("item_id"),
        F.col("p_brand").alias("brand"),
        F.substring("p_type", 1, 1).alias("brand_type"),
        F.col("p_type").alias("category"),
    )


TX_SQL = """
tx AS (
  SELECT o_custkey AS customer_id, l_partkey AS item_id, l_quantity AS quantity,
         l_extendedprice AS selling_price, -l_extendedprice * l_discount AS other_discount,
         CASE WHEN l_returnflag = 'R' THEN -l_extendedprice * l_tax ELSE 0.0 END AS coupon_discount,
         l_shipdate AS date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
priced AS (
  SELECT *, selling_price / nullif(quantity, 0) AS price_after_discount,
         other_discount / nullif(quantity, 0) AS discount,
         selling_price / nullif(quantity, 0) - other_discount / nullif(quantity, 0) AS price_before_discount,
         CASE WHEN coupon_discount IS DISTINCT FROM 0 THEN 1 ELSE 0 END AS coupon_used,
         CAST(day(date) AS INTEGER) AS dayofmonth, CAST(isodow(date) - 1 AS INTEGER) AS dayofweek,
         CAST(month(date) AS INTEGER) AS month
  FROM tx)"""


def _mode_sql(source: str, key: str, column: str) -> str:
    return (
        f"(SELECT {key}, {column} AS v FROM (SELECT {key}, {column}, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY count(*) DESC, {column}) AS rn FROM {source} WHERE {column} IS NOT NULL GROUP BY {key}, {column}) WHERE rn = 1)"
    )


def _features_sql(source: str, key: str, prefix: str, measures: dict) -> str:
    aggs, modes, out = [], [], []
    for name, (kind, c) in measures.items():
        full = prefix + name
        if kind == "mode":
            modes.append(f"LEFT JOIN {_mode_sql(source, key, c)} AS m_{name} USING ({key})")
            out.append(f"m_{name}.v AS {full}")
            continue
        expr = {
            "nunique": f"count(DISTINCT {c}) + count(*) FILTER (WHERE {c} IS NULL)",
            "sum": f"CAST(coalesce(sum({c}), 0) AS BIGINT)",
            "median": near_sql(f"quantile_cont({c}, 0.5)"),
            "q1": near_sql(f"quantile_cont({c}, 0.25)"),
            "q3": near_sql(f"quantile_cont({c}, 0.75)"),
        }[kind]
        aggs.append(f"{expr} AS {full}")
        out.append(f"g.{full}")
    return (
        f"SELECT {key}, {', '.join(out)} FROM (SELECT {key}, {', '.join(aggs)} FROM {source} GROUP BY {key}) AS g "
        + " ".join(modes)
    )


CUSTOMER_SQL = f"WITH {TX_SQL} " + _features_sql("priced", "customer_id", "customer_", CUSTOMER_MEASURES)
COUPON_JOINED_SQL = """
items AS (SELECT CAST(p_size AS BIGINT) AS coupon_id, p_partkey AS item_id, p_brand AS brand,
                 substr(p_type, 1, 1) AS brand_type, p_type AS category FROM part),
joined AS (SELECT * FROM items LEFT JOIN priced USING (item_id))"""
COUPON_SQL = f"WITH {TX_SQL}, {COUPON_JOINED_SQL} " + _features_sql("joined", "coupon_id", "coupon_", COUPON_MEASURES)


def needed_transactions(t: Tables, key: str, measures: dict) -> DataFrame:
    """The joined transactions with the columns that the measures read, written once: they are counted and then grouped."""
    tx = with_date_parts(with_unit_prices(transactions(t)))
    return materialize(tx.select(*dict.fromkeys([key, *(c for _, c in measures.values() if c in tx.columns)])), "transactions")


@query("customer_features", CUSTOMER_SQL)
def q_customer_features(t: Tables) -> DataFrame:
    return near_all(customer_features(needed_transactions(t, "customer_id", CUSTOMER_MEASURES)))


@query("coupon_features", COUPON_SQL)
def q_coupon_features(t: Tables) -> DataFrame:
    return near_all(coupon_features(coupon_items(t), needed_transactions(t, "item_id", COUPON_MEASURES)))


@query("unit_prices", f"""
WITH {TX_SQL}
SELECT customer_id, item_id, quantity, {near_sql("price_after_discount")} AS price_after_discount,
       {near_sql("discount")} AS discount, {near_sql("price_before_discount")} AS price_before_discount, coupon_used
FROM priced""")
def q_unit_prices(t: Tables) -> DataFrame:
    tx = with_unit_prices(transactions(t))
    keep = ["customer_id", "item_id", "quantity", "price_after_discount", "discount", "price_before_discount", "coupon_used"]
    return near_all(tx.select(*keep), skip=("quantity",))


def campaigns(t: Tables) -> DataFrame:
    """First and last order day per priority."""
    return t.orders.groupBy(F.col("o_orderpriority").alias("campaign_type")).agg(
        F.min("o_orderdate").alias("start_date"), F.max("o_orderdate").alias("end_date")
    )


def campaign_days(df: DataFrame) -> DataFrame:
    """Length in whole days; the date columns are dropped."""
    return C.drop_columns_containing(df.withColumn("campaign_duration", days_between("end_date", "start_date")), "date")


@query("campaign_duration", """
SELECT o_orderpriority AS campaign_type, CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS BIGINT) AS campaign_duration
FROM orders GROUP BY 1""")
def q_campaign_duration(t: Tables) -> DataFrame:
    return campaign_days(campaigns(t))


def redemptions(t: Tables) -> DataFrame:
    """Orders as redemption log; P orders have no known status. The coupon of an order is its key modulo 50."""
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).alias("redemption_status"),
        F.col("o_orderpriority").alias("campaign_type"),
        (F.col("o_orderkey") % 50 + 1).alias("coupon_id"),
        F.col("o_custkey").alias("customer_id"),
    )


REDEMPTION_SQL = """
red AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS redemption_status,
               o_orderpriority AS campaign_type, o_orderkey % 50 + 1 AS coupon_id, o_custkey AS customer_id FROM orders)"""


def demographics(t: Tables) -> DataFrame:
    """Customers as demographics; every seventh has no segment."""
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("age_range"),
        F.col("c_nationkey").alias("income_bracket"),
    )


DEMOGRAPHICS_SQL = """
demo AS (SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS age_range,
                c_nationkey AS income_bracket FROM customer)"""


def training_table(redemption: DataFrame, coupons: DataFrame, campaign: DataFrame, demo: DataFrame, customers: DataFrame) -> DataFrame:
    """Redemptions with all features joined on, id columns dropped by name."""
    big = left_join_all(
        redemption, [(coupons, "coupon_id"), (campaign, "campaign_type"), (demo, "customer_id"), (customers, "customer_id")]
    )
    return big.select([c for c in big.columns if "id" not in c])


def build_training_table(t: Tables) -> DataFrame:
    # five later steps read the transactions
    tx = materialize(with_date_parts(with_unit_prices(transactions(t))), "transactions")
    labelled = redemptions(t).na.drop(subset=["redemption_status"])
    demo = C.LabelEncoder.fit(demographics(t), ["age_range"]).apply(demographics(t))
    return training_table(labelled, coupon_features(coupon_items(t), tx), campaign_days(campaigns(t)), demo, customer_features(tx))


def _without_id(key: str, prefix: str, measures: dict) -> str:
    return ", ".join(prefix + m for m in measures if "id" not in prefix + m)


@query("training_table", f"""
WITH {TX_SQL}, {COUPON_JOINED_SQL}, {REDEMPTION_SQL}, {DEMOGRAPHICS_SQL},
cf AS ({_features_sql("joined", "coupon_id", "coupon_", COUPON_MEASURES)}),
cu AS ({_features_sql("priced", "customer_id", "customer_", CUSTOMER_MEASURES)}),
camp AS (SELECT o_orderpriority AS campaign_type,
                CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS BIGINT) AS campaign_duration FROM orders GROUP BY 1),
codes AS (SELECT age_range, row_number() OVER (ORDER BY age_range) - 1 AS code
          FROM (SELECT DISTINCT age_range FROM demo WHERE age_range IS NOT NULL))
SELECT redemption_status, campaign_type, {_without_id("coupon_id", "coupon_", COUPON_MEASURES)}, campaign_duration,
       codes.code AS age_range, income_bracket, {_without_id("customer_id", "customer_", CUSTOMER_MEASURES)}
FROM red LEFT JOIN cf USING (coupon_id) LEFT JOIN camp USING (campaign_type)
LEFT JOIN demo USING (customer_id) LEFT JOIN codes ON codes.age_range = demo.age_range LEFT JOIN cu USING (customer_id)
WHERE redemption_status IS NOT NULL""")
def q_training_table(t: Tables) -> DataFrame:
    return near_all(build_training_table(t))
