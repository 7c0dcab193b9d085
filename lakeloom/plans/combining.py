"""Joins, group summaries and profiles over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.aggregates import distinct_with_nulls, exact_sum
from lakeloom.functions.scalars import match_probability
from lakeloom.operators import joins as J
from lakeloom.operators import summaries as S
from lakeloom.operators.features import HOT_ROWS, group_features
from lakeloom.plans.registry import Tables, near, near_all, near_sql, query


@query("left_join", "SELECT o_orderkey, o_custkey AS c_custkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def left_join(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return J.left_join(orders, t.customer.select("c_custkey", "c_name", "c_mktsegment"), "c_custkey")


@query("left_join_all", """
SELECT l_orderkey, l_partkey, l_quantity, o_orderstatus, c_mktsegment, n_name, r_name
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def left_join_all(t: Tables) -> DataFrame:
    joined = J.left_join_all(
        t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"),
        [
            (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("custkey"), "o_orderstatus"), "l_orderkey"),
            (t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey"), "c_mktsegment"), "custkey"),
            (t.nation.select(F.col("n_nationkey").alias("nationkey"), F.col("n_regionkey").alias("regionkey"), "n_name"), "nationkey"),
            (t.region.select(F.col("r_regionkey").alias("regionkey"), "r_name"), "regionkey"),
        ],
    )
    return joined.select("l_orderkey", "l_partkey", "l_quantity", "o_orderstatus", "c_mktsegment", "n_name", "r_name")


@query("left_join_shared_key", """
SELECT doc_id, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)""")
def left_join_shared_key(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "source")
    return J.left_join_on([docs, t.documents.select("doc_id", "n_chars"), t.labels], "doc_id")


@query("full_outer_join", """
SELECT c_custkey AS customer, user_id AS visitor, c_mktsegment AS segment, visits FROM customer
FULL JOIN (SELECT user_id, count(*) AS visits FROM events GROUP BY 1) ON c_custkey = user_id""")
def full_outer_join(t: Tables) -> DataFrame:
    """All customers and all visitors, matched or not."""
    a = t.customer.select(F.col("c_custkey").alias("customer"), F.col("c_mktsegment").alias("segment"))
    b = t.events.groupBy(F.col("user_id").alias("visitor")).agg(F.count(F.lit(1)).alias("visits"))
    return J.full_outer_join(a, b, "customer", "visitor")


@query("natural_inner_join", """
SELECT doc_id, quality, toxic, lang, n_chars FROM labels JOIN documents USING (doc_id)""")
def natural_inner_join(t: Tables) -> DataFrame:
    return J.natural_inner_join(t.labels, t.documents.select("doc_id", "lang", "n_chars"))


@query("optional_join", "SELECT o_custkey AS c_custkey, o_orderkey, o_orderstatus, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def optional_join(t: Tables) -> DataFrame:
    """One optional table is there, the other is not."""
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    named = J.optional_left_join(orders, t.customer.select("c_custkey", "c_name"), "c_custkey")
    return J.optional_left_join(named, None, "c_custkey")


@query("cross_grid", f"""
SELECT l1, l2, count(*) AS n, {near_sql("greatest(0e0, 0.85e0 - 0.25e0 * abs(l1 - l2))")} AS p
FROM (SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS l1 FROM orders), (SELECT unnest([1, 2, 3, 4, 5]) AS l2) GROUP BY l1, l2""")
def cross_grid(t: Tables) -> DataFrame:
    """Click probability of every order level against five ad levels; levels are counted before they are paired."""
    levels = t.orders.groupBy(F.substring("o_orderpriority", 1, 1).cast("int").alias("l1")).agg(F.count(F.lit(1)).alias("n"))
    grid = J.expand_grid(levels, l2=[1, 2, 3, 4, 5])
    return grid.withColumn("p", near(match_probability("l1", "l2")))


@query("anti_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def anti_join(t: Tables) -> DataFrame:
    taken = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return J.anti_join(t.customer.select("c_custkey", "c_name"), taken, "c_custkey")


@query("null_safe_join", """
WITH a AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders),
b AS (SELECT status, count(*) AS n FROM a GROUP BY 1)
SELECT a.o_orderkey, a.status, b.n FROM a LEFT JOIN b ON a.status IS NOT DISTINCT FROM b.status""")
def null_safe_join(t: Tables) -> DataFrame:
    """Orders without a known status find the count of such orders."""
    a = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    return J.null_safe_join(a, a.groupBy("status").agg(F.count(F.lit(1)).alias("n")), ["status"])


# --- aggregations ----------------------------------------------------------------------------------------


@query("quantiles", f"""
SELECT l_suppkey, {near_sql("quantile_cont(l_extendedprice, 0.25)")} AS q1, {near_sql("quantile_cont(l_extendedprice, 0.5)")} AS median,
       {near_sql("quantile_cont(l_extendedprice, 0.75)")} AS q3 FROM lineitem GROUP BY 1""")
def quantiles(t: Tables) -> DataFrame:
    measures = {k: (k, "l_extendedprice") for k in ("q1", "median", "q3")}
    return near_all(group_features(t.lineitem, "l_suppkey", measures, HOT_ROWS))


@query("quantiles_hot_groups", f"""
SELECT l_returnflag, {near_sql("quantile_cont(l_extendedprice, 0.25)")} AS q1, {near_sql("quantile_cont(l_extendedprice, 0.5)")} AS median,
       {near_sql("quantile_cont(l_extendedprice, 0.75)")} AS q3, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1""")
def quantiles_hot_groups(t: Tables) -> DataFrame:
    """The path for groups too large for one task, on three groups that hold a third of all rows each."""
    measures = {**{k: (k, "l_extendedprice") for k in ("q1", "median", "q3")}, "parts": ("nunique", "l_partkey")}
    return near_all(group_features(t.lineitem, "l_returnflag", measures, hot_rows=1_000, rows_per_cut=10_000))


@query("quantiles_hot_decimal", f"""
WITH l AS (SELECT l_returnflag, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_quantity AS DECIMAL(6,1)) AS q FROM lineitem),
m AS (SELECT l_returnflag, q, row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, q) AS rn FROM l GROUP BY l_returnflag, q)
SELECT l.l_returnflag, {near_sql("quantile_cont(CAST(p AS DOUBLE), 0.25)")} AS q1, {near_sql("quantile_cont(CAST(p AS DOUBLE), 0.5)")} AS median,
       {near_sql("quantile_cont(CAST(p AS DOUBLE), 0.75)")} AS q3, CAST(max(m.q) AS DOUBLE) AS often FROM l JOIN m ON l.l_returnflag = m.l_returnflag AND m.rn = 1 GROUP BY 1""")
def quantiles_hot_decimal(t: Tables) -> DataFrame:
    """The same path on decimal columns."""
    lines = t.lineitem.select("l_returnflag", F.col("l_extendedprice").cast("decimal(12,2)").alias("p"), F.col("l_quantity").cast("decimal(6,1)").alias("q"))
    measures = {**{k: (k, "p") for k in ("q1", "median", "q3")}, "often": ("mode", "q")}
    found = group_features(lines, "l_returnflag", measures, hot_rows=1_000, rows_per_cut=10_000)
    return near_all(found.withColumn("often", F.col("often").cast("double")), skip=("often",))


@query("distinct_with_nulls", """
SELECT o_orderpriority, count(DISTINCT k) + count(*) FILTER (WHERE k IS NULL) AS n
FROM (SELECT o_orderpriority, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS k FROM orders) GROUP BY 1""")
def distinct_nulls(t: Tables) -> DataFrame:
    some = t.orders.select("o_orderpriority", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("k"))
    return some.groupBy("o_orderpriority").agg(distinct_with_nulls("k").alias("n"))


@query("group_count_min", """
SELECT c_nationkey, count(b) AS balance, count(s) AS segment FROM (
  SELECT c_nationkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS b, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS s FROM customer)
GROUP BY 1 HAVING least(count(b), count(s)) < 50""")
def group_count_min(t: Tables) -> DataFrame:
    some = t.customer.select(
        "c_nationkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
    )
    return S.groups_below(some, "c_nationkey", ["balance", "segment"], 50)


@query("group_sum", """
SELECT n_nationkey, n_name, CAST(sum(CAST(c_acctbal AS DECIMAL(28,4))) AS DOUBLE) AS balance, CAST(count(c_custkey) AS BIGINT) AS customers
FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def group_sum(t: Tables) -> DataFrame:
    people = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_acctbal").cast("decimal(28,4)").alias("b"), F.lit(1).alias("one"))
    out = S.add_group_sums(t.nation.select("n_nationkey", "n_name"), people, "n_nationkey", {"balance": "b", "customers": "one"})
    return out.withColumn("balance", F.col("balance").cast("double"))


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(t: Tables) -> DataFrame:
    return S.value_counts(t.events, "event_type")


@query("count_rows", "SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders FROM lineitem")
def count_rows(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("l_orderkey").alias("n_orders"))


@query("count_distinct", "SELECT count(DISTINCT l_partkey) AS n_distinct FROM lineitem")
def count_distinct(t: Tables) -> DataFrame:
    return S.distinct_count(t.lineitem, "l_partkey")


@query("approx_distinct", "SELECT count(DISTINCT l_partkey) AS n_exact, true AS is_close FROM lineitem")
def approx_distinct(t: Tables) -> DataFrame:
    """The approximate count beside the exact one: it has to be within a tenth."""
    exact = S.distinct_count(t.lineitem, "l_partkey").withColumnRenamed("n_distinct", "n_exact")
    estimate = S.distinct_count(t.lineitem, "l_partkey", precise=False).scalar()
    return exact.withColumn("is_close", F.abs(estimate - F.col("n_exact")) * 10 <= F.col("n_exact"))


@query("moments", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, {near_sql(f'avg({c})')} AS mean, {near_sql(f'stddev_samp({c})')} AS std, "
    f"{near_sql(f'min({c})')} AS min, {near_sql(f'max({c})')} AS max FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount")))
def moments(t: Tables) -> DataFrame:
    return near_all(S.moments(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]))


LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {near_sql(f'corr({a}, {b})')} AS r FROM lineitem" for a in LINE_NUMBERS for b in LINE_NUMBERS))
def corr_matrix(t: Tables) -> DataFrame:
    return near_all(S.corr_matrix(t.lineitem, LINE_NUMBERS))


def _profile_sql(c: str, kind: str, numeric: bool) -> str:
    stats = (
        [near_sql(f"avg({c})"), near_sql(f"stddev_samp({c})"), near_sql(f"min({c})"), near_sql(f"max({c})")]
        if numeric else ["CAST(NULL AS DOUBLE)"] * 4
    )
    return (
        f"SELECT '{c}' AS \"column\", '{kind}' AS type, count(*) AS n_rows, count(*) - count({c}) AS n_missing, "
        f"{near_sql(f'(count(*) - count({c})) / count(*)')} AS share_missing, count(DISTINCT {c}) AS n_distinct, "
        f"{stats[0]} AS mean, {stats[1]} AS std, {stats[2]} AS min, {stats[3]} AS max FROM p"
    )


@query("profile_table", "WITH p AS (SELECT doc_id, lang, n_chars, quality FROM documents LEFT JOIN labels USING (doc_id)) " + " UNION ALL ".join(
    [_profile_sql("doc_id", "bigint", True), _profile_sql("lang", "string", False), _profile_sql("n_chars", "bigint", True), _profile_sql("quality", "int", True)]))
def profile_table(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "lang", "n_chars").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return near_all(S.profile_table(docs, precise_distinct=True))


@query("missing_pattern", """
SELECT CASE WHEN quality IS NULL THEN '1' ELSE '0' END || CASE WHEN n_chars > 500 THEN '0' ELSE '1' END AS pattern, count(*) AS n
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def missing_pattern(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", F.when(F.col("n_chars") > 500, F.col("n_chars")).alias("long"))
    return S.missing_patterns(docs.join(t.labels, "doc_id", "left"), ["quality", "long"])


@query("histogram", """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT CAST(least(floor((value - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS bin, count(*) AS n FROM events, s GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, coalesce(n, 0) AS n FROM (SELECT unnest(range(30)) AS bin) g LEFT JOIN b ON g.bin = b.bin""")
def histogram(t: Tables) -> DataFrame:
    return S.histogram(t.events, "value", 30)


@query("arg_min", """
SELECT c_mktsegment, arg_min(c_custkey, (c_acctbal, c_custkey)) AS best FROM customer GROUP BY 1""")
def arg_min(t: Tables) -> DataFrame:
    return S.best_by(t.customer, ["c_mktsegment"], "c_custkey", "c_acctbal")


@query("arg_max", """
SELECT event_type, arg_min(event_id, (-value, event_id)) AS best FROM events GROUP BY 1""")
def arg_max(t: Tables) -> DataFrame:
    return S.best_by(t.events, ["event_type"], "event_id", "value", smallest=False)


@query("run_summary", """
SELECT (SELECT count(*) FROM orders) AS all_runs, CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'passed' END AS outcome, count(*) AS qty
FROM orders GROUP BY 2""")
def run_summary(t: Tables) -> DataFrame:
    return S.run_summary(t.orders, F.col("o_orderstatus") == "F")


@query("run_records", """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'passed' END AS outcome,
       '{"run_id":"' || o_orderkey || '","status":"' || o_orderstatus || '","scope":"' || o_orderpriority || '"}' AS record FROM orders""")
def run_records(t: Tables) -> DataFrame:
    fields = {"run_id": F.col("o_orderkey"), "status": F.col("o_orderstatus"), "scope": F.col("o_orderpriority")}
    return S.run_records(t.orders, F.col("o_orderstatus") == "F", fields)


@query("group_totals", """
SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(28,4))) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def group_totals(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total"))
