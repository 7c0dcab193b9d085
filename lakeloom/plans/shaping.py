"""Projections, recodes, filters, sorts, set operations and scalar functions over the supplied tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import scalars as fn
from lakeloom.functions.aggregates import exact_sum
from lakeloom.operators import columns as C
from lakeloom.operators import rows as R
from lakeloom.operators.ordering import numbered
from lakeloom.plans.registry import Tables, hash_sql, near_all, near_sql, query, train_sql


@query("drop_columns", "SELECT o_totalprice FROM orders")
def drop_columns(t: Tables) -> DataFrame:
    return C.drop_columns_containing(t.orders, "date", "key", "order")


@query("keep_columns_regex", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def keep_columns_regex(t: Tables) -> DataFrame:
    return C.keep_matching(C.drop_matching(t.lineitem, "^l_ship"), "key$")


@query("prefix_columns", "SELECT c_custkey, c_name AS cust_c_name, c_acctbal AS cust_c_acctbal FROM customer")
def prefix_columns(t: Tables) -> DataFrame:
    return C.prefix_columns(t.customer.select("c_custkey", "c_name", "c_acctbal"), "cust_", ["c_custkey"])


@query("standardize_names", "SELECT l_quantity AS line_quantity, l_discount AS \"line_discount\" FROM lineitem")
def standardize_names(t: Tables) -> DataFrame:
    named = t.lineitem.select(F.col("l_quantity").alias("Line Quantity (pieces)"), F.col("l_discount").alias("LINE Discount share"))
    return C.lower_names(C.two_word_names(named))


@query("cast_columns", "SELECT c_custkey, TRY_CAST(c_nationkey AS DOUBLE) AS c_nationkey, TRY_CAST(c_mktsegment AS DOUBLE) AS c_mktsegment FROM customer")
def cast_columns(t: Tables) -> DataFrame:
    return C.cast_columns(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), ["c_nationkey", "c_mktsegment"], "double")


NUMERIC_TEXT = """
(SELECT event_id, CASE event_id % 3 WHEN 0 THEN json_extract_string(props, '$.k') WHEN 1 THEN CAST(value AS VARCHAR) ELSE event_type END AS txt FROM events)"""


@query("cast_numeric", f"""
SELECT event_id, txt, CAST(CASE WHEN TRY_CAST(txt AS DOUBLE) = floor(TRY_CAST(txt AS DOUBLE)) THEN TRY_CAST(txt AS DOUBLE) END AS BIGINT) AS txt_int,
       CASE WHEN TRY_CAST(txt AS DOUBLE) <> floor(TRY_CAST(txt AS DOUBLE)) THEN TRY_CAST(txt AS DOUBLE) END AS txt_float,
       TRY_CAST(txt AS DOUBLE) IS NOT NULL AS txt_is_numeric
FROM {NUMERIC_TEXT}""")
def cast_numeric(t: Tables) -> DataFrame:
    """Whole numbers, fractions and words told apart."""
    kind = F.col("event_id") % 3
    text = (
        F.when(kind == 0, F.get_json_object("props", "$.k"))
        .when(kind == 1, F.col("value").cast("string"))
        .otherwise(F.col("event_type"))
    )
    return C.cast_numeric(t.events.select("event_id", text.alias("txt")), "txt")


@query("recode_segments", """
SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'industry' WHEN 'AUTOMOBILE' THEN 'industry' WHEN 'HOUSEHOLD' THEN 'home'
       WHEN 'FURNITURE' THEN 'home' ELSE c_mktsegment END AS segment,
       CASE WHEN c_mktsegment IN ('BUILDING') THEN c_mktsegment ELSE 'non-building' END AS is_building
FROM customer""")
def recode_segments(t: Tables) -> DataFrame:
    mapping = {"MACHINERY": "industry", "AUTOMOBILE": "industry", "HOUSEHOLD": "home", "FURNITURE": "home"}
    return t.customer.select(
        "c_custkey",
        fn.recode("c_mktsegment", mapping).alias("segment"),
        fn.recode_else("c_mktsegment", ["BUILDING"], "non-building").alias("is_building"),
    )


@query("conditional_category", """
WITH a AS (SELECT p_partkey, p_type, CASE WHEN p_name LIKE 'red%' OR p_name LIKE 'hot%' THEN 'other' ELSE p_name END AS occupation FROM part)
SELECT p_partkey, CASE WHEN contains(p_type, 'ECON') AND occupation = 'other' THEN occupation || '-2' ELSE occupation END AS occupation FROM a""")
def conditional_category(t: Tables) -> DataFrame:
    moved = t.part.select(
        "p_partkey", "p_type",
        F.when(F.col("p_name").startswith("red") | F.col("p_name").startswith("hot"), "other").otherwise(F.col("p_name")).alias("occupation"),
    )
    both = F.col("p_type").contains("ECON") & (F.col("occupation") == "other")
    return moved.select("p_partkey", fn.with_suffix_when("occupation", both, "-2").alias("occupation"))


FAMILY_SQL = """
base AS (
  SELECT c_custkey AS customer_id,
         CASE c_custkey % 6 WHEN 0 THEN '5+' ELSE CAST(c_custkey % 6 AS VARCHAR) END AS family_size,
         CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 3 THEN '3+' ELSE CAST(c_custkey % 4 AS VARCHAR) END AS no_of_children,
         CASE c_custkey % 5 WHEN 0 THEN 'Married' WHEN 1 THEN 'Single' END AS marital FROM customer),
n AS (SELECT *, CASE WHEN marital = 'Married' THEN 'In relationship' ELSE marital END AS s0,
         CAST(replace(family_size, '+', '') AS DOUBLE) - CAST(replace(no_of_children, '+', '') AS DOUBLE) AS gap FROM base),
s AS (SELECT *, CASE WHEN s0 IS NOT NULL THEN s0
    WHEN family_size = '1' THEN 'Single'
    WHEN no_of_children IS NULL AND family_size = '2' THEN 'In relationship'
    WHEN NOT contains(family_size, '+') AND gap = 1 THEN 'Single'
    WHEN NOT contains(family_size, '+') AND NOT contains(coalesce(no_of_children, ''), '+') AND gap = 2 THEN 'In relationship'
  END AS relationship_status FROM n)"""


def families(t: Tables) -> DataFrame:
    """Customers with family columns derived from their key."""
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("customer_id"),
        F.when(k % 6 == 0, "5+").otherwise((k % 6).cast("string")).alias("family_size"),
        F.when(k % 4 == 0, None).when(k % 4 == 3, "3+").otherwise((k % 4).cast("string")).alias("no_of_children"),
        F.when(k % 5 == 0, "Married").when(k % 5 == 1, "Single").alias("marital_status"),
    )


def fill_families(df: DataFrame) -> DataFrame:
    """Relationship status and number of children inferred from the family size."""
    df = df.withColumnRenamed("marital_status", "relationship_status").withColumn(
        "relationship_status", fn.recode("relationship_status", {"Married": "In relationship"})
    )
    size, children, status = F.col("family_size"), F.col("no_of_children"), F.col("relationship_status")
    gap = fn.plus_to_number(size) - fn.plus_to_number(children)
    exact = ~size.contains("+")
    exact_children = ~F.coalesce(children, F.lit("")).contains("+")
    together = "In relationship"
    return C.rule_fill(
        df,
        [
            ("relationship_status", size == "1", "Single"),
            ("relationship_status", children.isNull() & (size == "2"), together),
            ("relationship_status", exact & (gap == 1), "Single"),
            ("relationship_status", exact & exact_children & (gap == 2), together),
            ("no_of_children", (status == together) & (size == "2"), "0"),
            ("no_of_children", size == "1", "0"),
            ("no_of_children", (status == "Single") & (size == "2"), "1"),
        ],
    )


@query("rule_fill", f"""
WITH {FAMILY_SQL}
SELECT customer_id, family_size, relationship_status,
  CASE WHEN no_of_children IS NOT NULL THEN no_of_children
       WHEN relationship_status = 'In relationship' AND family_size = '2' THEN '0'
       WHEN family_size = '1' THEN '0'
       WHEN relationship_status = 'Single' AND family_size = '2' THEN '1' END AS no_of_children
FROM s""")
def rule_fill(t: Tables) -> DataFrame:
    return fill_families(families(t))


@query("combine_text", "SELECT p_partkey, replace(lower(p_brand || ';' || p_type), chr(10), '') AS product_description FROM part")
def combine_text(t: Tables) -> DataFrame:
    described = t.part.select("p_partkey", F.col("p_brand").alias("desc_1"), F.col("p_type").alias("desc_2"))
    combined = C.drop_matching(C.combine_text(described, "^desc_", ";", "product_description"), "^desc_")
    return combined.withColumn("product_description", fn.remove_newlines_lower("product_description"))


@query("label_encode", """
WITH a AS (SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 1 AS code FROM (SELECT DISTINCT l_returnflag FROM lineitem)),
b AS (SELECT l_linestatus, row_number() OVER (ORDER BY l_linestatus) - 1 AS code FROM (SELECT DISTINCT l_linestatus FROM lineitem))
SELECT l_orderkey, l_partkey, l_quantity, a.code AS l_returnflag, b.code AS l_linestatus
FROM lineitem JOIN a USING (l_returnflag) JOIN b USING (l_linestatus)""")
def label_encode(t: Tables) -> DataFrame:
    cols = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus")
    return C.LabelEncoder.fit(cols, ["l_returnflag", "l_linestatus"]).apply(cols)


@query("label_encode_wide", """
SELECT c_custkey, a.code AS c_name FROM customer JOIN (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS code FROM (SELECT DISTINCT c_name FROM customer)) a USING (c_name)""")
def label_encode_wide(t: Tables) -> DataFrame:
    """Codes of a text column with more values than the driver may hold; all its values start alike."""
    cols = t.customer.select("c_custkey", "c_name")
    return C.LabelEncoder.fit(cols, ["c_name"], limit=100).apply(cols)


@query("one_hot", """
SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1.0e0 ELSE 0.0e0 END AS "o_orderstatus_F",
       CASE WHEN o_orderstatus = 'O' THEN 1.0e0 ELSE 0.0e0 END AS "o_orderstatus_O",
       CASE WHEN o_orderstatus = 'P' THEN 1.0e0 ELSE 0.0e0 END AS "o_orderstatus_P", o_orderpriority FROM orders""")
def one_hot(t: Tables) -> DataFrame:
    return C.one_hot(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), exclude=["o_orderpriority"])


@query("keyed_patch", """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN CAST(c_custkey AS DOUBLE) / 2 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 10 = 4 THEN 'FIXED' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def keyed_patch(t: Tables) -> DataFrame:
    """Corrections for two columns, given as (key, column, value) rows."""
    k = F.col("c_custkey")
    balance = t.customer.filter(k % 10 == 3).select(
        "c_custkey", F.lit("c_acctbal").alias("column"), (k.cast("double") / 2).cast("string").alias("value")
    )
    segment = t.customer.filter(k % 10 == 4).select(
        "c_custkey", F.lit("c_mktsegment").alias("column"), F.lit("FIXED").alias("value")
    )
    base = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    return C.keyed_patch(base, balance.unionByName(segment), "c_custkey", ["c_acctbal", "c_mktsegment"])


@query("row_sum", f"SELECT l_orderkey, l_partkey, {near_sql('l_quantity + l_extendedprice + l_discount + l_tax')} AS total FROM lineitem")
def row_sum(t: Tables) -> DataFrame:
    out = C.with_row_sum(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "total")
    return near_all(out.select("l_orderkey", "l_partkey", "total"))


@query("explode_list", """
SELECT p_partkey AS page, i - 1 AS position, string_split(p_name, ' ')[i] AS keyword
FROM part, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS u(i)""")
def explode_list(t: Tables) -> DataFrame:
    listed = t.part.select(F.col("p_partkey").alias("page"), F.translate("p_name", " ", ",").alias("keywords"))
    return C.explode_list(listed, "keywords", ",", "keyword", "position").withColumn("position", F.col("position").cast("long"))


@query("prompt_text", """
SELECT p_partkey, 'You write short titles. Product: ' || p_name || '. Features: ' || lower(p_brand) || '; ' || lower(p_type) || '.' AS prompt FROM part""")
def prompt_text(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        fn.template(
            "You write short titles. Product: {title}. Features: {brand}; {kind}.",
            title="p_name", brand=F.lower("p_brand"), kind=F.lower("p_type"),
        ).alias("prompt"),
    )


# --- filters ---------------------------------------------------------------------------------------------


@query("dropna_subset", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS status FROM orders WHERE o_orderstatus IN ('F', 'O')")
def dropna_subset(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    return R.dropna_subset(t.orders.select("o_orderkey", status.alias("status")), "status")


@query("sentinel_dropna", "SELECT p_partkey, p_name, p_type FROM part WHERE p_type <> 'ECONOMY' AND p_name NOT LIKE 'red%'")
def sentinel_dropna(t: Tables) -> DataFrame:
    marked = t.part.select(
        "p_partkey",
        F.when(~F.col("p_name").startswith("red"), F.col("p_name")).alias("p_name"),
        fn.recode("p_type", {"ECONOMY": "?"}).alias("p_type"),
    )
    return R.sentinel_dropna(marked)


@query("filter_gt", "SELECT l_orderkey, l_partkey, l_discount FROM lineitem WHERE l_discount > 0.05")
def filter_gt(t: Tables) -> DataFrame:
    return R.filter_gt(t.lineitem.select("l_orderkey", "l_partkey", "l_discount"), "l_discount", 0.05)


@query("string_predicates", """
SELECT p_partkey, p_name, p_brand FROM part
WHERE contains(p_name, 'red') AND NOT p_name LIKE '%gear' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')""")
def string_predicates(t: Tables) -> DataFrame:
    name = F.col("p_name")
    wanted = name.contains("red") & ~name.endswith("gear") & F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")
    return t.part.filter(wanted).select("p_partkey", "p_name", "p_brand")


@query("drop_allnull_columns", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS sometimes FROM orders")
def drop_allnull_columns(t: Tables) -> DataFrame:
    return R.drop_allnull_columns(
        t.orders.select(
            "o_orderkey",
            F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("sometimes"),
            F.when(F.col("o_orderkey") < 0, 1).alias("never"),
        )
    )


@query("dedupe_keep_first", """
SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def dedupe_keep_first(t: Tables) -> DataFrame:
    return R.keep_first(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("mask_split_counts", f"""
SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END || CASE WHEN quality = 1 THEN '_normal' ELSE '_other' END AS part, count(*) AS n
FROM (SELECT quality, {train_sql("doc_id", seed=1)} AS is_train FROM labels) GROUP BY 1""")
def mask_split_counts(t: Tables) -> DataFrame:
    marked = R.split_random(t.labels, ["doc_id"], 0.8, 1)
    parts = R.mask_parts(marked, F.col("quality") == 1, F.col("is_train"))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("date_slice", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def date_slice(t: Tables) -> DataFrame:
    return R.date_slice(t.orders, "o_orderdate", date(1998, 1, 1)).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("scalar_lookup", """
SELECT n_name, c_custkey, c_acctbal > (SELECT max(c_acctbal) / 2 FROM customer WHERE c_mktsegment = 'BUILDING') AS above
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def scalar_lookup(t: Tables) -> DataFrame:
    bound = R.scalar_lookup(t.customer, "c_mktsegment", "BUILDING", "c_acctbal") / 2
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("n_name", "c_custkey", (F.col("c_acctbal") > bound).alias("above"))


# --- sort, limit, sample, set operations, reshape --------------------------------------------------------


@query("sort_limit", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def sort_limit(t: Tables) -> DataFrame:
    first = R.top_k(t.orders, [F.col("o_orderdate"), F.col("o_orderkey")], 100)
    return first.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("top_k", "SELECT p_brand, CAST(sum(CAST(p_retailprice AS DECIMAL(28,4))) AS DOUBLE) AS total FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def top_k(t: Tables) -> DataFrame:
    total = t.part.groupBy("p_brand").agg(exact_sum("p_retailprice").alias("total"))
    return R.top_k(total, [F.desc("total"), F.col("p_brand")], 5)


@query("sample_n", f"SELECT vec_id, label FROM embeddings ORDER BY {hash_sql('vec_id', seed=3)}, vec_id LIMIT 20")
def sample_n(t: Tables) -> DataFrame:
    """Twenty evaluation rows."""
    return R.sample_rows(t.embeddings.select("vec_id", "label"), ["vec_id"], 20, 3)


@query("sample_one", f"SELECT c_custkey, c_name FROM customer ORDER BY {hash_sql('c_custkey', seed=11)}, c_custkey LIMIT 1")
def sample_one(t: Tables) -> DataFrame:
    return R.sample_rows(t.customer.select("c_custkey", "c_name"), ["c_custkey"], 1, 11)


@query("union_all", "SELECT 'customer' AS kind, c_custkey AS key, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier")
def union_all(t: Tables) -> DataFrame:
    a = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return R.union_all(a, b)


@query("distinct_values", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def distinct_values(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_returnflag").distinct()


@query("except_rows", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000")
def except_rows(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey").exceptAll(t.orders.filter("o_totalprice > 400000").select("o_custkey").distinct())


@query("unpivot_measures", """
SELECT c_custkey, measure, value FROM (
  SELECT c_custkey, 'balance' AS measure, c_acctbal AS value FROM customer
  UNION ALL SELECT c_custkey, 'nation', CASE WHEN c_nationkey > 5 THEN CAST(c_nationkey AS DOUBLE) END FROM customer) WHERE value IS NOT NULL""")
def unpivot_measures(t: Tables) -> DataFrame:
    wide = t.customer.select(
        "c_custkey", F.col("c_acctbal").alias("balance"), F.when(F.col("c_nationkey") > 5, F.col("c_nationkey").cast("double")).alias("nation")
    )
    return R.unpivot_measures(wide, ["c_custkey"], ["balance", "nation"], "measure", "value")


@query("pivot_types", """
SELECT user_id, arg_max(value, (ts, event_id)) FILTER (WHERE event_type = 'click') AS click,
       arg_max(value, (ts, event_id)) FILTER (WHERE event_type = 'view') AS view,
       arg_max(value, (ts, event_id)) FILTER (WHERE event_type = 'signup') AS signup,
       arg_max(value, (ts, event_id)) FILTER (WHERE event_type = 'purchase') AS purchase
FROM events WHERE event_type <> 'error' GROUP BY user_id""")
def pivot_types(t: Tables) -> DataFrame:
    return R.pivot_latest(t.events, ["user_id"], "event_type", "value", ["ts", "event_id"], ["click", "view", "signup", "purchase"])


@query("row_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id FROM orders")
def row_id(t: Tables) -> DataFrame:
    """One number per order over the whole table, without a single-task sort."""
    cols = t.orders.select("o_orderkey", "o_orderdate")
    out = numbered(cols, [], ["o_orderdate", "o_orderkey"], rows_per_cut=5_000)
    return out.select("o_orderkey", "row_id")


@query("split_random", f"SELECT o_orderkey, {train_sql('o_orderkey', seed=5)} AS is_train FROM orders")
def split_random(t: Tables) -> DataFrame:
    return R.split_random(t.orders.select("o_orderkey"), ["o_orderkey"], 0.8, 5)


@query("split_stratified", f"""
SELECT o_orderkey, o_orderpriority, rn <= round_even(n * 0.9e0, 0) AS is_train FROM (
  SELECT o_orderkey, o_orderpriority, count(*) OVER (PARTITION BY o_orderpriority) AS n,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY {hash_sql('o_orderkey')}, o_orderkey) AS rn FROM orders)""")
def split_stratified(t: Tables) -> DataFrame:
    return R.split_stratified(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["o_orderkey"], 0.9)


@query("split_stratified_hot", f"""
SELECT o_orderkey, o_orderstatus, rn <= round_even(n * 0.9e0, 0) AS is_train FROM (
  SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY {hash_sql('o_orderkey')}, o_orderkey) AS rn FROM orders)""")
def split_stratified_hot(t: Tables) -> DataFrame:
    """Three strata with a third of all rows each, split by counting hash slots instead of sorting."""
    return R.split_stratified(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["o_orderkey"], 0.9, hot_rows=1_000)


# --- scalar functions ------------------------------------------------------------------------------------


@query("string_clean", """
SELECT doc_id, lower(replace(text, chr(10), '')) AS cleaned, length(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) AS n_stripped,
       replace(source, 's', ' ') AS spaced FROM documents""")
def string_clean(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        fn.remove_newlines_lower("text").alias("cleaned"),
        F.length(fn.strip_lower("text")).cast("long").alias("n_stripped"),
        fn.dash_to_space(F.translate("source", "s", "-")).alias("spaced"),
    )


@query("date_parts", """
SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS dayofmonth, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dayofweek,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) AS BIGINT) AS age FROM orders""")
def date_parts(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.dayofmonth(d).alias("dayofmonth"), fn.weekday_monday0(d).alias("dayofweek"), F.month(d).alias("month"),
        fn.days_between(d, F.lit("1992-01-01").cast("timestamp_ntz")).alias("age"),
    )


@query("parse_timestamps", """
SELECT event_id, CASE WHEN event_id % 3 < 2 THEN strftime(CASE event_id % 3 WHEN 0 THEN ts ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S.%f') END AS parsed
FROM events""")
def parse_timestamps(t: Tables) -> DataFrame:
    """Message times with a fraction, without one, and unreadable ones."""
    ts = F.col("ts")
    kind = F.col("event_id") % 3
    text = (
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(ts, "dd/MM/yyyy"))
    )
    parsed = fn.parse_message_time(text)
    return t.events.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"))


@query("floor_multiple", "SELECT o_orderkey, CAST(floor(o_totalprice / 100) * 100 AS BIGINT) AS price_floor FROM orders")
def floor_multiple(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", fn.floor_multiple("o_totalprice", 100).alias("price_floor"))


@query("click_prob", f"""
SELECT o_orderkey, {near_sql("greatest(0e0, 0.85e0 - 0.25e0 * abs(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - (o_custkey % 5 + 1)))")} AS p FROM orders""")
def click_prob(t: Tables) -> DataFrame:
    level = F.substring("o_orderpriority", 1, 1).cast("int")
    return near_all(t.orders.select("o_orderkey", fn.match_probability(level, F.col("o_custkey") % 5 + 1).alias("p")))


@query("array_slices", """
SELECT doc_id, i AS batch, array_to_string(list_slice(w, CAST(i * 10 + 1 AS BIGINT), CAST(i * 10 + 10 AS BIGINT)), ' ') AS words
FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents), unnest(range(0, CAST(ceil(len(w) / 10.0) AS BIGINT))) AS u(i)""")
def array_slices(t: Tables) -> DataFrame:
    """Every text cut into batches of ten words."""
    words = t.documents.select("doc_id", F.split("text", " ", -1).alias("w"))
    return words.select("doc_id", F.posexplode(fn.slices("w", 10)).alias("batch", "words")).select("doc_id", F.col("batch").cast("long"), F.array_join("words", " ").alias("words"))


@query("row_l1", f"""
SELECT l_orderkey, l_partkey, {near_sql("abs(l_quantity - 25) + abs(l_discount - l_tax)")} AS loss FROM lineitem""")
def row_l1(t: Tables) -> DataFrame:
    loss = fn.row_l1([F.col("l_quantity"), F.col("l_discount")], [F.lit(25.0), F.col("l_tax")])
    return near_all(t.lineitem.select("l_orderkey", "l_partkey", loss.alias("loss")))
