"""Checked writes, stored sketches and incremental copies over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.aggregates import exact_sum
from lakeloom.operators.colocated import left_join_colocated, save_colocated
from lakeloom.operators.gate import read_published, write_checked
from lakeloom.operators.quality import Expectation, Suite
from lakeloom.operators.sketches import distinct_from_sketches, store_sketches
from lakeloom.plans.checking import expected, share_sql
from lakeloom.plans.registry import Tables, near_all, query
from lakeloom.session import materialize, scratch_path
from lakeloom.sources.files import monitoring_log
from lakeloom.sources.prediction_log import COUNTS, append_to_log, read_log
from lakeloom.sources.sync import read_copy, sync_partitions

LINES = Suite("lines.critical", "critical", (
    Expectation("column_values_to_not_be_null", {"column": "l_orderkey"}),
    Expectation("column_values_to_be_between", {"column": "l_quantity", "min_value": 1, "max_value": 45, "mostly": 0.8}),
    Expectation("column_values_to_not_be_in_set", {"column": "l_returnflag", "value_set": ["R"], "mostly": 0.1}),
    Expectation("table_row_count_to_be_between", {"min_value": 1}),
    Expectation("column_max_to_be_between", {"column": "l_linenumber", "min_value": 1}),
    Expectation("column_unique_value_count_to_be_between", {"column": "l_linestatus", "min_value": 1, "max_value": 9}),
))
STRICT = Suite("lines.critical", "critical", (Expectation("column_values_to_be_between", {"column": "l_quantity", "max_value": 10}),))

_Q = "count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 45)"
_R = "count(*) FILTER (WHERE l_returnflag = 'R')"


def _line(kind: str, column: str, success: str, observed: str, *more: str) -> str:
    return expected(kind, column, success, observed, *more, table="lineitem", suite="lines.critical")


@query("dq_gate", " UNION ALL ".join([
    _line("column_values_to_not_be_null", "l_orderkey", "count(*) = count(l_orderkey)", "count(*)", "count(*) - count(l_orderkey)", share_sql("(count(*) - count(l_orderkey))", "count(*)")),
    _line("column_values_to_be_between", "l_quantity", f"1 - {_Q} * 1.0e0 / count(*) >= 0.8", "count(l_quantity)", _Q, share_sql(_Q, "count(l_quantity)")),
    _line("column_values_to_not_be_in_set", "l_returnflag", f"1 - {_R} * 1.0e0 / count(*) >= 0.1", "count(l_returnflag)", _R, share_sql(_R, "count(l_returnflag)")),
    _line("table_row_count_to_be_between", "", "count(*) >= 1", "count(*)"),
    _line("column_max_to_be_between", "l_linenumber", "max(l_linenumber) >= 1", "max(l_linenumber)"),
    _line("column_unique_value_count_to_be_between", "l_linestatus", "count(DISTINCT l_linestatus) BETWEEN 1 AND 9", "count(DISTINCT l_linestatus)"),
]))
def dq_gate(t: Tables) -> DataFrame:
    """Results of a suite that is observed while the lines are written, in one scan."""
    return near_all(write_checked(t.lineitem, scratch_path(t.spark, "gate"), LINES).results, skip=("observed",))


_BAD = "(coalesce(l_quantity < 1 OR l_quantity > 45, false) OR coalesce(l_returnflag = 'R', false) OR l_orderkey IS NULL)"


@query("dq_gate_rows", f"""
SELECT 'kept' AS folder, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys, CAST(NULL AS VARCHAR) AS reasons FROM lineitem WHERE NOT {_BAD}
UNION ALL SELECT 'rejected', count(*), CAST(sum(l_orderkey) AS BIGINT), reasons FROM (
  SELECT l_orderkey, concat_ws(',', CASE WHEN l_orderkey IS NULL THEN 'column_values_to_not_be_null(l_orderkey)' END,
    CASE WHEN l_quantity < 1 OR l_quantity > 45 THEN 'column_values_to_be_between(l_quantity)' END,
    CASE WHEN l_returnflag = 'R' THEN 'column_values_to_not_be_in_set(l_returnflag)' END) AS reasons FROM lineitem WHERE {_BAD}) GROUP BY reasons
UNION ALL SELECT 'after a failed write', count(*), CAST(sum(l_orderkey) AS BIGINT), CAST(NULL AS VARCHAR) FROM lineitem WHERE NOT {_BAD}""")
def dq_gate_rows(t: Tables) -> DataFrame:
    """Rows published and rejected, and what readers see after a second write that a critical check stops."""
    place = scratch_path(t.spark, "gate")
    write_checked(t.lineitem, place, LINES)
    facts = [F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys")]
    none = F.lit(None).cast("string").alias("reasons")
    kept = read_published(t.spark, place).agg(*facts).select(F.lit("kept").alias("folder"), "n", "keys", none)
    why = read_published(t.spark, place, rejected=True).groupBy(F.array_join("reasons", ",").alias("reasons")).agg(*facts)
    write_checked(t.lineitem, place, STRICT)
    after = read_published(t.spark, place).agg(*facts).select(F.lit("after a failed write").alias("folder"), "n", "keys", none)
    return kept.unionByName(why.select(F.lit("rejected").alias("folder"), "n", "keys", "reasons")).unionByName(after)


_MONTHS = "(SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders)"


@query("sketch_distinct", " UNION ALL ".join([
    f"SELECT y, '{c}' AS \"column\", count(*) AS rows, count(DISTINCT {c}) AS exact, true AS near FROM {_MONTHS} GROUP BY y UNION ALL "
    f"SELECT NULL, '{c}', count(*), count(DISTINCT {c}), true FROM {_MONTHS}"
    for c in ("o_custkey", "o_orderpriority", "o_totalprice")]))
def sketch_distinct(t: Tables) -> DataFrame:
    """Distinct counts of years and of all orders from sketches stored per month, the last month added later; estimates lie within 4 % of the exact counts."""
    columns, path = ["o_custkey", "o_orderpriority", "o_totalprice"], scratch_path(t.spark, "sketches")
    rows = t.orders.select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), *columns)
    store_sketches(rows.where("m <> 12"), ["y", "m"], columns, path)
    store_sketches(rows.where("m = 12"), ["y", "m"], columns, path)
    years = distinct_from_sketches(t.spark, path, ["y"])
    everything = distinct_from_sketches(t.spark, path).withColumn("y", F.lit(None).cast("int"))
    exact = [F.count_distinct(c).alias(c) for c in columns]
    facts = rows.groupBy("y").agg(*exact).unionByName(rows.agg(*exact).withColumn("y", F.lit(None).cast("int")))
    long = facts.select(F.col("y").alias("y2"), F.inline(F.array(*[F.struct(F.lit(c).alias("c2"), F.col(c).alias("exact")) for c in columns])))
    both = years.unionByName(everything).join(long, F.col("y").eqNullSafe(F.col("y2")) & (F.col("column") == F.col("c2")))
    return both.select("y", "column", "rows", "exact", (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.04 * F.col("exact")).alias("near"))


@query("backup_incremental", f"""
WITH p AS (SELECT y, m, count(*) AS n FROM {_MONTHS} GROUP BY ALL), k AS (SELECT count(*) AS k, sum(n) AS n FROM p),
f AS (SELECT y, m, n FROM p ORDER BY y, m LIMIT 1)
SELECT 'first' AS run, k AS copied, CAST(0 AS BIGINT) AS kept, CAST(0 AS BIGINT) AS removed, CAST(n AS BIGINT) AS rows FROM k
UNION ALL SELECT 'same', 0, k, 0, n FROM k UNION ALL SELECT 'one row changed', 1, k - 1, 0, n FROM k
UNION ALL SELECT 'one month gone', 0, k - 1, 1, k.n - f.n FROM k, f""")
def backup_incremental(t: Tables) -> DataFrame:
    """Copies of the orders by month: all of them, none, the month of one changed row, and one month struck."""
    path, parts = scratch_path(t.spark, "copy"), ["y", "m"]
    rows = t.orders.withColumns({"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})
    least = rows.agg(F.min("o_orderkey")).first()[0]
    first = rows.agg(F.min(F.struct("y", "m")).alias("f")).first()["f"]
    changed = rows.withColumn("o_totalprice", F.when(F.col("o_orderkey") == least, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    fewer = changed.where((F.col("y") != first["y"]) | (F.col("m") != first["m"]))
    out = []
    for run, table in (("first", rows), ("same", rows), ("one row changed", changed), ("one month gone", fewer)):
        done = sync_partitions(table, path, parts)
        out.append((run, done["copied"], done["kept"], done["removed"], read_copy(t.spark, path, parts, rows).count()))
    return t.spark.createDataFrame(out, "run string, copied long, kept long, removed long, rows long")


@query("left_join_colocated", """
WITH s AS (SELECT l_orderkey, count(*) AS parts FROM lineitem GROUP BY 1)
SELECT l_returnflag, o_orderstatus, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,4))) AS DOUBLE) AS total, CAST(sum(parts) AS BIGINT) AS parts
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN s USING (l_orderkey) GROUP BY 1, 2""")
def q_left_join_colocated(t: Tables) -> DataFrame:
    """Lines with their order and the order's number of lines, from tables bucketed by order; nothing stays in the catalog."""
    root = scratch_path(t.spark, "buckets")
    db = "lakeloom_" + root[-12:]
    t.spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/{db}'")
    lines = t.lineitem.select("l_orderkey", "l_returnflag", "l_extendedprice")
    facts = save_colocated(lines, f"{db}.lines", "l_orderkey", f"{root}/lines", 16)
    orders = save_colocated(t.orders.select("o_orderkey", "o_orderstatus"), f"{db}.orders", "o_orderkey", f"{root}/orders", 16, None)
    sizes = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("parts"))
    sizes = save_colocated(sizes, f"{db}.sizes", "l_orderkey", f"{root}/sizes", 16, None)
    joined = left_join_colocated(t.spark, facts, [orders, sizes])
    found = joined.groupBy("l_returnflag", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), exact_sum("l_extendedprice").alias("total"), F.sum("parts").alias("parts"))
    found = materialize(found, "colocated")
    t.spark.sql(f"DROP DATABASE {db} CASCADE")
    return found


_B = "CASE WHEN l_shipdate < DATE '1998-01-01' THEN 1 WHEN l_shipdate < DATE '2000-01-01' THEN 2 ELSE 3 END"


@query("prediction_log", f"""
WITH r AS (SELECT l_orderkey || '-' || l_linenumber AS k, {_B} AS b FROM lineitem),
c AS (SELECT k, b, count(*) AS n FROM r GROUP BY 1, 2),
g AS (SELECT b, k, n, n = 1 AND min(CASE WHEN n = 1 THEN b END) OVER (PARTITION BY k) < b AS known FROM c)
SELECT 'b' || b AS batch, CAST(sum(CASE WHEN n = 1 AND NOT known THEN 1 ELSE 0 END) AS BIGINT) AS kept, CAST(0 AS BIGINT) AS no_key,
       CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS repeated, CAST(sum(CASE WHEN known THEN 1 ELSE 0 END) AS BIGINT) AS known,
       true AS few_suspects, CAST(sum(CASE WHEN n = 1 AND NOT known THEN 1 ELSE 0 END) AS BIGINT) AS keys_in_log FROM g GROUP BY b""")
def prediction_log(t: Tables) -> DataFrame:
    """Predictions of all lines appended in three batches by ship date: rows kept and rejected, and the distinct keys that the log
    holds of each batch. Some 5 % of pairs of new key and batch may be looked up in vain."""
    path = scratch_path(t.spark, "log")
    lines = t.lineitem.withColumn("predicted", F.when(F.col("l_quantity") > 25, 1).otherwise(0))
    lines = lines.withColumn("actual", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    day = F.col("l_shipdate")
    cuts = {"b1": day < "1998-01-01", "b2": (day >= "1998-01-01") & (day < "2000-01-01"), "b3": day >= "2000-01-01"}
    out, log = [], None
    for i, (name, own) in enumerate(cuts.items()):
        log = monitoring_log(lines.where(own), ["l_quantity", "l_discount"], "actual", "predicted", ["l_orderkey", "l_linenumber"], F.lit("train"))
        log = log.drop("batch_id")
        done = append_to_log(log, path, name)
        new = done["kept"] + done["known"]
        out.append((name, *[done[c] for c in COUNTS[:4]], done["suspects"] <= done["known"] + 0.05 * i * new))
    counts = t.spark.createDataFrame(out, "batch string, kept long, no_key long, repeated long, known long, few_suspects boolean")
    held = read_log(t.spark, path, log).groupBy("batch").agg(F.count_distinct("record_key").alias("keys_in_log"))
    return counts.join(held, "batch")
