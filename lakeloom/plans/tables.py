"""Scans, sinks and table management over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.aggregates import exact_sum
from lakeloom.operators import summaries as S
from lakeloom.operators.rows import filter_gt, split_random
from lakeloom.plans.registry import Tables, near_all, near_sql, query, train_sql
from lakeloom.session import scratch_path
from lakeloom.sources import catalog, files, synthetic

ALL = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query("scan_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_parquet(t: Tables) -> DataFrame:
    return files.scan_source(t.spark, file=t.path("orders")).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("scan_parquet_tree", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def scan_parquet_tree(t: Tables) -> DataFrame:
    """Orders written below nested folders, read back as one table."""
    root = scratch_path(t.spark, "tree")
    cols = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    closed = F.col("o_orderstatus") == "F"
    parts = {"closed/done": cols.filter(closed), "open": cols.filter(~closed)}
    files.assert_same_schema(list(parts.values()))
    for name, df in parts.items():
        df.write.option("compression", "snappy").parquet(f"{root}/{name}")
    return files.scan_source(t.spark, folder=root)


@query("scan_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_table(t: Tables) -> DataFrame:
    t.customer.createOrReplaceTempView("lakeloom_customer")
    return files.scan_source(t.spark, "catalog", table="lakeloom_customer")


@query("load_tables_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in ALL))
def load_tables_counts(t: Tables) -> DataFrame:
    tables = files.load_tables(t.spark, [t.path(n) for n in ALL])
    counted = [catalog.row_count(df).withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


CSV_SOURCE = "SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'NA' ELSE c_mktsegment END AS segment, c_acctbal FROM customer"


@query("scan_csv_na", CSV_SOURCE)
def scan_csv_na(t: Tables) -> DataFrame:
    """The text NA survives a round trip through CSV."""
    path = scratch_path(t.spark, "csv-na")
    segment = F.when(F.col("c_mktsegment") == "MACHINERY", "NA").otherwise(F.col("c_mktsegment")).alias("segment")
    files.save_csv(t.customer.select("c_custkey", segment, "c_acctbal"), path)
    return files.scan_csv_na(t.spark, path, "c_custkey long, segment string, c_acctbal double")


@query("scan_csv_delim", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def scan_csv_delim(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv-delim")
    cols = ["o_orderkey", "o_orderstatus", "o_custkey"]
    files.save_csv(t.orders.select(*cols), path, ";")
    return files.scan_csv_text(t.spark, path, cols)


@query("scan_documents", """
SELECT CAST(doc_id // 250 AS BIGINT) AS folder, md5(string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id)) AS digest, CAST(sum(length(coalesce(text, '')) + 1) AS BIGINT) AS n
FROM documents GROUP BY 1""")
def scan_documents(t: Tables) -> DataFrame:
    """Whole documents in bundles of 250 ids, read back: the path tells which bundle it is, the digest that the texts are the same."""
    root = scratch_path(t.spark, "documents")
    lines = t.documents.select(F.expr("doc_id div 250").alias("folder"), "doc_id", F.coalesce("text", F.lit("")).alias("text")).repartition("folder")
    lines.sortWithinPartitions("folder", "doc_id").drop("doc_id").write.partitionBy("folder").text(root)
    return files.scan_documents(t.spark, root, ".txt").select(
        F.regexp_extract("source", r"folder=(\d+)", 1).cast("long").alias("folder"), F.md5("text").alias("digest"), F.char_length("text").cast("long").alias("n"),
    )


@query("json_values", """
SELECT 'customers' AS name, CAST(count(*) AS VARCHAR) AS text, CAST(count(*) AS DOUBLE) AS value FROM customer
UNION ALL SELECT 'orders', CAST(count(*) AS VARCHAR), CAST(count(*) AS DOUBLE) FROM orders
UNION ALL SELECT 'first_nation', min(n_name), NULL FROM nation
UNION ALL SELECT 'parts', CAST(count(*) * 2 AS VARCHAR), CAST(count(*) AS DOUBLE) * 2 FROM part""")
def json_values(t: Tables) -> DataFrame:
    """Scalars kept in two JSON files; the second file's value wins."""
    first, second = scratch_path(t.spark, "values"), scratch_path(t.spark, "values")
    n = {k: df.count() for k, df in (("customers", t.customer), ("orders", t.orders), ("parts", t.part))}
    files.save_values(t.spark, n | {"first_nation": t.nation.agg(F.min("n_name")).first()[0]}, first)
    files.save_values(t.spark, {"parts": n["parts"] * 2}, second)
    return files.scan_json_values(t.spark, [first, second])


@query("json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_props(t: Tables) -> DataFrame:
    """Event properties wrapped as a request payload and parsed back to typed rows."""
    payload = F.concat(F.lit('{"data": ['), F.col("props"), F.lit("]}"))
    return files.parse_payload(t.events.select("event_id", payload.alias("payload")), "payload", ["k"], ["event_id"])


@query("json_rejected", """
SELECT event_id, '{"data": [' || props || ']}' AS payload, 'missing k' AS reason FROM events WHERE event_id % 3 > 0 AND try_cast(json_extract_string(props, '$.k') AS DOUBLE) IS NULL
UNION ALL SELECT event_id, 'cut off: ' || props, 'unreadable' FROM events WHERE event_id % 3 = 0""")
def json_rejected(t: Tables) -> DataFrame:
    """Payloads without the field, and every third one cut off, with the reason why they can't be used."""
    whole = F.concat(F.lit('{"data": ['), F.col("props"), F.lit("]}"))
    payload = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("cut off: "), F.col("props"))).otherwise(whole)
    return files.rejected_payloads(t.events.select("event_id", payload.alias("payload")), "payload", ["k"], ["event_id"])


@query("sql_query", """
SELECT n_name, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(28,4))) AS DOUBLE) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def sql_query(t: Tables) -> DataFrame:
    return files.sql_query(
        t.spark,
        "SELECT n_name, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(28,4))) AS DOUBLE) AS balance "
        "FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name",
        customer=t.customer, nation=t.nation,
    )


@query("head_n", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def head_n(t: Tables) -> DataFrame:
    return catalog.table_head(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 10)


@query("file_inventory_kinds", """
SELECT '.csv' AS kind, true AS files, true AS bytes, (SELECT count(*) FROM customer) AS rows
UNION ALL SELECT '.parquet', true, true, (SELECT count(*) FROM orders)""")
def file_inventory_kinds(t: Tables) -> DataFrame:
    """The inventory of a folder with the customers as CSV and the orders as Parquet, beside the rows read from each."""
    root = scratch_path(t.spark, "kinds")
    files.save_csv(t.customer, f"{root}/customer", ";")
    t.orders.write.parquet(f"{root}/orders")
    found = files.file_inventory(t.spark, root, [".parquet", ".csv"])
    kept = {".csv": files.scan_csv_text(t.spark, f"{root}/customer", t.customer.columns, ";").count(), ".parquet": t.spark.read.parquet(f"{root}/orders").count()}
    rows = t.spark.createDataFrame(list(kept.items()), "kind string, rows long")
    return found.join(rows, F.col("extension") == F.col("kind")).select("kind", (F.col("files") > 0).alias("files"), (F.col("bytes") > 0).alias("bytes"), "rows")


@query("file_inventory", """
SELECT o_orderstatus AS folder, count(*) AS rows, true AS files, true AS bytes FROM orders GROUP BY 1""")
def file_inventory(t: Tables) -> DataFrame:
    """Files, bytes and rows per folder of the orders, written by status."""
    root = scratch_path(t.spark, "inventory")
    t.orders.write.partitionBy("o_orderstatus").parquet(root)
    listed = files.table_inventory(t.spark.read.parquet(root))
    folder = F.regexp_extract("file", r"o_orderstatus=([^/]+)/", 1).alias("folder")
    found = listed.groupBy(folder).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.min("bytes").alias("bytes"))
    return found.select("folder", "rows", (F.col("files") > 0).alias("files"), (F.col("bytes") > 0).alias("bytes"))


@query("synthetic_uniform", f"""
WITH h AS (SELECT c_custkey,
  CAST('0x' || substr(md5('7|' || c_custkey), 1, 12) AS BIGINT) / 281474976710656.0e0 AS u0,
  CAST('0x' || substr(md5('8|' || c_custkey), 1, 12) AS BIGINT) / 281474976710656.0e0 AS u1,
  CAST('0x' || substr(md5('9|' || c_custkey), 1, 12) AS BIGINT) AS h2 FROM customer)
SELECT c_custkey, {near_sql("4 + u0 * 3.9e0", 9)} AS sepal_length, {near_sql("u1", 9)} AS share, h2 % 1000 AS whole FROM h""")
def synthetic_uniform(t: Tables) -> DataFrame:
    """Pseudo-random measurements for every customer key."""
    out = synthetic.add_uniforms(t.customer.select("c_custkey"), ["c_custkey"], {"sepal_length": (4, 7.9), "share": (0, 1)}, 7)
    return near_all(out, 9).withColumn("whole", synthetic.integer_column(["c_custkey"], 0, 1000, 9))


# --- sinks -----------------------------------------------------------------------------------------------


@query("save_load_roundtrip", """
SELECT 'customer' AS name, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(28,4))) AS DOUBLE) AS total FROM customer
UNION ALL SELECT 'orders', count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(28,4))) AS DOUBLE) FROM orders""")
def save_load_roundtrip(t: Tables) -> DataFrame:
    paths = files.save_tables({"customer": t.customer, "orders": t.orders}, scratch_path(t.spark, "tables"))
    back = files.load_tables(t.spark, list(paths.values()))
    parts = [
        back[n].agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"), exact_sum(c).alias("total"))
        for n, c in (("customer", "c_acctbal"), ("orders", "o_totalprice"))
    ]
    return parts[0].unionByName(parts[1])


@query("json_records", """SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' AS record FROM customer""")
def json_records(t: Tables) -> DataFrame:
    return files.json_records(t.customer.select("c_custkey", "c_name", "c_mktsegment"), ["c_custkey"])


@query("save_to_table_modes", """
SELECT c_mktsegment AS segment, 3 * count(*) AS n FROM customer GROUP BY 1""")
def save_to_table_modes(t: Tables) -> DataFrame:
    """Create, replace and append twice: three copies remain."""
    path = scratch_path(t.spark, "modes")
    name = "lakeloom_modes_" + path[-12:]
    rows = t.customer.select(F.col("c_mktsegment").alias("segment"))
    for mode in ("EMPTY", "TRUNCATE", "APPEND", "APPEND"):
        catalog.save_to_table(rows, name, mode, path)
    catalog.delete_table(t.spark, name)  # the files stay where the query reads them
    return S.value_counts(t.spark.read.parquet(path), "segment")


@query("backup_tables", """
SELECT 'customer' AS table_name, 'copied' AS status, count(*) AS n FROM customer
UNION ALL SELECT 'orders', 'copied', count(*) FROM orders
UNION ALL SELECT 'missing', 'failed: AnalysisException', 0""")
def backup_tables(t: Tables) -> DataFrame:
    """Two tables copied to the clone database; a third does not exist and is reported."""
    root = scratch_path(t.spark, "backup")
    db = "lakeloom_" + root[-12:]
    t.spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/{db}'")
    for name in ("customer", "orders"):
        catalog.save_to_table(getattr(t, name), f"{db}.{name}", path=f"{root}/{db}/{name}")
    wanted = catalog.list_tables(t.spark, [db]) + [(db, "missing")]
    status = catalog.backup_tables(t.spark, wanted, root)
    out = None
    for _, name, state in status:
        if state == "copied":
            one = catalog.row_count(t.spark.read.parquet(f"{root}/{db}_clone/{name}"))
        else:
            one = t.spark.range(1).select(F.lit(0).cast("long").alias("n_rows"))
        row = one.select(F.lit(name).alias("table_name"), F.lit(state).alias("status"), F.col("n_rows").alias("n"))
        out = row if out is None else out.unionByName(row)
    for name in (db, f"{db}_clone"):
        t.spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return out


@query("catalog_steps", """
SELECT 'created and filled' AS step, count(*) AS n FROM region UNION ALL SELECT 'extracted', count(*) FROM nation
UNION ALL SELECT 'converted', count(*) FROM nation UNION ALL SELECT 'purged', 1 UNION ALL SELECT 'left', 0""")
def catalog_steps(t: Tables) -> DataFrame:
    """A table created, filled and deleted, an expired one purged, an extract as CSV read and converted; nothing stays."""
    root = scratch_path(t.spark, "catalog")
    db = "lakeloom_" + root[-12:]
    t.spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/{db}'")
    catalog.create_table(t.spark, f"{db}.areas", {"r_regionkey": "INTEGER", "r_name": "STRING"})
    catalog.insert_rows(t.spark, f"{db}.areas", [r.asDict() for r in t.region.select("r_regionkey", "r_name").collect()])  # five regions
    kept = t.spark.table(f"{db}.areas").count()
    catalog.delete_table(t.spark, f"{db}.areas")
    catalog.create_temp_table(t.spark, f"{db}.brief", [("k", "INTEGER", "REQUIRED")], hours=-1)
    purged = len(catalog.purge_expired(t.spark, db))
    left = len(catalog.list_tables(t.spark, [db]))
    t.spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    csv = catalog.extract(t.nation.select("n_nationkey", "n_name"), f"{root}/nation.csv")
    kind = "n_nationkey long, n_name string"
    converted = files.convert_to_parquet(t.spark, csv, f"{root}/nation", kind)
    extracted, rows = files.scan_csv_na(t.spark, csv, kind).count(), t.spark.read.parquet(converted).count()
    counts = {"created and filled": kept, "extracted": extracted, "converted": rows, "purged": purged, "left": left}
    return t.spark.createDataFrame(list(counts.items()), "step string, n long")


@query("partitioned_filter", """
SELECT o_orderpriority AS part, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(28,4))) AS DOUBLE) AS total
FROM orders WHERE o_totalprice > 200000 GROUP BY 1""")
def partitioned_filter(t: Tables) -> DataFrame:
    """Rows above a bound, one output folder per input part."""
    source, target = scratch_path(t.spark, "parts-in"), scratch_path(t.spark, "parts-out")
    orders = t.orders.select("o_orderkey", F.col("o_totalprice").cast("string").alias("sales"), F.col("o_orderpriority").alias("folder"))
    files.write_by_part(orders, "folder", source)
    files.partitioned_job(t.spark, source, target, lambda df: filter_gt(df, "sales", 200000))
    done = t.spark.read.parquet(target).withColumn("part", F.substring_index("part", "=", -1))
    return done.groupBy("part").agg(F.count(F.lit(1)).alias("n"), exact_sum(F.col("sales").cast("double")).alias("total"))


@query("monitoring_log", f"""
SELECT doc_id || '-b1' AS record_key, CAST(n_chars AS BIGINT) AS n_chars, quality AS actual, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS output,
       CASE WHEN {train_sql("doc_id")} THEN 'train' ELSE 'test' END AS dataset, 'b1' AS batch_id
FROM labels JOIN documents USING (doc_id)""")
def monitoring_log(t: Tables) -> DataFrame:
    scored = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").withColumn(
        "predicted", F.when(F.col("n_chars") > 500, 1).otherwise(0)
    )
    scored = split_random(scored, ["doc_id"], 0.8)
    part = F.when(F.col("is_train"), "train").otherwise("test")
    return files.monitoring_log(scored, ["n_chars"], "quality", "predicted", ["doc_id"], part, "b1")
