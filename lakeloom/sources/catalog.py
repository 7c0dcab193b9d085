"""Catalog tables: create, fill, list, expire, drop and back up."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = {"EMPTY": "errorifexists", "TRUNCATE": "overwrite", "APPEND": "append"}
# fixed values: warehouse type names
TYPES = {
    "STRING": "string", "INTEGER": "bigint", "INT64": "bigint", "FLOAT": "double", "FLOAT64": "double",
    "BOOLEAN": "boolean", "BOOL": "boolean", "TIMESTAMP": "timestamp", "DATE": "date",
}


def save_to_table(df: DataFrame, table: str, disposition: str = "EMPTY", path: str | None = None) -> None:
    """EMPTY fails for an existing table, TRUNCATE replaces it, APPEND adds rows."""
    if disposition not in MODES:
        raise ValueError(f"unknown disposition {disposition!r}")
    writer = df.write.mode(MODES[disposition]).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def extract(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Query result as sharded files."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
    return path


def _column_list(columns: Sequence[tuple[str, str, str]]) -> str:
    out = []
    for name, kind, mode in columns:
        if mode not in ("REQUIRED", "NULLABLE"):
            raise ValueError(f"unknown mode {mode!r}")
        out.append(f"`{name}` {TYPES.get(kind.upper(), kind)}" + (" NOT NULL" if mode == "REQUIRED" else ""))
    return ", ".join(out)


def create_table(spark: SparkSession, table: str, columns: Mapping[str, str]) -> None:
    cols = _column_list([(n, t, "NULLABLE") for n, t in columns.items()])
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet")


def create_temp_table(spark: SparkSession, table: str, columns: Sequence[tuple[str, str, str]], hours: float = 1) -> None:
    """Replace a table and note when it may be dropped."""
    due = int(time.time() + hours * 3600)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({_column_list(columns)}) USING parquet TBLPROPERTIES ('expires_at' = '{due}')")


def purge_expired(spark: SparkSession, database: str, now: float | None = None) -> list[str]:
    """Drop the tables of a database whose time has come."""
    now = time.time() if now is None else now
    gone = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary:
            continue
        name = f"{database}.{t.name}"
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if "expires_at" in props and float(props["expires_at"]) <= now:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            gone.append(name)
    return gone


def insert_rows(spark: SparkSession, table: str, rows: Sequence[Mapping[str, object]]) -> None:
    """Append rows given as dicts; an unknown column or a value of another type raises."""
    schema = spark.table(table).schema
    known = set(schema.names)
    for r in rows:
        if set(r) - known:
            raise ValueError(f"unknown columns {sorted(set(r) - known)}")
    data = [tuple(r.get(n) for n in schema.names) for r in rows]
    spark.createDataFrame(data, schema).write.insertInto(table)


def delete_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def list_tables(spark: SparkSession, databases: Sequence[str] | None = None, tables: Sequence[str] | None = None) -> list[tuple[str, str]]:
    """(database, table) of permanent tables outside ``*_clone`` databases; no list means all."""
    names = databases or [d.name for d in spark.catalog.listDatabases()]
    return [
        (d, t.name)
        for d in names
        if not d.endswith("_clone")
        for t in spark.catalog.listTables(d)
        if not t.isTemporary and (tables is None or t.name in tables)
    ]


def backup_tables(spark: SparkSession, tables: Sequence[tuple[str, str]], path: str, mode: str = "sync") -> list[tuple[str, str, str]]:
    """Full copies: ``sync`` writes db -> db_clone, ``failover`` db_clone -> db.

    A table that fails is reported and skipped. Each copy is one distributed write.
    """
    if mode not in ("sync", "failover"):
        raise ValueError(f"unknown mode {mode!r}")
    status = []
    for db, name in tables:
        clone = f"{db}_clone"
        source, target = (db, clone) if mode == "sync" else (clone, db)
        try:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {target}")
            copy = spark.table(f"{source}.{name}")
            copy.write.mode("overwrite").format("parquet").option("path", f"{path}/{target}/{name}").saveAsTable(f"{target}.{name}")
            status.append((db, name, "copied"))
        except Exception as problem:  # whatever stops one table must not stop the others
            status.append((db, name, f"failed: {type(problem).__name__}"))
    return status


def table_head(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*order).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
