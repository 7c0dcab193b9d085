"""File scans and sinks."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_parquet_tree(spark: SparkSession, folder: str, suffix: str = ".snappy.parquet") -> DataFrame:
    """Every file with the suffix below a folder, at any depth, as one table."""
    return (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").parquet(folder)
    )


def assert_same_schema(tables: Sequence[DataFrame]) -> None:
    """Raise unless all tables have the first one's columns and types."""
    shapes = [[(f.name, f.dataType.simpleString()) for f in t.schema] for t in tables]
    for s in shapes[1:]:
        if s != shapes[0]:
            raise ValueError(f"schemas differ: {shapes[0]} and {s}")


def scan_table(spark: SparkSession, name: str | None) -> DataFrame:
    if not name:
        raise ValueError("a table name is needed")
    return spark.table(name)


def scan_source(
    spark: SparkSession, platform: str = "files", folder: str | None = None, file: str | None = None, table: str | None = None
) -> DataFrame:
    """One entry for the three kinds of sources; exactly one of folder and file on the file platform."""
    if platform == "catalog":
        return scan_table(spark, table)
    if platform != "files":
        raise ValueError(f"unknown platform {platform!r}")
    if bool(folder) == bool(file):
        raise ValueError("give either a folder or a file")
    return scan_parquet_tree(spark, folder) if folder else scan_parquet(spark, file)


def load_tables(spark: SparkSession, paths: Sequence[str]) -> dict[str, DataFrame]:
    """Lazy tables keyed by file stem."""
    return {PurePosixPath(p).stem: spark.read.parquet(p) for p in paths}


def scan_csv_na(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    """CSV where the text ``NA`` is text and empty text cells are empty text, not missing."""
    df = spark.read.schema(schema).option("header", "true").option("sep", sep).option("encoding", "UTF-8").csv(path)
    return df.na.fill("", [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])


def scan_csv_text(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """Delimited file with a header; every column is read as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("sep", sep).option("header", "true").csv(path)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def scan_documents(spark: SparkSession, folder: str, suffix: str = ".md") -> DataFrame:
    """Whole text and path of every document below a folder."""
    return (
        spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{suffix}")
        .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))
    )


def scan_json_values(spark: SparkSession, paths: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Flat JSON files merged to (name, text, value) rows, every key there is or the listed ones; the last file wins.

    ``text`` is the value as text (strings as they are, anything else as JSON), ``value`` the number where it is one.
    """
    parts = []
    for i, p in enumerate(paths):
        whole = spark.read.text(p, wholetext=True).filter(F.trim("value") != "")
        # one record per line, or one over the whole file; an unreadable file stops the job
        lines = whole.select(F.explode(F.split("value", r"\n(?=\s*\{)")).alias("line")).filter(F.trim("line") != "")
        read = F.from_json("line", "map<string,string>", {"mode": "FAILFAST"})
        parts.append(lines.select(F.explode(read).alias("name", "text")).withColumn("at", F.lit(i)))
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    merged = merged.filter(F.col("text").isNotNull())
    if names is not None:
        merged = merged.filter(F.col("name").isin(list(names)))
    last = merged.groupBy("name").agg(F.max_by("text", "at").alias("text"))
    return last.withColumn("value", F.col("text").try_cast("double"))


def payload_records(df: DataFrame, column: str, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``{"data": [{...}, ...]}`` text to one row per record, with ``reason`` where it can't be used.

    Reasons: ``unreadable`` (the payload as a whole has no such list; one row), ``missing <field>`` (the first field that is
    absent or no number). An empty list has no record and no row.
    """
    record = ", ".join(f"`{f}`: double" for f in fields)
    parsed = df.select(*keep, F.col(column).alias("payload"), F.from_json(F.col(column), f"data array<struct<{record}>>")["data"].alias("__data"))
    nobody = F.array(F.lit(None).cast(f"struct<{record}>"))
    rows = parsed.withColumn("__r", F.explode(F.coalesce("__data", nobody)))
    reason = F.when(F.col("__data").isNull(), "unreadable")
    for f in fields:
        reason = reason.when(F.col("__r")[f].isNull(), f"missing {f}")
    return rows.select(*keep, *[F.col("__r")[f].alias(f) for f in fields], "payload", reason.alias("reason"))


def parse_payload(df: DataFrame, column: str, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The usable records of ``payload_records``; ``rejected_payloads`` has the others."""
    return payload_records(df, column, fields, keep).filter("reason IS NULL").select(*keep, *fields)


def rejected_payloads(df: DataFrame, column: str, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Payload and reason of every record that ``parse_payload`` leaves out."""
    return payload_records(df, column, fields, keep).filter("reason IS NOT NULL").select(*keep, "payload", "reason")


def sql_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run SQL; tables are passed by name as ``{name}``."""
    return spark.sql(sql, **tables)


def rows_of(df: DataFrame):
    """Iterate over rows one partition at a time, so the driver never holds the whole table."""
    return df.toLocalIterator(prefetchPartitions=True)


def file_inventory(spark: SparkSession, folder: str, extensions: Sequence[str] | None = None) -> DataFrame:
    """Files and bytes per extension below a folder; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    )
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    listed = files.select(ext.alias("extension"), "length")
    if extensions is not None:
        listed = listed.filter(F.col("extension").isin([e.lower() for e in extensions]))
    return listed.groupBy("extension").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def table_inventory(df: DataFrame) -> DataFrame:
    """Rows and bytes of each file that a table read from files takes rows from."""
    meta = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return meta.groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("rows"))


# --- sinks -----------------------------------------------------------------------------------------------


def save_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet", mode: str = "overwrite") -> dict[str, str]:
    """One dataset per table below a folder; returns the paths."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        writer = df.write.format(fmt).mode(mode)
        if fmt == "csv":
            writer = writer.option("header", "true")
        writer.save(paths[name])
    return paths


def save_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    # cells are quoted as needed; an empty text is written as "" and so differs from a missing cell
    df.write.mode("overwrite").option("header", "true").option("sep", sep).csv(path)
    return path


def save_values(spark: SparkSession, values: Mapping[str, object], path: str) -> str:
    """A flat JSON record of scalars; sets become text."""
    # numpy scalars and arrays know tolist()
    plain = {k: str(sorted(v)) if isinstance(v, (set, frozenset)) else v for k, v in values.items()}
    clean = {k: v.tolist() if hasattr(v, "tolist") else v for k, v in plain.items()}
    spark.range(1).select(*[F.lit(v).alias(k) for k, v in clean.items()]).coalesce(1).write.mode("overwrite").json(path)
    return path


def json_records(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Each row as a JSON record."""
    return df.select(*keep, F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("record"))


def convert_to_parquet(spark: SparkSession, source: str, target: str, schema: T.StructType | str | None = None) -> str:
    """CSV or parquet file to parquet; an existing target or another file type is an error."""
    kind = PurePosixPath(source).suffix.lower()
    if kind == ".csv":
        if schema is None:
            raise ValueError("a CSV source needs a schema")
        df = scan_csv_na(spark, source, schema)
    elif kind == ".parquet":
        df = spark.read.parquet(source)
    else:
        raise ValueError(f"unsupported file type {kind!r}")
    df.write.mode("errorifexists").parquet(target)
    return target


def convert_files(spark: SparkSession, sources: Sequence[str], folder: str, schemas: Mapping[str, str] = {}) -> list[str]:
    """Several files to parquet below a folder, named by their stems; ``schemas`` by stem for CSV files."""
    stems = [PurePosixPath(p).stem for p in sources]
    return [convert_to_parquet(spark, p, f"{folder}/{s}.parquet", schemas.get(s)) for p, s in zip(sources, stems)]


def write_by_part(df: DataFrame, part: str, path: str) -> str:
    """One output folder per part; a hot part is spread over several files by Spark's write balancing."""
    df.hint("rebalance", part).write.mode("overwrite").partitionBy(part).parquet(path)
    return path


def partitioned_job(spark: SparkSession, source: str, target: str, job: Callable[[DataFrame], DataFrame]) -> str:
    """Run a row-wise job over every subfolder at once; each keeps its own output folder.

    The subfolder comes from the file path, so all of them are read and written by one plan.
    """
    files = spark.read.option("recursiveFileLookup", "true").parquet(source)
    folder = F.regexp_extract(F.col("_metadata.file_path"), re.escape(source.rstrip("/").split("/")[-1]) + "/(.*)/[^/]*$", 1)
    named = files.select("*", F.url_decode(folder).alias("part"))
    return write_by_part(job(named), "part", target)


def monitoring_log(
    df: DataFrame, features: Sequence[str], actual: str, predicted: str, key: Sequence[str], dataset: Column, batch_id: str | None = None
) -> DataFrame:
    """Prediction log: unique key, features, actual and predicted value, data set and batch."""
    return df.select(
        F.concat_ws("-", *[F.col(k).cast("string") for k in key], F.lit(batch_id).cast("string")).alias("record_key"),
        *features,
        F.col(actual).alias("actual"),
        F.col(predicted).alias("output"),
        dataset.alias("dataset"),
        F.lit(batch_id).cast("string").alias("batch_id"),
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
