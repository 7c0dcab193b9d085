"""Checked writes: a suite rides on the write, failing rows go aside, and a version is published only if it may be."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.quality import RESULT_COLUMNS, Suite, _row, fault

_PUBLISHED = "number long, version string, schema string"


@dataclass(frozen=True)
class Gate:
    """What a checked write found: result rows as ``validate`` gives them, rows kept and rejected, and whether it is published."""

    results: DataFrame
    failed: list[str]
    kept: int
    rejected: int
    published: bool


def _flat(rows: DataFrame, status: str, reasons: str) -> None:
    taken = {c.lower() for c in rows.columns} & {status, reasons}
    if taken:
        raise ValueError(f"columns {sorted(taken)} have names of the checked write")


def write_checked(rows: DataFrame, path: str, *suites: Suite) -> Gate:
    """Write ``rows`` as a new version below ``path`` and publish it unless a critical suite fails.

    The source is scanned once: the suites' counts are observed while the rows are written, and rows that fail an expectation
    about single values go to the version's ``rejected`` folder, with the names of what they fail in ``reasons``, in the
    same job. Only uniqueness and exact distinct counts read the staged rows again, their column only. The staged version
    becomes visible by one small write (``read_published``); a version that is not published stays for inspection, and
    readers keep the one before. A table without rows is a version too.
    """
    _flat(rows, "status", "reasons")
    spark, version = rows.sparkSession, uuid.uuid4().hex[:12]
    staged = f"{path}/versions/{version}"
    parts: list[Column] = []

    def record(c: Column) -> Column:
        parts.append(c.alias(f"m{len(parts)}"))
        return F.col(f"m{len(parts) - 1}")

    for suite in suites:
        for e in suite.expectations:
            _row(rows, suite, e, record)
    reasons = [F.when(f[0] & f[1], F.lit(f"{e.kind}({e.kwargs['column']})")) for s in suites for e in s.expectations if (f := fault(rows, e))]
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    seen = Observation()
    marked = rows.withColumn("reasons", found).withColumn("status", F.when(F.size("reasons") > 0, "rejected").otherwise("kept"))
    watched = marked.observe(seen, F.count(F.lit(1)).alias("__rows"), F.count_if(F.col("status") == "rejected").alias("__rejected"), *parts)
    watched.write.partitionBy("status").parquet(staged)
    values = seen.get

    names = iter(range(len(parts)))
    back = _staged(spark, staged, rows)
    results = [_row(back, s, e, lambda c: F.col(f"m{next(names)}")) for s in suites for e in s.expectations]
    kinds = marked.agg(F.count(F.lit(1)).alias("__rows"), *parts).schema
    one = spark.createDataFrame([tuple(values[f.name] for f in kinds.fields)], kinds)
    table = one.select(F.inline(F.array(*results))) if results else spark.createDataFrame([], ", ".join(f"`{c}` string" for c in RESULT_COLUMNS))
    got = table.collect()  # one row per expectation
    critical = {s.name for s in suites if s.level == "critical"}
    failed = [f"{r['expectation']}({r['column']})" for r in got if not r["success"] and r["suite"] in critical]
    if not failed:
        last = _versions(spark, path)
        number = 0 if last is None else (last.agg(F.max("number")).first()[0] or 0)
        spark.createDataFrame([(number + 1, version, marked.schema.json())], _PUBLISHED).coalesce(1).write.mode("append").parquet(f"{path}/published")
    kept = values["__rows"] - values["__rejected"]
    return Gate(spark.createDataFrame(got, table.schema), failed, kept, values["__rejected"], not failed)


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_PUBLISHED).parquet(f"{path}/published")
    except AnalysisException:
        return None


def _staged(spark: SparkSession, staged: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.select("*", F.lit("").alias("status")).schema).parquet(staged).select(*[F.col(f"`{c}`") for c in like.columns])


def read_published(spark: SparkSession, path: str, rejected: bool = False) -> DataFrame:
    """The rows kept (or, with their ``reasons``, rejected) by the newest published version."""
    known = _versions(spark, path)
    if known is None:
        raise FileNotFoundError(f"nothing is published below {path}")
    newest = known.orderBy(F.col("number").desc(), "version").first()
    schema = T.StructType.fromJson(json.loads(newest["schema"]))
    rows = spark.read.schema(schema).parquet(f"{path}/versions/{newest['version']}").where(F.col("status") == ("rejected" if rejected else "kept")).drop("status")
    return rows if rejected else rows.drop("reasons")
