"""Copies of partitioned tables that move only what changed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import materialize


def manifest(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Per partition the number of rows and two sums over row hashes that don't depend on order or files."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(rows.columns)])
    other = F.xxhash64(F.lit("again"), row, *[F.isnull(F.col(f"`{c}`")) for c in sorted(rows.columns)])
    return rows.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(38,0)")).alias("digest"), F.sum(other.cast("decimal(38,0)")).alias("check")
    )


def _live(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame | None:
    """The newest manifest row of each partition that is not removed."""
    try:
        log = spark.read.parquet(f"{path}/manifest")
    except AnalysisException:
        return None
    entry = [c for c in log.columns if c not in (*parts, "step")]
    newest = log.groupBy(*parts).agg(F.max_by(F.struct(*entry), "step").alias("e")).select(*parts, "e.*")
    return newest.where("rows > 0")


def _same(a: str, b: str, columns: Sequence[str]):
    return reduce(and_, [F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`")) for c in columns])


def sync_partitions(source: DataFrame, path: str, parts: Sequence[str], at_once: int = 256) -> dict[str, int]:
    """Bring the copy below ``path`` up to date: counts of partitions ``copied``, ``kept`` and ``removed``.

    The source's manifest is compared with the copy's; only changed partitions are copied, ``at_once`` of them per write,
    each write followed by its manifest rows. So a copy that was interrupted goes on with the partitions that are left, and a
    write that was cut off is done again. Partitions that are gone are struck from the manifest. Partition columns may be
    null; an empty source empties the copy. Reading the source's manifest is one scan with map-side sums.
    """
    if not parts:
        raise ValueError("a table is copied by partitions: name at least one column")
    spark, keys = source.sparkSession, list(parts)
    now = materialize(manifest(source, keys), "manifest")
    old = _live(spark, path, keys)
    step = 0 if old is None else (spark.read.parquet(f"{path}/manifest").agg(F.max("step")).first()[0] or 0)
    if old is None:
        changed, gone = now, now.limit(0)
    else:
        old = materialize(old, "manifest")
        changed = now.alias("n").join(old.alias("o"), _same("n", "o", now.columns), "left_anti")
        gone = old.alias("o").join(now.alias("n"), _same("o", "n", keys), "left_anti")
    changed = materialize(changed, "changed")
    count, removed = changed.count(), 0
    groups = -(-count // at_once)
    dealt = materialize(changed.withColumn("group", F.pmod(F.xxhash64(*keys), F.lit(max(groups, 1)))), "changed")
    for g in range(groups):
        own = dealt.where(F.col("group") == g).drop("group")
        rows = source.alias("s").join(own.select(*keys).alias("c"), _same("s", "c", keys), "left_semi")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(f"{path}/data")
        step += 1
        own.withColumn("step", F.lit(step).cast("long")).write.mode("append").parquet(f"{path}/manifest")
    if old is not None:
        removed = gone.count()
        if removed:
            struck = gone.withColumns({"rows": F.lit(0).cast("long"), "step": F.lit(step + 1).cast("long")})
            struck.select(*now.columns, "step").write.mode("append").parquet(f"{path}/manifest")
    return {"copied": count, "kept": now.count() - count, "removed": removed}


def read_copy(spark: SparkSession, path: str, parts: Sequence[str], like: DataFrame) -> DataFrame:
    """The copy's rows, as the manifest has them; columns and types as in ``like``."""
    live = _live(spark, path, parts)
    if live is None:
        raise FileNotFoundError(f"there is no copy below {path}")
    try:
        rows = spark.read.schema(like.schema).parquet(f"{path}/data")
    except AnalysisException:  # nothing was ever copied
        return like.limit(0)
    return rows.alias("d").join(live.select(*parts).alias("l"), _same("d", "l", parts), "left_semi").select(*like.columns)
