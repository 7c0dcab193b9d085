"""A log of predictions that grows batch by batch and never holds a key twice."""

from __future__ import annotations

from math import ceil, log2

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.session import materialize

NO_KEY, REPEATED, KNOWN = "no key", "repeated in the batch", "already in the log"
COUNTS = ("kept", "no_key", "repeated", "known", "suspects")

_COMMIT = "batch string, power int, kept long, no_key long, repeated long, known long, suspects long"


def _bits(key: str) -> Column:
    """Four bits of a 64-bit word."""
    h = F.xxhash64(F.lit("bits"), F.col(key))
    word = F.lit(0).cast("long")
    for i in range(4):
        at = F.pmod(F.shiftrightunsigned(h, 6 * i), F.lit(64)).cast("int")
        word = word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return word


def _slot(key: str, power: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.call_function("shiftleft", F.lit(1).cast("long"), power))


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch that is whole."""
    try:
        return spark.read.schema(_COMMIT).parquet(f"{path}/commits")
    except AnalysisException:
        return spark.createDataFrame([], _COMMIT)


def _suspects(keys: DataFrame, key: str, path: str, commits: DataFrame) -> DataFrame | None:
    """(key, batch) wherever a batch's filter can't rule the key out; None while the log holds no key."""
    spark = keys.sparkSession
    sizes = [r["power"] for r in commits.where("kept > 0").select("power").distinct().collect()]
    if not sizes:
        return None
    # filters of one size are asked once, so a key is asked at most once per size: these are powers of two
    asked = keys.select(key, F.explode(F.array(*[F.lit(p) for p in sizes])).alias("power"))
    asked = asked.select("*", _slot(key, F.col("power")).alias("slot"), _bits(key).alias("wanted"))
    filters = spark.read.parquet(f"{path}/filters").join(commits.select("batch"), "batch", "left_semi")
    hit = asked.join(filters, ["power", "slot"]).where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    return hit.select(key, "batch")


def append_to_log(rows: DataFrame, path: str, batch: str, key: str = "record_key", bits_per_key: int = 12) -> dict[str, int]:
    """Add a batch to the log below ``path``; counts of rows ``kept``, rejected (``no_key``, ``repeated``, ``known``) and of
    ``suspects``, the pairs of key and batch that had to be looked up.

    Rejected rows are stored with their ``reason``: the key is null, stands on several rows of the batch (none of them is
    kept, as none is known to be right), or is in the log. Every batch leaves a Bloom filter of its keys, stored as rows
    (slot, 64 bits) and about ``bits_per_key`` bits per key. A new batch joins its distinct keys with the filters by slot, and
    only keys that a filter lets pass are joined with the keys of that batch. So rows of the log are read for suspects only;
    keys, filters and rows are all shuffled by Spark, nothing of them reaches the driver. A batch counts once its commit row
    is written: what an interrupted append left is overwritten by the next try, and a batch that is in the log is not added
    again (its counts are returned). An empty batch is a batch too. Batches are appended one at a time.
    """
    spark, folder = rows.sparkSession, _folder(batch)
    taken = {"batch", "state", "reason"} & {c.lower() for c in rows.columns}
    if taken:
        raise ValueError(f"the log has columns of its own named {sorted(taken)}")
    commits = _commits(spark, path)
    done = commits.where(F.col("batch") == batch).first()
    if done:
        return {c: done[c] for c in COUNTS}
    rows = materialize(rows, "log-batch")
    keys = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    keys = materialize(keys, "log-keys")
    once = keys.where("n = 1").select(key)
    reasons = keys.where("n > 1").select(key, F.lit(REPEATED).alias("reason"))
    found, suspects = _suspects(once, key, path, commits), 0
    if found is not None:
        found = materialize(found, "log-suspects")
        suspects = found.count()
        log = spark.read.schema(_stored(rows)).parquet(f"{path}/rows").where("state = 'kept'").select(key, "batch")
        known = found.join(log, [key, "batch"], "left_semi").select(key, F.lit(KNOWN).alias("reason")).distinct()
        reasons = reasons.unionByName(known)
    judged = rows.join(materialize(reasons, "log-reasons"), key, "left").select(*rows.columns, "reason")
    judged = judged.withColumn("reason", F.when(F.col(key).isNull(), NO_KEY).otherwise(F.col("reason")))
    out = judged.withColumn("state", F.when(F.col("reason").isNull(), "kept").otherwise("rejected"))
    # the batch's own folder is overwritten as a whole, so nothing stays of a try that was cut off
    out.write.mode("overwrite").partitionBy("state").parquet(f"{path}/rows/batch={folder}")
    stored = spark.read.schema(_stored(rows)).parquet(f"{path}/rows").where(F.col("batch") == batch)
    by = {(r["state"], r["reason"]): r["n"] for r in stored.groupBy("state", "reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept = by.get(("kept", None), 0)
    power = max(0, ceil(log2(max(1, kept * bits_per_key / 64))))
    words = stored.where("state = 'kept'").groupBy(_slot(key, F.lit(power)).alias("slot")).agg(F.bit_or(_bits(key)).alias("bits"))
    words = words.select("slot", "bits", F.lit(power).alias("power"))
    words.write.mode("overwrite").parquet(f"{path}/filters/batch={folder}")
    counts = {
        "kept": kept, "no_key": by.get(("rejected", NO_KEY), 0), "repeated": by.get(("rejected", REPEATED), 0),
        "known": by.get(("rejected", KNOWN), 0), "suspects": suspects,
    }
    row = spark.createDataFrame([(batch, power, *[counts[c] for c in COUNTS])], _COMMIT)
    row.coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return counts


def _folder(batch: str) -> str:
    """A batch's name as it can stand in a path; only letters, digits, dots and dashes are taken."""
    if not batch or not all(c.isascii() and (c.isalnum() or c in "-._") for c in batch):
        raise ValueError(f"{batch!r} can't name a batch")
    return batch


def _stored(rows: DataFrame) -> T.StructType:
    text = T.StringType()
    return T.StructType([*rows.schema.fields, T.StructField("reason", text), T.StructField("batch", text), T.StructField("state", text)])


def read_log(spark: SparkSession, path: str, like: DataFrame, state: str = "kept") -> DataFrame:
    """Rows of whole batches with their ``batch`` (and the ``reason`` of ``rejected`` ones); other columns as in ``like``."""
    more = ["batch"] if state == "kept" else ["reason", "batch"]
    try:
        rows = spark.read.schema(_stored(like)).parquet(f"{path}/rows")
    except AnalysisException:
        raise FileNotFoundError(f"there is no log below {path}") from None
    whole = _commits(spark, path).select("batch")
    return rows.where(F.col("state") == state).join(whole, "batch", "left_semi").select(*like.columns, *more)
