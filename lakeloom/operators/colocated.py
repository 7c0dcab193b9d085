"""Tables stored in buckets of a shared key, so that joins on it need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeloom.operators.ordering import ROWS_PER_CUT, split_hot


@dataclass(frozen=True)
class Colocated:
    """A bucketed catalog table and, apart from it, the folder with rows of keys too large for one bucket's task."""

    table: str
    key: str
    buckets: int
    hot: str | None = None


def save_colocated(rows: DataFrame, table: str, key: str, path: str, buckets: int, hot_rows: int | None = ROWS_PER_CUT) -> Colocated:
    """Store ``rows`` in ``buckets`` files, one per bucket of ``key``, in order of the key.

    A bucket is read by one task and no later step can split it, so rows of keys with more than ``hot_rows`` rows (missing
    keys included) go to a folder of their own; None keeps them in, for tables with few rows per key. Tables that are to be
    joined need the same number of buckets and the same type of key.
    """
    cool, hot = (rows, None) if hot_rows is None else split_hot(rows, [key], hot_rows)
    writer = cool.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.mode("overwrite").format("parquet").option("path", f"{path}/buckets").saveAsTable(table)
    if hot is not None:
        hot.write.mode("overwrite").parquet(f"{path}/hot")
    return Colocated(table, key, buckets, None if hot is None else f"{path}/hot")


def left_join_colocated(spark: SparkSession, facts: Colocated, others: Sequence[Colocated]) -> DataFrame:
    """Facts with the columns of the other tables, joined on the facts' key; all facts stay.

    Bucket meets bucket in one task, for any number of tables, without an exchange. Facts of hot keys are joined apart, as
    they are stored, where Spark may broadcast the few rows they meet or split them as skewed. The other tables must be whole
    (stored with ``hot_rows=None``); their keys are dropped, other columns must have names of their own.
    """
    for o in others:
        if o.hot is not None or o.buckets != facts.buckets:
            raise ValueError(f"{o.table} must be stored whole and in {facts.buckets} buckets")

    def joined(rows: DataFrame) -> DataFrame:
        names = {c.lower() for c in rows.columns}
        for o in others:
            other = spark.table(o.table)
            clash = sorted(names & {c.lower() for c in other.columns if c != o.key})
            if clash:
                raise ValueError(f"{o.table}: columns {clash} are there already")
            names |= {c.lower() for c in other.columns}
            rows = rows.alias("f").join(other.alias("o"), rows[facts.key] == other[o.key], "left")
            rows = rows.drop(other[o.key]) if o.key != facts.key else rows.select("f.*", *[other[c] for c in other.columns if c != o.key])
        return rows

    cool = joined(spark.table(facts.table))
    return cool if facts.hot is None else cool.unionByName(joined(spark.read.parquet(facts.hot)))
