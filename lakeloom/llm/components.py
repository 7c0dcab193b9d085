"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import materialize


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def stars(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 50) -> DataFrame:
    """``hi``, ``lo``: every key that is not the smallest of its component, with the smallest.

    Each round links every key to the smallest key among its neighbours, first for larger neighbours, then for smaller
    ones; rounds grow with the logarithm of the component's size. Minima are combined before they are shuffled, and the
    joins have one side with unique keys, so Spark can split hubs. Each round is written to the shared folder. Links with a
    null end and links of a key to itself are ignored; no links give no rows.
    """
    pairs = links.where((F.col(a) != F.col(b))).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    edges = materialize(pairs, "links")
    mark = _mark(edges)
    for _ in range(most_rounds):
        if not mark[0]:
            return edges
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        large = materialize(large, "links")
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = materialize(moved.union(low.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            return edges
    raise RuntimeError("components did not settle")
