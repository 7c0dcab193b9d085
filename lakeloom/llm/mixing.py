"""Mix sources to target weights with a low-discrepancy schedule. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import materialize

GOLDEN = (math.sqrt(5) - 1) / 2
SPLIT = 1 << 20
CELLS = 4096
#: Copies of one row that a single row of counts stands for before they are dealt to tasks.
COPIES = 1 << 16


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most_epochs: int = 3) -> DataFrame:
    """One row per source: ``source``, ``part`` (its place by code point, null last, from 0), ``source_size``, ``target``.

    Weights repeat along the sources. All words are shared by weight; a target stops at ``most_epochs`` times its
    source's words and the excess goes to the others by weight. With T words in all that is
    min(most_epochs * size, level * weight) at the level where the targets sum up to T: sources fill up in the order of
    size / weight, so the level follows from sums over the sources that are not yet full. ``sized`` needs ``source`` and
    ``size``. The windows here run over one row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    places = totals.withColumn("part", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("part") % len(weights) + 1).cast("int"))
    full = places.withColumn("_w", weight).withColumn("_full", F.col("source_size") * float(most_epochs))
    filling = Window.orderBy(F.col("_full") / F.col("_w"), "part")
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_full").over(before), F.lit(0.0))) / F.sum("_w").over(rest)
    levels = full.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_full"))
    first = F.min(F.when(F.col("_open"), F.struct(F.col("_full") / F.col("_w"), F.col("part"), F.col("_level").alias("level")))).over(everything)
    found = levels.withColumn("_found", first)
    target = F.least(F.col("_full"), F.coalesce(F.col("_found.level") * F.col("_w"), F.col("_full")))
    return found.select("source", "part", "source_size", target.alias("target"))


def schedule(targets: DataFrame, words: int, block: int) -> DataFrame:
    """Slots in mixing order: ``slot``, ``part`` and ``rank``, the slot's place among its source's slots (from 0).

    Point i is the fraction of i times the golden ratio; it picks the source whose share of the cumulative targets holds
    it. Any run of slots thus holds the sources nearly by their targets. Ranks are counted within runs of 2^20 slots and
    offset by the counts of earlier runs, so that no source's slots meet in one task.
    """
    spark = targets.sparkSession
    up_to = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("target").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    spans = targets.where("target > 0").select("part", (F.sum("target").over(up_to) / total).alias("_high"), (F.col("target") / total).alias("_share"))
    spans = spans.withColumn("_low", F.coalesce(F.lag("_high").over(Window.orderBy("part")), F.lit(0.0)))
    last = F.row_number().over(Window.orderBy(F.col("part").desc())) == 1
    spans = spans.withColumn("_high", F.when(last, F.lit(2.0)).otherwise(F.col("_high")))
    cell = F.least(F.floor(F.col("_high") * CELLS), F.lit(CELLS - 1))
    spans = spans.select("part", "_low", "_high", F.explode(F.sequence(F.floor(F.col("_low") * CELLS), F.greatest(cell, F.floor(F.col("_low") * CELLS)))).alias("_cell"))
    count = -(-words // block) if words else 0
    slots = spark.range(count).withColumnRenamed("id", "slot")
    high = F.floor(F.col("slot") / SPLIT)
    point = high * math.fmod(SPLIT * GOLDEN, 1.0) + (F.col("slot") % SPLIT + 1) * GOLDEN
    slots = slots.withColumn("_run", high).withColumn("_u", point - F.floor(point))
    slots = slots.withColumn("_cell", F.floor(F.col("_u") * CELLS))
    placed = slots.join(spans, (slots["_cell"] == spans["_cell"]) & (F.col("_u") >= F.col("_low")) & (F.col("_u") < F.col("_high")))
    placed = placed.select("slot", "part", "_run")
    runs = placed.groupBy("part", "_run").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("part").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "_run", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("part", "_run").orderBy("slot")) - 1
    ranked = placed.withColumn("_own", own).join(runs, ["part", "_run"])
    return ranked.select("slot", "part", (F.col("_own") + F.col("_before")).alias("rank"))


def numbered(sized: DataFrame, copies: int = COPIES) -> DataFrame:
    """Every row with ``_copy_no``, its number among equal rows (from 1).

    Equal rows are counted (combined before the shuffle) and told apart afterwards, so an id on a third of all rows meets in
    no task; counts above ``copies`` are dealt to tasks in runs first. Reruns number the same.
    """
    keys = ("doc_id", "source", "size")
    counted = sized.groupBy(*keys).agg(F.count("*").alias("_n"))
    few = counted.where(F.col("_n") <= copies).select(*keys, F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_copy_no"))
    many = counted.where(F.col("_n") > copies).withColumn("_first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"), F.lit(copies).cast("long"))))
    tasks = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = many.repartition(tasks, *keys, "_first")
    last = F.least(F.col("_n"), F.col("_first") + copies - 1)
    return few.unionByName(dealt.select(*keys, F.explode(F.sequence(F.col("_first"), last)).alias("_copy_no")))


def shuffled_blocks(sized: DataFrame, targets: DataFrame, block: int, most_epochs: int, seed: str) -> DataFrame:
    """Pieces of documents in their source's blocks of ``block`` words: each source's documents stand in hash order, end to
    end, ``most_epochs`` times over, cut at the source's target. A piece has ``part``, ``block``, ``words``, ``epoch`` and
    its document's row (``_bucket``, ``_row``, ``doc_id``, ``size``); documents without a piece have null there. Repeated
    ids get a hash each.
    """
    rows = numbered(sized).join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("_hash", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "_copy_no")))
    rows = rows.withColumn("_bucket", F.substring("_hash", 1, 3)).drop("_source")
    within = Window.partitionBy("part", "_bucket").orderBy("_hash", "doc_id", "size", "_copy_no")
    sums = rows.groupBy("part", "_bucket").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("part").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    rows = rows.withColumn("_row", F.row_number().over(within))
    rows = rows.withColumn("_end", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.join(sums, ["part", "_bucket"]).withColumn("_start", F.col("_before") + F.col("_end") - F.col("size"))
    limit = F.round("target").cast("long")
    copies = F.transform(
        F.sequence(F.lit(0), F.lit(most_epochs - 1)),
        lambda e: F.struct(
            e.alias("epoch"),
            (F.col("_start") + e * F.col("source_size")).alias("a"),
            F.least(F.col("_start") + F.col("size") + e * F.col("source_size"), limit).alias("b"),
        ),
    )
    rows = rows.withColumn("_copy", F.explode_outer(F.filter(copies, lambda c: c["a"] < c["b"])))
    blocks = F.when(F.col("_copy").isNotNull(), F.sequence(F.floor(F.col("_copy.a") / block), F.floor((F.col("_copy.b") - 1) / block)))
    rows = rows.withColumn("block", F.explode_outer(blocks))
    words = F.least(F.col("_copy.b"), (F.col("block") + 1) * block) - F.greatest(F.col("_copy.a"), F.col("block") * block)
    return rows.select("part", "block", words.alias("words"), F.col("_copy.epoch").alias("epoch"), "_bucket", "_row", "doc_id", "size", "source_size", "target")


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most_epochs: int = 3, block: int = 32, seed: str = "mix"
) -> tuple[DataFrame, DataFrame]:
    """(mixture, taken). ``docs`` needs ``doc_id``, ``source`` and ``size``; it is read several times, so pass a written table.

    mixture: the schedule joined with the blocks it takes: ``slot``, ``part``, ``rank``, ``doc_id``, ``epoch``, ``words``.
    taken: one row per row of ``docs`` with ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``.
    A source gets its number of slots times ``block`` words, the last block cut at the target; the schedule deviates from
    the target by a few blocks at most. A document is taken at most ``most_epochs`` times as a whole.
    Null sources are one source (last); documents without words take part with 0; repeated rows stay apart; an
    empty table gives no rows.
    """
    sized = docs.select("doc_id", "source", "size")
    targets = materialize(source_targets(sized, weights, most_epochs), "mix-targets")
    words = int(targets.agg(F.sum("source_size")).first()[0] or 0)
    slots = schedule(targets, words, block).withColumnRenamed("rank", "block")
    pieces = shuffled_blocks(sized, targets, block, most_epochs, seed)
    mixture = slots.join(pieces, ["part", "block"]).select("slot", "part", F.col("block").alias("rank"), "doc_id", "epoch", "words")
    used = pieces.join(slots.select("part", "block", F.lit(True).alias("_used")), ["part", "block"], "left")
    taken = used.groupBy("part", "_bucket", "_row", "doc_id", "size", "source_size", "target").agg(
        F.coalesce(F.sum(F.when(F.col("_used"), F.col("words"))), F.lit(0)).cast("long").alias("taken")
    )
    return mixture, taken.select("doc_id", "size", "source_size", "target", "taken")


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` of every document, written once; the text is read once."""
    return materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
