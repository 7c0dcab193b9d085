"""Assembly of complete records from a stream of tag/value items, and its batch twin.

A device sends items one tag at a time. Each item sets its tag in the open record. The closing tag ends the
record: it is emitted when all tags are above 0, dropped otherwise, and a new record starts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakeloom.functions.scalars import parse_message_time
from lakeloom.operators.ordering import ROWS_PER_CUT, running
from lakeloom.operators.quality import Suite, validate

# fixed values: the four tags in record order; the last one closes a record
TAGS = ("Iris.SepalLength", "Iris.SepalWidth", "Iris.PetalLength", "Iris.PetalWidth")
FIELDS = ("sepal_length", "sepal_width", "petal_length", "petal_width")

def parse_items(messages: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Message text to one row per item, in message order; either spelling of the item keys is read."""
    parsed = F.from_json(F.col(column), "Items array<map<string, string>>")
    items = messages.select(*keep, F.posexplode(parsed["Items"]).alias("item_index", "i"))

    def field(name: str) -> Column:
        return F.coalesce(F.col("i")[name], F.col("i")[name[0].lower() + name[1:]])

    return items.select(
        *keep,
        "item_index",
        field("Tag").alias("tag"),
        field("NumericValue").try_cast("double").alias("value"),
        field("TimeStamp").alias("time_text"),
    )


def number_records(
    items: DataFrame, device: str, order: Sequence[str], position: Column, tag: str, value: str, time: str,
    tags: Sequence[str] = TAGS, rows_per_cut: int = ROWS_PER_CUT, also: Sequence[Column] = (),
) -> DataFrame:
    """One row per device and record: the latest value of each tag, the closing time, whether it is closed.

    The number of closing tags before an item is its record number, so the records of a hot device spread
    over the tasks.
    """
    closing = F.col(tag) == tags[-1]
    known = items.filter(F.col(tag).isin(list(tags)))
    closes = F.when(closing, 1).otherwise(0).cast("long")
    counted = running(known, [device], order, position, {"__closed": closes}, rows_per_cut=rows_per_cut)
    at = F.struct(*order)
    latest = [
        F.max_by(F.when(F.col(tag) == t, F.col(value)), F.when(F.col(tag) == t, at)).alias(f) for t, f in zip(tags, FIELDS)
    ]
    return (
        counted.withColumn("__record", F.col("__closed") - closes)
        .groupBy(device, "__record")
        .agg(*latest, F.max(F.when(closing, F.col(time))).alias("time"), F.max(closing).alias("__ends"), *also)
    )


def complete_records(records: DataFrame, device: str) -> DataFrame:
    """Closed records with all values above 0."""
    whole = F.col("__ends")
    for f in FIELDS:
        whole = whole & (F.coalesce(F.col(f), F.lit(0.0)) > 0)
    return records.filter(whole).select(device, *FIELDS, "time")


def assemble_batch(
    items: DataFrame, device: str, order: Sequence[str], position: Column, tag: str, value: str, time: str,
    tags: Sequence[str] = TAGS, rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Complete records of a finished table of items."""
    return complete_records(
        number_records(items, device, order, position, tag, value, time, tags, rows_per_cut), device
    )


def assemble_each_batch(
    out: str, state: str, device: str, order: Sequence[str], position: Column, tag: str, value: str, time: str,
    tags: Sequence[str] = TAGS, rows_per_cut: int = ROWS_PER_CUT, idle: float | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for streams where one device may send most items.

    Every micro-batch is assembled like a table, in parallel within a device. The open records (at most one row
    per device) go to a state folder and open the next batch. Both folders carry the batch number, so a repeated
    batch writes the same again. With ``idle``, a device whose last item lies further back than that (in units of
    the position) loses its open record, so the state cannot grow without end.
    """
    columns = [device, *order, tag, value, time]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.select(*columns, F.lit(1).alias("__new"), position.cast("double").alias("__seen"))
        if batch_id > 0:
            kept = spark.read.parquet(f"{state}/batch={batch_id - 1}")
            pairs = F.array(*[F.struct(F.lit(t).alias("t"), F.col(f).alias("v")) for t, f in zip(tags, FIELDS)])
            old = kept.select(device, "__seen", F.inline(pairs)).filter(F.col("v").isNotNull())
            blank = {c: F.lit(None).cast(fresh.schema[c].dataType) for c in (*order, time)}
            old = old.withColumnsRenamed({"t": tag, "v": value}).withColumns({**blank, "__new": F.lit(0)})
            fresh = fresh.unionByName(old)
        # what was open before comes first; a NULL position does so too
        place = F.when(F.col("__new") == 1, position)
        seen = F.max("__seen").alias("__seen")
        records = number_records(
            fresh, device, ["__new", *order], place, tag, value, time, tags, rows_per_cut, also=[seen]
        ).persist()
        complete_records(records, device).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        still_open = records.filter(~F.col("__ends"))
        if idle is not None:
            newest = records.agg(seen).scalar()
            still_open = still_open.filter(F.col("__seen") >= newest - F.lit(float(idle)))
        still_open.select(device, *FIELDS, "__seen").write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        records.unpersist()

    return run


_STATE = T.StructType([T.StructField(f, T.DoubleType()) for f in FIELDS])


def assemble_stream(
    items: DataFrame, device: str, order: Sequence[str], event_time: str, tag: str, value: str, time: str,
    tags: Sequence[str] = TAGS, close_on: str = "last_tag", idle: str | None = None, watermark: str = "1 hour",
) -> DataFrame:
    """Complete records of a stream; the open record of each device is kept as state.

    Items count in the order of their triggers, within a trigger in ``order``; none is dropped as late.
    ``close_on="all_present"`` ends a record once all tags are set instead of at the last tag. Only with ``idle``
    there is a watermark: items behind it are dropped, and a device that stays silent past it by ``idle`` loses its open
    record, so that state cannot grow without end.
    """
    if close_on not in ("last_tag", "all_present"):
        raise ValueError(f"unknown close_on {close_on!r}")
    names = dict(zip(tags, FIELDS))
    closing = tags[-1]
    kind = items.schema[device].dataType
    out = T.StructType(
        [T.StructField(device, kind), *_STATE.fields, T.StructField("time", T.StringType())]
    )
    idle_ms = None if idle is None else int(pd.Timedelta(idle).total_seconds() * 1000)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        open_record = dict(zip(FIELDS, state.get)) if state.exists else dict.fromkeys(FIELDS, 0.0)
        # a trigger's share of one device, put in order; the source's trigger limit bounds it.
        # Streams with a hot device use assemble_each_batch instead
        rows = pd.concat(list(batches)).sort_values(list(order))
        done = []
        for t, v, when in zip(rows[tag], rows[value], rows[time]):
            if t not in names:
                continue
            open_record[names[t]] = float(v) if v is not None else 0.0
            full = all(x > 0 for x in open_record.values())
            ends = t == closing if close_on == "last_tag" else full
            if ends:
                if full:
                    done.append((key[0], *[open_record[f] for f in FIELDS], str(when)))
                open_record = dict.fromkeys(FIELDS, 0.0)
        state.update(tuple(open_record[f] for f in FIELDS))
        if idle_ms is not None:
            last = pd.Timestamp(rows[event_time].max()).value // 1_000_000
            state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs() + 1) + idle_ms)
        if done:
            yield pd.DataFrame(done, columns=out.names)

    if idle is None:
        timeout = GroupStateTimeout.NoTimeout
    else:
        items, timeout = items.withWatermark(event_time, watermark), GroupStateTimeout.EventTimeTimeout
    return items.groupBy(device).applyInPandasWithState(step, out, _STATE, "append", timeout)


def scored_records(records: DataFrame, score: Column, time: str = "time") -> DataFrame:
    """Score and posting time per record; an unreadable time marks the row as a dead letter."""
    posted = parse_message_time(F.col(time))
    return records.withColumns(
        {"iris_type": score, "posted_at": posted, "dead_letter": posted.isNull()}
    )


def check_each_batch(suite: Suite, sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that runs a quality suite on every micro-batch and hands on its result rows."""

    def run(batch: DataFrame, batch_id: int) -> None:
        sink(validate(batch, suite).withColumn("batch_id", F.lit(batch_id)), batch_id)

    return run


def append_metrics(path: str, keys: Sequence[str], sums: dict[str, Column]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that writes each micro-batch's totals below its own batch folder.

    A repeated batch overwrites its folder, so a restart counts nothing twice.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy(*keys).agg(*[c.alias(n) for n, c in sums.items()]).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}"
        )

    return run
