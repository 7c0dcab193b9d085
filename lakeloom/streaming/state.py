"""Record assembly with state per device: values of the open record, the events behind it, and a timer for silence."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lakeloom.streaming.messages import FIELDS, TAGS

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OPEN = T.StructType([T.StructField(f, T.DoubleType()) for f in FIELDS])
_BEHIND = T.StructType([T.StructField("event", T.LongType())])


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on the executors' disks and in the checkpoint."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class RecordState(StatefulProcessor):
    """One device. The value state holds the latest value of each tag, the list state the events of the open record.

    Rows of a trigger come as a stream; only position, tag and value of known tags are held to put them in order. The list
    grows by appending in the store and is read once, when its record closes. With ``idle_ms`` every input sets the
    device's one timer anew; when it fires, the open record goes.
    """

    def __init__(self, tags: Sequence[str], device: str, order: Sequence[str], event: str, event_time: str, tag: str, value: str, time: str, idle_ms: int | None):
        self.names, self.closing = dict(zip(tags, range(len(tags)), strict=True)), tags[-1]
        self.device, self.order, self.event, self.event_time = device, list(order), event, event_time
        self.tag, self.value, self.time, self.idle_ms = tag, value, time, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.opened = handle.getValueState("opened", _OPEN)
        self.behind = handle.getListState("behind", _BEHIND)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known, latest = [], None
        for r in rows:
            if self.idle_ms is not None and r[self.event_time] is not None:
                latest = r[self.event_time] if latest is None else max(latest, r[self.event_time])
            if r[self.tag] in self.names:
                known.append((tuple(r[c] for c in self.order), self.names[r[self.tag]], r[self.value], r[self.event], r[self.time]))
        known.sort(key=lambda x: tuple((v is not None, v) for v in x[0]))
        current = list(self.opened.get()) if self.opened.exists() else [0.0] * len(self.names)
        fresh: list[tuple] = []
        last = len(self.names) - 1
        for _, place, value, event, time in known:
            current[place] = float(value) if value is not None else 0.0
            fresh.append((event,))
            if place == last:
                if all(v > 0 for v in current):
                    events = [e[0] for e in self.behind.get()] if self.behind.exists() else []
                    yield Row(**{self.device: key[0]}, **dict(zip(FIELDS, current, strict=True)), time=time, events=events + [e[0] for e in fresh])
                if self.behind.exists():
                    self.behind.clear()
                current, fresh = [0.0] * len(self.names), []
        self.opened.update(tuple(current))
        if fresh:
            self.behind.appendList(fresh)
        if latest is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            at = int(latest.timestamp() * 1000)
            self.handle.registerTimer(max(at, timerValues.getCurrentWatermarkInMs() + 1) + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.opened.clear()
        self.behind.clear()
        return iter([])

    def close(self) -> None:
        pass


def assemble_keyed(
    items: DataFrame, device: str, order: Sequence[str], event: str, event_time: str, tag: str, value: str, time: str,
    tags: Sequence[str] = TAGS, idle: timedelta | None = None, watermark: str = "1 hour",
) -> DataFrame:
    """Complete records of a stream with the ids of the ``events`` behind each, in order.

    Items count in the order of their triggers, within a trigger in ``order``. A null value counts as 0 and a record with a
    value not above 0 is dropped at its end, as in the batch twin. Only with ``idle`` there is a watermark: items behind it
    are dropped, and a device silent for that long loses its open record. Start the stream inside ``keyed_state``.

    A trigger's share of one device is put in order in memory, so bound the trigger; for hot devices use
    ``assemble_each_batch``, which splits a device.
    """
    out = T.StructType([
        T.StructField(device, items.schema[device].dataType), *_OPEN.fields,
        T.StructField("time", T.StringType()), T.StructField("events", T.ArrayType(T.LongType())),
    ])
    idle_ms = None if idle is None else int(idle.total_seconds() * 1000)
    processor = RecordState(tags, device, order, event, event_time, tag, value, time, idle_ms)
    if idle is not None:
        items = items.withWatermark(event_time, watermark)
    return items.groupBy(device).transformWithState(processor, out, "append", "None" if idle is None else "EventTime")
