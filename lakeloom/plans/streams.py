"""Message assembly over the supplied events, as a stream and as its batch twin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.scalars import seconds_of
from lakeloom.operators.models import linear_score
from lakeloom.operators.quality import Expectation, Suite
from lakeloom.plans.registry import Tables, near, near_sql, query
from lakeloom.session import scratch_path
from lakeloom.streaming import messages as S
from lakeloom.streaming.learning import model_after, update_each_batch
from lakeloom.streaming.state import assemble_keyed, keyed_state

# event types play the sensor tags; errors are a tag nobody knows
TAG_OF = {"view": S.TAGS[0], "click": S.TAGS[1], "signup": S.TAGS[2], "purchase": S.TAGS[3], "error": "Iris.Color"}
ORDER = ["ts", "event_id"]


def as_items(events: DataFrame) -> DataFrame:
    tag = F.when(F.lit(False), "")
    for kind, name in TAG_OF.items():
        tag = tag.when(F.col("event_type") == kind, name)
    return events.select(
        "event_id", "ts", "user_id", tag.alias("tag"), F.col("value").alias("value"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
    )


ASSEMBLE_SQL = """
k AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
        - CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS record FROM events WHERE event_type <> 'error'),
rec AS (SELECT user_id, arg_max(value, (ts, event_id)) FILTER (WHERE event_type = 'view') AS sepal_length,
  arg_max(value, (ts, event_id)) FILTER (WHERE event_type = 'click') AS sepal_width, arg_max(value, (ts, event_id)) FILTER (WHERE event_type = 'signup') AS petal_length,
  arg_max(value, (ts, event_id)) FILTER (WHERE event_type = 'purchase') AS petal_width,
  max(strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')) FILTER (WHERE event_type = 'purchase') AS time FROM k GROUP BY user_id, record),
complete AS (SELECT * FROM rec WHERE sepal_length > 0 AND sepal_width > 0 AND petal_length > 0 AND petal_width > 0)"""


@query("assemble_records", f"WITH {ASSEMBLE_SQL} SELECT user_id, sepal_length, sepal_width, petal_length, petal_width, time FROM complete")
def assemble_records(t: Tables) -> DataFrame:
    return S.assemble_batch(as_items(t.events), "user_id", ORDER, seconds_of("ts"), "tag", "value", "time")


def event_stream(t: Tables) -> DataFrame:
    """The events table, one file or a folder of files, as a stream; a bounded number of files per trigger."""
    # as a pattern the path may be either; by itself a stream takes a folder only
    path = t.path("events").removesuffix("t") + "[t]"
    return t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 64).parquet(path)


def drain(stream: DataFrame, spark, name: str) -> DataFrame:
    """Run a stream over everything there is and return what it wrote."""
    out, state = scratch_path(spark, name), scratch_path(spark, name + "-state")
    running = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state)
        .trigger(availableNow=True).start(out)
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query("stream_items", """
SELECT event_id, CAST(0 AS INTEGER) AS item_index, event_type AS tag, value, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS time_text FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, 0, event_type, value, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') FROM events WHERE event_id % 2 = 1
UNION ALL SELECT event_id, 1, 'copy', value, NULL FROM events WHERE event_id % 2 = 1""")
def stream_items(t: Tables) -> DataFrame:
    """Messages with one or two items in either spelling, parsed from a stream."""
    def item(names: tuple[str, str, str], tag):
        return F.struct(tag.alias(names[0]), F.col("value").alias(names[1]), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(names[2]))

    upper, lower = ("Tag", "NumericValue", "TimeStamp"), ("tag", "numericValue", "timeStamp")
    copy = F.struct(F.lit("copy").alias("tag"), F.col("value").alias("numericValue"), F.lit(None).cast("string").alias("timeStamp"))
    one = F.to_json(F.struct(F.array(item(upper, F.col("event_type"))).alias("Items")))
    two = F.to_json(F.struct(F.array(item(lower, F.col("event_type")), copy).alias("Items")))
    message = F.when(F.col("event_id") % 2 == 0, one).otherwise(two)
    items = S.parse_items(event_stream(t).select("event_id", message.alias("message")), "message", ["event_id"])
    return drain(items, t.spark, "items")


def in_drops(t: Tables, drops: int) -> list[str]:
    """The events in folders, one per drop in time order, written in one pass. Each path names the folders up to one drop, so
    that a stream that goes on from a checkpoint finds one drop more; empty drops have none."""
    at = seconds_of("ts")
    span = t.events.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    if span["lo"] is None:
        return []
    share = F.coalesce(F.try_divide((at - span["lo"]) * drops, F.lit(float(span["hi"] - span["lo"]))), F.lit(0.0))
    drop = F.least(F.floor(share), F.lit(drops - 1)).cast("int")
    folder = scratch_path(t.spark, "events")
    t.events.withColumn("drop", F.coalesce(drop, F.lit(0))).write.partitionBy("drop").parquet(folder)
    found = t.spark.read.parquet(folder).select("drop").distinct().collect()  # at most ``drops`` numbers
    numbers = [str(i) for i in sorted(r["drop"] for r in found)]
    return [f"{folder}/drop={{{','.join(numbers[: i + 1])}}}" for i in range(len(numbers))]


def assembled_drops(t: Tables, drops: int) -> DataFrame:
    """Records assembled from micro-batches that split a hot device and hand on the open records.

    Assembly follows the order of arrival, as messages do, and a table's files are in no order of time. So the events
    arrive as ``drops`` drops in time order, each with as many files as it needs; no item is ever late. Each drop is a run of
    its own that goes on from the checkpoint of the one before.
    """
    out, state, log = (scratch_path(t.spark, n) for n in ("records", "open", "log"))
    folders = in_drops(t, drops)
    if not folders:
        return t.events.select("user_id", *[F.lit(0.0).alias(f) for f in S.FIELDS], F.lit("").alias("time")).limit(0)
    step = S.assemble_each_batch(out, state, "user_id", ORDER, seconds_of("ts"), "tag", "value", "time")
    for folder in folders:
        stream = t.spark.readStream.schema(t.events.schema).parquet(folder)
        running = (
            as_items(stream).writeStream.foreachBatch(step).option("checkpointLocation", log)
            .trigger(availableNow=True).start()
        )
        running.awaitTermination()
    return t.spark.read.parquet(out).drop("batch")


@query("stream_assemble", f"WITH {ASSEMBLE_SQL} SELECT user_id, sepal_length, sepal_width, petal_length, petal_width, time FROM complete")
def stream_assemble(t: Tables) -> DataFrame:
    """The same records as the batch twin, all events in one trigger."""
    return assembled_drops(t, 1)


@query("stream_assemble_batches", f"WITH {ASSEMBLE_SQL} SELECT user_id, sepal_length, sepal_width, petal_length, petal_width, time FROM complete")
def stream_assemble_batches(t: Tables) -> DataFrame:
    """The same records over four triggers."""
    return assembled_drops(t, 4)


WEIGHTS = {"sepal_length": 0.1, "sepal_width": -0.2, "petal_length": 0.3, "petal_width": 0.05}
SCORE_SQL = near_sql("0.5e0 + sepal_length * 0.1e0 + sepal_width * -0.2e0 + petal_length * 0.3e0 + petal_width * 0.05e0")


@query("stream_scored", f"""
WITH {ASSEMBLE_SQL} SELECT user_id, {SCORE_SQL} AS iris_type, replace(left(time, 26), 'T', ' ') AS posted_at, false AS dead_letter FROM complete""")
def stream_scored(t: Tables) -> DataFrame:
    """Assembled records with a score, as they would be posted."""
    scored = S.scored_records(assembled_drops(t, 2), near(linear_score(WEIGHTS, 0.5)))
    posted = F.date_format("posted_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("posted_at")
    return scored.select("user_id", "iris_type", posted, "dead_letter")


@query("stream_batch_metrics", """
SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(28,4))) AS DOUBLE) AS total FROM events GROUP BY 1""")
def stream_batch_metrics(t: Tables) -> DataFrame:
    """Totals written per micro-batch and added up."""
    out, state = scratch_path(t.spark, "batches"), scratch_path(t.spark, "batches-state")
    sums = {"n": F.count(F.lit(1)), "total": F.sum(F.col("value").cast("decimal(28,4)"))}
    running = (
        event_stream(t).writeStream.foreachBatch(S.append_metrics(out, ["event_type"], sums))
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    running.awaitTermination()
    done = t.spark.read.parquet(out)
    return done.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"))


@query("stream_quality", """
SELECT 'column_values_to_not_be_null' AS expectation, true AS success, CAST(count(*) AS DOUBLE) AS observed FROM events
UNION ALL SELECT 'column_values_to_be_between', max(value) <= 480 AND min(value) >= 0, CAST(count(*) AS DOUBLE) FROM events""")
def stream_quality(t: Tables) -> DataFrame:
    """A quality suite on every micro-batch; the results are kept beside the stream."""
    out, state = scratch_path(t.spark, "checks"), scratch_path(t.spark, "checks-state")
    suite = Suite("events.warning", "warning", (
        Expectation("column_values_to_not_be_null", {"column": "user_id"}),
        Expectation("column_values_to_be_between", {"column": "value", "min_value": 0, "max_value": 480}),
    ))

    def keep(results: DataFrame, batch_id: int) -> None:
        results.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    running = (
        event_stream(t).writeStream.foreachBatch(S.check_each_batch(suite, keep))
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return t.spark.read.parquet(out).groupBy("expectation").agg(F.min("success").alias("success"), F.sum("observed").alias("observed"))


@query("stream_keyed_state", f"""
WITH {ASSEMBLE_SQL}, e AS (SELECT user_id, record, list(event_id ORDER BY ts, event_id) AS events FROM k GROUP BY ALL),
r AS (SELECT user_id, record, max(strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')) FILTER (WHERE event_type = 'purchase') AS time FROM k GROUP BY ALL)
SELECT c.user_id, sepal_length, sepal_width, petal_length, petal_width, c.time, array_to_string(e.events, ',') AS events
FROM complete c JOIN r ON r.user_id = c.user_id AND r.time = c.time JOIN e ON e.user_id = r.user_id AND e.record = r.record""")
def stream_keyed_state(t: Tables) -> DataFrame:
    """Records and the events behind them from state per device, over four triggers with a restart before each."""
    out, log = scratch_path(t.spark, "keyed"), scratch_path(t.spark, "keyed-log")
    empty = t.events.select("user_id", *[F.lit(0.0).alias(f) for f in S.FIELDS], F.lit("").alias("time"), F.lit("").alias("events")).limit(0)
    with keyed_state(t.spark):
        for folder in in_drops(t, 4):
            items = as_items(t.spark.readStream.schema(t.events.schema).parquet(folder))
            records = assemble_keyed(items, "user_id", ORDER, "event_id", "ts", "tag", "value", "time")
            running = (
                records.writeStream.format("parquet").outputMode("append").option("checkpointLocation", log)
                .trigger(availableNow=True).start(out)
            )
            running.awaitTermination()
            empty = t.spark.read.schema(records.schema).parquet(out).withColumn("events", F.array_join("events", ","))
    return empty


_LINEAR = """
WITH r AS (SELECT event_type, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, CAST(hour(ts) AS DOUBLE) AS hour, value AS y FROM events WHERE user_id IS NOT NULL),
c AS (
  SELECT event_type, count(*) AS n, avg(k) AS mk, avg(hour) AS mh, avg(y) AS my, var_pop(k) AS kk, var_pop(hour) AS hh, covar_pop(k, hour) AS kh,
    covar_pop(k, y) AS ky, covar_pop(hour, y) AS hy, var_pop(y) AS yy FROM r WHERE k IS NOT NULL AND y IS NOT NULL GROUP BY 1
), w AS (SELECT *, (ky * hh - hy * kh) / (kk * hh - kh * kh) AS wk, (hy * kk - ky * kh) / (kk * hh - kh * kh) AS wh FROM c)"""


@query("stream_model_update", f"""{_LINEAR}
SELECT event_type, n, {near_sql("my - wk * mk - wh * mh", 4)} AS intercept, {near_sql("wk", 4)} AS k, {near_sql("wh", 4)} AS hour,
  {near_sql("sqrt(yy - 2 * (wk * ky + wh * hy) + wk * wk * kk + 2 * wk * wh * kh + wh * wh * hh)", 4)} AS rmse FROM w""")
def stream_model_update(t: Tables) -> DataFrame:
    """A linear model per event type, updated after each of five micro-batches; the weights after the last one."""
    sums, log = scratch_path(t.spark, "sums"), scratch_path(t.spark, "sums-log")
    features = ["k", "hour"]
    step = update_each_batch(sums, features, "value", ["event_type"])
    folders = in_drops(t, 5)
    for folder in folders:
        rows = t.spark.readStream.schema(t.events.schema).parquet(folder).where("user_id is not null")
        rows = rows.select("event_type", F.get_json_object("props", "$.k").try_cast("double").alias("k"), F.hour("ts").cast("double").alias("hour"), "value")
        running = rows.writeStream.foreachBatch(step).option("checkpointLocation", log).trigger(availableNow=True).start()
        running.awaitTermination()
    if not folders:
        step(t.events.select("event_type", F.lit(0.0).alias("k"), F.lit(0.0).alias("hour"), "value").limit(0), 0)
    model = model_after(t.spark, sums, features, ["event_type"])
    return model.select("event_type", "n", *[near(c, 4).alias(c) for c in ("intercept", *features, "rmse")])
