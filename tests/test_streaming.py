import json

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.quality import Expectation, Suite
from lakeloom.session import scratch_path
from lakeloom.streaming import messages as S

PL, PW, SL, SW = "Iris.PetalLength", "Iris.PetalWidth", "Iris.SepalLength", "Iris.SepalWidth"


def message(n, lower=False):
    """A message as the sensor sends it: the closing petal width comes before the sepal values."""
    names = ("tag", "numericValue", "timeStamp") if lower else ("Tag", "NumericValue", "TimeStamp")
    at = f"2024-01-01T00:00:{n:02d}Z"
    return json.dumps({"Items": [dict(zip(names, (t, v + n, at))) for t, v in ((PL, 10.0), (PW, 20.0), ("Other", 1.0), (SL, 30.0), (SW, 40.0))]})


def write(spark, path, numbers, lower=False):
    rows = [(n, f"2024-01-01 00:00:{n:02d}", message(n, lower)) for n in numbers]
    df = spark.createDataFrame(rows, "n int, at string, body string").withColumn("at", F.col("at").cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(path)


def items_of(df):
    return S.parse_items(df.withColumn("device", F.lit("d")), "body", ["device", "n", "at"])


def run(stream, out, log):
    q = stream.writeStream.format("parquet").option("checkpointLocation", log).trigger(availableNow=True).start(out)
    q.awaitTermination()


# the first record has no sepal values and is dropped; each later one mixes in those of the message before
WANT = [(30.0 + n - 1, 40.0 + n - 1, 10.0 + n, 20.0 + n) for n in (2, 3, 4)]


def values(df):
    return sorted(tuple(r) for r in df.select(*S.FIELDS).collect())


def test_items_in_both_spellings(make):
    for lower in (False, True):
        rows = items_of(make("n int, at timestamp, body string", (1, None, message(1, lower)))).collect()
        assert [r["tag"] for r in rows] == [PL, PW, "Other", SL, SW]
        assert rows[1]["value"] == 21.0 and rows[1]["time_text"] == "2024-01-01T00:00:01Z"


def test_batch_assembly(spark, tmp_path):
    write(spark, str(tmp_path / "in"), [1, 2, 3, 4])
    items = items_of(spark.read.parquet(str(tmp_path / "in")))
    out = S.assemble_batch(items, "device", ["n", "item_index"], F.col("n"), "tag", "value", "time_text")
    assert values(out) == WANT


def test_stream_state_survives_restarts(spark, tmp_path):
    src, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    for part in ([1], [2, 3], [4]):
        write(spark, src, part, lower=part == [4])
        stream = spark.readStream.schema("n int, at timestamp, body string").parquet(src)
        run(S.assemble_stream(items_of(stream), "device", ["n", "item_index"], "at", "tag", "value", "time_text"), out, log)
    df = spark.read.parquet(out)
    assert values(df) == WANT
    assert sorted(r["time"] for r in df.collect())[0] == "2024-01-01T00:00:02Z"


def test_close_when_all_present(spark, tmp_path):
    src = str(tmp_path / "in")
    write(spark, src, [1, 2])
    stream = spark.readStream.schema("n int, at timestamp, body string").parquet(src)
    out = S.assemble_stream(items_of(stream), "device", ["n", "item_index"], "at", "tag", "value", "time_text", close_on="all_present")
    run(out, str(tmp_path / "out"), str(tmp_path / "log"))
    assert values(spark.read.parquet(str(tmp_path / "out"))) == [(30.0 + n, 40.0 + n, 10.0 + n, 20.0 + n) for n in (1, 2)]
    with pytest.raises(ValueError):
        S.assemble_stream(items_of(stream), "device", ["n"], "at", "tag", "value", "time_text", close_on="never")


def test_micro_batches_hand_on_open_records(spark):
    src, out, state, log = (scratch_path(spark, n) for n in ("mb-in", "mb-out", "mb-state", "mb-log"))
    step = S.assemble_each_batch(out, state, "device", ["n", "item_index"], F.col("n"), "tag", "value", "time_text", rows_per_cut=3)
    for part in ([1], [2, 3], [4]):
        write(spark, src, part)
        stream = items_of(spark.readStream.schema("n int, at timestamp, body string").parquet(src))
        q = stream.writeStream.foreachBatch(step).option("checkpointLocation", log).trigger(availableNow=True).start()
        q.awaitTermination()
    assert values(spark.read.parquet(out)) == WANT


def test_silent_devices_lose_their_open_record(spark, make):
    out, state = scratch_path(spark, "idle-out"), scratch_path(spark, "idle-state")
    step = S.assemble_each_batch(out, state, "d", ["i"], F.col("i"), "tag", "v", "at", idle=10)
    schema = "d string, i int, tag string, v double, at string"
    step(make(schema, ("old", 1, SL, 1.0, "t"), ("new", 5, SL, 2.0, "t")), 0)
    step(make(schema, ("new", 14, SW, 3.0, "t")), 1)
    assert [tuple(r) for r in spark.read.parquet(f"{state}/batch=1").select("d", *S.FIELDS).collect()] == [("new", 2.0, 3.0, None, None)]
    step(make(schema, ("new", 15, PL, 4.0, "t"), ("new", 16, PW, 5.0, "end"), ("old", 17, PW, 5.0, "t")), 2)
    assert [tuple(r) for r in spark.read.parquet(f"{out}/batch=2").collect()] == [("new", 2.0, 3.0, 4.0, 5.0, "end")]
    # a repeated batch writes the same again
    step(make(schema, ("new", 15, PL, 4.0, "t"), ("new", 16, PW, 5.0, "end"), ("old", 17, PW, 5.0, "t")), 2)
    assert spark.read.parquet(f"{out}/batch=2").count() == 1


def test_bad_time_is_a_dead_letter(make):
    df = make("sepal_length double, time string", (1.0, "2024-01-01T00:00:01Z"), (2.0, "yesterday"))
    rows = S.scored_records(df, F.col("sepal_length") * 2).collect()
    assert [(r["iris_type"], r["dead_letter"]) for r in rows] == [(2.0, False), (4.0, True)]


def test_quality_per_batch(spark, tmp_path):
    src, log = str(tmp_path / "in"), str(tmp_path / "log")
    write(spark, src, [1, 2, 3])
    seen = []
    suite = Suite("s", "warning", (Expectation("column_max_to_be_between", {"column": "n", "max_value": 2}),))
    q = (
        spark.readStream.schema("n int, at timestamp, body string").parquet(src).writeStream
        .foreachBatch(S.check_each_batch(suite, lambda df, i: seen.extend(df.collect())))
        .option("checkpointLocation", log).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    assert [(r["success"], r["observed"], r["batch_id"]) for r in seen] == [(False, 3.0, 0)]


def test_queries_over_a_folder_in_no_order_of_time(spark, tmp_path):
    import os

    import __spark_entry__ as entry
    from tests.oracle import connect, compare

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    for name in os.listdir(folder):
        if name != "events.parquet":
            os.symlink(f"{folder}/{name}", tmp_path / name)
    events = spark.read.parquet(f"{folder}/events.parquet")
    events.repartition(150, "event_id").write.parquet(str(tmp_path / "events.parquet"))
    duck = connect(folder)
    for name in ("stream_items", "stream_assemble", "stream_assemble_batches", "stream_scored", "stream_batch_metrics", "stream_quality"):
        assert compare(duck, entry.oracle_sql()[name], entry.queries()[name](spark, str(tmp_path))) == "", name
