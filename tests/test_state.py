"""Keyed state over restarts and timers; models from added sums."""

import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.streaming import learning
from lakeloom.streaming.messages import FIELDS, TAGS, assemble_batch
from lakeloom.streaming.state import assemble_keyed, keyed_state

SCHEMA = "dev string, at timestamp, id long, tag string, value double, time string"


def feed(spark, folder, rows):
    df = spark.createDataFrame([(d, i, t, v) for d, i, t, v in rows], "dev string, id long, tag string, value double")
    df = df.select("dev", F.timestamp_seconds("id").alias("at"), "id", "tag", "value", F.col("id").cast("string").alias("time"))
    df.repartition(2).write.mode("append").parquet(folder)


def run(spark, tmp_path, **options):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    with keyed_state(spark):
        out = assemble_keyed(stream, "dev", ["at", "id"], "id", "at", "tag", "value", "time", **options)
        q = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination()
    return sorted(tuple(r) for r in spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect())


def test_keyed_state_over_restarts(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "a", "b"]), i, rng.choice([*TAGS[:-1] * 3, TAGS[-1], "other"]), rng.choice([0.0, 1.0, 2.5, 3.5, 4.5, 1.5, None])) for i in range(600)]
    rows = [(d, i, t, v if v is not None or t == "other" else 0.0) for d, i, t, v in rows]
    for part in (rows[:150], rows[150:180], rows[180:]):
        feed(spark, str(tmp_path / "in"), part)
        got = run(spark, tmp_path)
    items = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))
    want = assemble_batch(items, "dev", ["at", "id"], F.col("id"), "tag", "value", "time").select("dev", *FIELDS, "time")
    assert [r[:6] for r in got] == sorted(tuple(r) for r in want.collect()) and len(got) > 5
    known = {d: [i for e, i, t, _ in rows if e == d and t in TAGS] for d in ("hot", "a", "b")}
    ends = {d: [i for e, i, t, _ in rows if e == d and t == TAGS[-1]] for d in known}
    for d, *_, time, events in got:
        before = max([e for e in ends[d] if e < int(time)], default=-1)
        assert events == [i for i in known[d] if before < i <= int(time)]


def test_silent_device_loses_its_open_record(spark, tmp_path):
    first, rest = [(t, 1.0) for t in TAGS[:-1]], [(TAGS[-1], 2.0)]
    feed(spark, str(tmp_path / "in"), [("quiet", 10 + i, t, v) for i, (t, v) in enumerate(first)] + [("busy", 10 + i, t, v) for i, (t, v) in enumerate(first)])
    options = {"idle": timedelta(seconds=100), "watermark": "1 second"}
    assert run(spark, tmp_path, **options) == []
    for at in (60, 120, 180, 240):
        feed(spark, str(tmp_path / "in"), [("busy", at, "other", 1.0), ("busy", at + 1, TAGS[0], 1.0)])
        run(spark, tmp_path, **options)
    feed(spark, str(tmp_path / "in"), [("quiet", 300, *rest[0]), ("busy", 300, *rest[0])])
    got = run(spark, tmp_path, **options)
    assert [r[0] for r in got] == ["busy"]


def batches(rows, count):
    return [rows[i::count] for i in range(count)]


def test_model_equals_least_squares_and_replays(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2)) + 1_000
    y = 3 + x @ [0.5, -2.0] + rng.normal(size=200)
    rows = [("a" if i % 3 else None, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y, strict=True))]
    odd = [("a", None, 1.0, 1.0), ("a", 1.0, float("nan"), 1.0), ("a", 1.0, 1.0, None), ("flat", 2.0, 2.0, 1.0), ("flat", 2.0, 3.0, 2.0)]
    path, step = str(tmp_path / "sums"), learning.update_each_batch(str(tmp_path / "sums"), ["u", "v"], "y", ["k"])
    for i, part in enumerate(batches(rows + odd, 4)):
        df = spark.createDataFrame(part, "k string, u double, v double, y double")
        step(df, i)
        step(df, i)
    got = {r["k"]: r for r in learning.model_after(spark, path, ["u", "v"], ["k"]).collect()}
    for k in ("a", None):
        own = np.array([r[1:] for r in rows if r[0] == k])
        want = np.linalg.lstsq(np.column_stack([np.ones(len(own)), own[:, :2]]), own[:, 2], rcond=None)[0]
        assert [got[k]["intercept"], got[k]["u"], got[k]["v"]] == pytest.approx(list(want), rel=1e-6) and got[k]["n"] == len(own)
        left = own[:, 2] - np.column_stack([np.ones(len(own)), own[:, :2]]) @ want
        assert got[k]["rmse"] == pytest.approx(np.sqrt((left**2).mean()), rel=1e-5)
    assert got["flat"]["u"] is None and got["flat"]["n"] == 2
    early = learning.model_after(spark, path, ["u", "v"], ["k"], last=1).where("k = 'a'").first()
    assert early["n"] == sum(r[0] == "a" for part in batches(rows + odd, 4)[:2] for r in part if None not in r[1:] and not any(v != v for v in r[1:]))
    model = learning.model_after(spark, path, ["u", "v"], ["k"])
    scored = learning.predicted(spark.createDataFrame([(None, 1.0, 2.0), ("new", 1.0, 2.0)], "k string, u double, v double"), model, ["u", "v"], ["k"]).collect()
    by = {r["k"]: r["prediction"] for r in scored}
    assert by["new"] is None and by[None] == pytest.approx(got[None]["intercept"] + got[None]["u"] + 2 * got[None]["v"])


def test_model_without_keys_or_rows(spark, tmp_path):
    path = str(tmp_path / "sums")
    step = learning.update_each_batch(path, ["u"], "y")
    empty = spark.createDataFrame([], "u double, y double")
    step(empty, 0)
    assert learning.model_after(spark, path, ["u"]).collect() == []
    step(spark.createDataFrame([(1.0, 2.0), (2.0, 4.0)], "u double, y double"), 1)
    row = learning.model_after(spark, path, ["u"]).first()
    assert (row["n"], row["u"], row["intercept"]) == (2, pytest.approx(2), pytest.approx(0))
    assert learning.predicted(empty.unionByName(spark.createDataFrame([(5.0, 0.0)], "u double, y double")), learning.model_after(spark, path, ["u"]), ["u"]).first()["prediction"] == pytest.approx(10)
