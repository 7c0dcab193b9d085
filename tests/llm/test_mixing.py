"""Mixture against plain arithmetic."""

import random

from pyspark.sql import functions as F

from lakeloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, target string, part int"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        weight = sum(w[s] for s in names if s not in full) or 1
        new = {s for s in names if s not in full and rest * w[s] / weight > most * sizes[s]}
        if not new:
            return {s: float(most * sizes[s]) if s in full else rest * w[s] / weight for s in names}
        full |= new


def test_targets_fill_up(spark):
    rng = random.Random(4)
    for trial in range(6):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 80, 1000, 5000]) for i in range(rng.randint(1, 9))}
        if trial % 2:
            sizes[None] = 40
        sized = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes.items())], "doc_id long, source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(sized).collect()}
        for s, t in plain_targets(sizes).items():
            assert abs(got[s] - t) <= 1e-9 * max(t, 1), (sizes, s)


def test_mixture(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 400))), f"s{i % 5 if i % 3 else 0}", 1, "x", 2) for i in range(600)]
    rows += [(1_000, None, "s1", 0, "", 0), (1_001, "", None, 0, "", 0), (1_002, "a\tb\u00a0c\x0bd", None, 0, "", 0), (None, "a b", "s2", 0, "", 0)] + [(1_003, "same words twice", "s4", 0, "", 0)] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    mixture, taken = mixing.mix(mixing.sized(docs), block=8)
    got = taken.collect()
    assert sorted((r["doc_id"] or -1) for r in got) == sorted((r[0] or -1) for r in rows)
    assert {r["doc_id"]: r["size"] for r in got}[1_002] == 3 and {r["doc_id"]: r["size"] for r in got}[1_000] == 0
    sizes, takes, targets = {}, {}, {}
    source = {r[0]: r[2] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        assert r["taken"] <= 3 * r["size"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        takes[s] = takes.get(s, 0) + r["taken"]
        targets[s] = (r["target"], r["source_size"])
    for s, want in plain_targets(sizes).items():
        assert abs(targets[s][0] - want) < 1e-6 and targets[s][1] == sizes[s]
        assert abs(takes[s] - want) <= 4 * 8
    given = {r["doc_id"]: r["n"] for r in mixture.groupBy("doc_id").agg(F.sum("words").alias("n")).collect()}
    total = {}
    for r in got:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["taken"]
    assert {k: v for k, v in total.items() if v} == given
    again = mixing.mix(mixing.sized(docs.repartition(7)), block=8)[1]
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_slots_are_spread(spark):
    targets = spark.createDataFrame([("a", 0, 10, 700.0), ("b", 1, 10, 200.0), ("c", 2, 10, 100.0), ("d", 3, 0, 0.0)], "source string, part int, source_size long, target double")
    slots = mixing.schedule(targets, 100_000, 10).toPandas().sort_values("slot")
    assert len(slots) == 10_000 and set(slots.part) == {0, 1, 2}
    for part, share in ((0, 0.7), (1, 0.2), (2, 0.1)):
        own = slots[slots.part == part]
        assert own["rank"].tolist() == list(range(len(own)))
        for a in range(0, 10_000, 500):
            assert abs(((own.slot >= a) & (own.slot < a + 500)).sum() - 500 * share) <= 4


def test_empty(spark):
    mixture, taken = mixing.mix(mixing.sized(spark.createDataFrame([], SCHEMA)))
    assert mixture.collect() == [] and taken.collect() == []
    only = mixing.mix(mixing.sized(spark.createDataFrame([(1, None, None, 0, "", 0)], SCHEMA)))[1].collect()
    assert [(r["doc_id"], r["size"], r["target"], r["taken"]) for r in only] == [(1, 0, 0.0, 0)]


def test_hot_ids_spread(spark):
    """A third of all rows have one id, another third none: no bucket holds more than a few of them, in every rerun alike."""
    rows = [(7, "s0", 5)] * 4_000 + [(None, "s0", 5)] * 4_000 + [(100 + i, "s0", 3 + i % 5) for i in range(4_000)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    numbers = mixing.numbered(sized, copies=300).toPandas()
    assert len(numbers) == len(rows)
    for hot in (numbers[numbers.doc_id == 7], numbers[numbers.doc_id.isna()]):
        assert sorted(hot["_copy_no"]) == list(range(1, 4_001))
    targets = mixing.source_targets(sized)
    pieces = mixing.shuffled_blocks(sized, targets, 32, 3, "mix")
    buckets = pieces.select("_bucket", "_row").distinct().groupBy("_bucket").count().toPandas()["count"]
    assert buckets.sum() == len(rows) and buckets.max() <= 20
    first, again = (sorted(map(str, mixing.mix(frame)[1].collect())) for frame in (sized, sized.repartition(5)))
    assert first == again and len(first) == len(rows)
