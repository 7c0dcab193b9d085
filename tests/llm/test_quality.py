"""Importance resampling: models, bounds and top-k against brute force, and held-out accuracy."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.llm import quality

DOCS = "doc_id long, text string, source string, log_weight int, sort_key string"


def corpus(n=1_500, seed=0):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ("n", "r", "st", "")]
    docs, labels = [], []
    for i in range(n):
        kind = "good" if rng.random() < 0.75 else rng.choice(["loud", "stuck", "rude"])
        text = [rng.choice(words) for _ in range(rng.choice([5, 30, 80, 600]))]
        if kind == "loud":
            text = [w.upper() + "!!" for w in text]
        if kind == "stuck":
            text = [text[0]] * 12 + text[:6] + [text[-1]] * 9
        if kind == "rude":
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["grobian", "lump,", "Schuft"]))
        docs.append((i, " ".join(text), "s", 0, kind))
        if rng.random() < 0.4:
            labels.append((i, int(kind in ("good", "rude")), int(kind == "rude")))
    return docs, labels


def test_held_out_documents(spark):
    docs, labels = corpus()
    known = {r[0] for r in labels}
    frame = spark.createDataFrame(docs, DOCS)
    kept, weights = quality.resample(frame.repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), bits=16)
    assert kept.schema == frame.schema
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {r["doc_id"] for r in weights.collect()}
    fresh = [r for r in docs if r[0] not in known]
    good, bad = [r for r in fresh if r[4] == "good"], [r for r in fresh if r[4] != "good"]
    assert sum(r[0] in ids for r in good) >= 0.99 * len(good)
    assert sum(r[0] in ids for r in bad) <= 0.1 * len(bad)


def test_counts_cover_every_document(spark):
    docs, labels = corpus(200, 3)
    ids, good = quality.labelled_sample(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), 50)
    assert len(ids) == min(50, len(labels)) and sorted(ids.tolist()) == ids.tolist()
    got = quality._counts(spark.createDataFrame(docs, DOCS), ids, good, 16)
    want = {p: np.zeros(2 << 16, np.int64) for p in quality.PARTS}
    label = dict(zip(ids.tolist(), good.tolist(), strict=True))
    for i, text, *_ in docs:
        at, _ = quality.grams(pa.array([text]), 16)
        for p in quality.PARTS[: 1 + (i in label)] if label.get(i, 1) else ("raw", "rejected"):
            np.add.at(want[p], at.ravel(), 1)
    assert all((got[p] == want[p]).all() for p in quality.PARTS)


def test_unlabelled_copies_stay(spark):
    docs, labels = corpus(800, 5)
    copies = [(10_000 + i, "zimt zucker zahl zeit zelt ziel zoll zwei zwar zeug", "s", 0, "good") for i in range(400)]
    kept, _ = quality.resample(spark.createDataFrame(docs + copies, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), bits=16)
    assert kept.where("doc_id >= 10000").count() == 400


@pytest.mark.parametrize("k", [0, 1, 7, 500, 999, 1_000, 2_000])
def test_kth_largest(spark, k):
    rng = np.random.default_rng(k)
    values = np.round(rng.normal(size=1_000) * 3, 1) if k % 2 else rng.normal(size=1_000) * 10.0 ** rng.integers(-8, 8, 1_000)
    got = quality.kth_largest(spark.createDataFrame([(float(v),) for v in values], "v double"), "v", k, bins=16, small=5)
    want = float("inf") if k < 1 else float("-inf") if k > 1_000 else sorted(values.tolist(), reverse=True)[k - 1]
    assert got == want


def test_best_bound_makes_the_fewest_mistakes():
    rng = np.random.default_rng(0)
    for _ in range(50):
        w, good = rng.integers(-5, 3, 30).astype(float), rng.integers(0, 2, 30)
        bound = quality.best_bound(w, good)
        mistakes = lambda b, w=w, good=good: int(((w > b) != (good == 1)).sum())
        assert mistakes(bound) == min(mistakes(b) for b in [-np.inf, np.inf, *(w + 0.5), *(w - 0.5)])


def test_odd_rows(spark):
    docs = [(1, None, "s", 0, ""), (2, "", "s", 0, ""), (None, "text", "s", 0, ""), (3, "x " * 50_000, "s", 0, ""), (3, "x " * 50_000, "s", 0, "")]
    labels = spark.createDataFrame([(1, 1, None), (2, None, 0), (None, 0, 0), (3, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(docs, DOCS)
    kept, weights = quality.resample(frame, labels, bits=12)
    assert weights.count() == kept.count() <= 5
    assert quality.resample(frame, labels.limit(0), bits=12)[0].count() == 5
    assert quality.resample(frame.limit(0), labels, bits=12)[0].collect() == []


def test_gumbel_noise():
    g = quality.gumbel(np.arange(200_000))
    assert abs(g.mean() - 0.5772) < 0.02 and abs(g.var() - np.pi**2 / 6) < 0.03 and np.isfinite(g).all()


@pytest.mark.parametrize("seed", range(4))
def test_bound_of_rows_in_ranges(spark, seed):
    rng = np.random.default_rng(seed)
    good = rng.integers(0, 2, 120) if seed else np.ones(120, np.int64)
    w = np.round(rng.normal(good * [0, 1, -3, 0.1][seed], 1), 1)
    rows = spark.createDataFrame([(float(x), int(g), int(1 - g)) for x, g in zip(w, good, strict=True)], "w double, good long, other long").repartition(5)
    assert [quality.bound_of_rows(rows, most) for most in (7, 1_000)] == [quality.best_bound(w, good)] * 2


def test_rows_of_a_repeated_id_all_count(spark):
    docs, labels = corpus(300, 7)
    known = {r[0]: r[1] and not r[2] for r in labels}
    one = next(r for r in docs if known.get(r[0]))
    docs = [one] * 5_000 + [r for r in docs if r is not one]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(docs, DOCS).coalesce(1)
    model = quality.fit(frame, labels, most_labels=1_000, bits=16)
    weights = {r["doc_id"]: r["log_weight"] for r in quality.weigh(frame, model, 0).collect()}
    rows = [(weights[r[0]], int(known[r[0]])) for r in docs if r[0] in known]
    assert model.bound == quality.best_bound(*(np.array(x) for x in zip(*rows, strict=True))) > float("-inf")
