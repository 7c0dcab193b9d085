"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.llm import phrases

SCHEMA = "lang string, text string, doc_id long, prefix string, slot int, n int, phrase string, total long"
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for k in (1, 2, 3):
                counts["und" if lang is None else lang].update((k, *words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        f = {p[1:]: c for p, c in f.items()}
        n = sum(c for p, c in f.items() if len(p) == 1)
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(2 * c >= a and p in (q[:2], q[1:]) for q, c in f.items() if len(q) == 3 and c >= least):
                continue
            s, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            out.append((lang, -s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
    ranked, seen = [], Counter()
    for lang, s, a, p, left, right, n in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], p.decode(), -a, left, right, n, -s))
    return ranked


def texts(seed=1, count=80):
    rng = random.Random(seed)
    words = ["the", "of", "The", "É", "é", "na ive", "a", "b", "c", "café", "x\x1cy", "\U0001f600", "z", "￮"]
    out = [("en", None), ("en", ""), (None, "the of the"), ("und", "the of the of"), ("", "a b a b a b"), ("de", ". , ;\n"), ("en", "a\tb \t a\x0bb\ra.b.a")]
    for _ in range(count):
        n = rng.randrange(0, 40)
        out.append((rng.choice(["en", "en", "de", None]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n"]) for _ in range(n))))
    return out + [("en", "the of the of a " * 3000)]


def result(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "p", 2, 3, "x", 4) for r in rows], SCHEMA).repartition(4)
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


@pytest.mark.parametrize("options", [{"least": 3}, {"least": 3, "floor": 50}, {"least": 10, "top": 5}])
def test_collocations_are_brute_force(spark, options):
    rows = texts()
    want = brute(rows, options["least"], options.get("top", 2000))
    assert result(spark, rows, **options) == sorted(want) and len(want) > 5


def test_small_steps_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(phrases, "STEP", 7)
    monkeypatch.setattr(phrases, "ENTRIES", 40)
    rows = texts(3)
    assert result(spark, rows, least=3, floor=100) == sorted(brute(rows, 3))


def test_full_filter_lets_all_pass(spark, monkeypatch):
    monkeypatch.setattr(phrases.Filter, "has", lambda self, keys: np.ones(len(keys), bool))
    rows = texts(5, 30)
    assert result(spark, rows, least=3) == sorted(brute(rows, 3))


def test_empty_and_rare(spark):
    assert result(spark, []) == [] and result(spark, [("en", "a b c"), ("en", None)]) == []


def test_stripe_sums_are_prefix_counts(spark):
    rows = [("en", "a b a c. a"), ("en", "a b a b")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    first = {r["next"]: r["f"] for r in phrases.merge(phrases.stripes(docs, 1, [], {}), 1).selectExpr("inline(kept)").collect()}
    words = spark.createDataFrame([("en", w) for w in first], "lang string, phrase string")
    second = phrases.merge(phrases.stripes(docs, 2, [phrases.write_filter(words, ["phrase"])], {}), 1)
    assert first == {"a": 5, "b": 3, "c": 1} == {r["prefix"]: r["total"] for r in second.collect()}


def test_marked_words():
    assert phrases.marked_words(pa.array(["A.b", None, "É x"])).to_pylist() == ["a", ".", "b", ".", ".", "É", "x", "."]


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**12
    got = spark.createDataFrame([(big, big + 1, big + 7)], "a long, l long, r long").select(phrases.score("a", "l", "r").alias("s")).first()["s"]
    assert got == 10**6 * big * big // ((big + 1) * (big + 7))
