"""License scan against every block and every template in Python."""

import random
import re

import pytest

from lakeloom.llm import licenses

SCHEMA = "doc_id long, text string, words string, row int, step string, label string, tokens int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, threshold=0.85, templates=licenses.TEMPLATES):
    words = WORD.findall((text or "").translate(SMALL))
    places = [(i, label) for p, label in licenses.PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    labels, score = {label for _, label in places}, 0.0
    base = ",".join(sorted(labels))
    for label, notice in templates:
        own = licenses.plain_words(notice)
        step = 8
        while step < len(own):
            step *= 2
        for start in range(0, max(1, len(words)), step):
            share = len(set(words[start : start + 2 * step]) & set(own)) / len(set(own))
            if share >= threshold:
                labels, score = labels | {label}, max(score, share)
    found = sorted(i for i, _ in places)
    return (len(words), len(found), found[0] if found else None, found[-1] if found else None, base, ",".join(sorted(labels)), score)


def texts():
    rng = random.Random(4)
    filler = "the of and in to software license under any copy without public apache mit cc by free".split()
    out = [None, "", " \n\t", "CC BY cc by cc-BY", "the MIT\n License, mit license", "GNU General Public License v3 gnu general public", "licensed under CC BY-NC 4.0.",
           "MİT license K mıt license mit licenſe", "Été café ApacheÉ license apache license"]
    for i in range(60):
        words = [rng.choice(filler) if rng.random() < 0.5 else f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 120))]
        for _, notice in rng.sample(licenses.TEMPLATES, 2):
            own = notice.split()
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(len(own))] = "other"
            at = rng.randrange(len(words) + 1)
            words[at:at] = own
        out.append(rng.choice([" ", "\n", ", "]).join(words).upper() if i % 3 else " ".join(words))
    return out + [" ".join(f"w{i}" for i in range(30_000)) + " Released under the MIT License. " + "x " * 20_000]


def result(spark, rows):
    df = spark.createDataFrame([(i, t, "own", 1, "s", "l", 2) for i, t in rows], SCHEMA).repartition(3)
    return sorted(map(str, (tuple(r) for r in licenses.scan(df).collect())))


def test_scan_is_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, "cc by"), (3, "cc by"), (None, "mit license"), (None, None)]
    assert result(spark, rows) == sorted(str((i, *brute(t))) for i, t in rows)


def test_third_of_rows_alike(spark):
    rows = [(7, "released under the mit license")] * 200 + [(i, "plain text") for i in range(400)]
    got = result(spark, rows)
    assert got == sorted(str((i, *brute(t))) for i, t in rows) and sum("'mit'" in r for r in got) == 200


def test_empty_table(spark):
    assert result(spark, []) == []


def test_ranks_count_all_documents(spark):
    df = spark.createDataFrame([("a b",), ("a",), ("c a",)], "w string").selectExpr("split(w, ' ') as words")
    assert licenses.token_ranks(df, ["a", "b", "c", "d"]) == {"d": 0, "b": 1, "c": 2, "a": 3}


def test_template_bounds(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        licenses.scan(docs, templates=[("x", " ".join(f"w{i}" for i in range(5_001)))])
    with pytest.raises(ValueError):
        licenses.scan(docs, templates=[("x", "...")])
