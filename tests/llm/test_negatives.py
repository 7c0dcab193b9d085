"""Hard negatives against brute force."""

import numpy as np
import pytest

from lakeloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, anchor_id int, falling string, kind int, vector string, tops int"


def brute(rows, every=100):
    good = []
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            good.append((i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * x)) for x in v]))
    widths = [len(v) for *_, v in good]
    good = [g for g in good if len(g[2]) == max(set(widths), key=lambda w: (widths.count(w), w))]
    out = []
    for a in sorted({g[0] for g in good if g[0] % every == 0}):
        _, label, x = min((g for g in good if g[0] == a), key=lambda g: (g[1], g[2]))
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i, lab) for i, lab, y in good if i != a)
        for s, i, _ in [z for z in scored if z[2] == label][:5]:
            fit = [(-t, j) for t, j, lab in scored if lab != label and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(a, i, r, j, -s, t) for r, (t, j) in enumerate(fit, 1)]
    return sorted(out)


def rows_of(n, width=6, seed=2):
    rng = np.random.default_rng(seed)
    x = np.abs(rng.normal(size=(n, width)))
    x[n // 2 : n // 2 + n // 3] = x[0]
    x[1], x[2] = 0.0, -x[2]
    labels = rng.integers(0, 4, n)
    return [(i, [float(v) for v in row], int(label)) for i, row, label in zip(range(n), x, labels, strict=True)]


ODD = [(None, [1.0] * 6, 1), (200_000, None, 1), (200_100, [1.0] * 6, None), (200_200, [float("nan")] * 6, 1), (200_300, [1.0, None] * 3, 1), (200_400, [float("inf")] * 6, 1), (200_500, [], 1), (200_600, [1.0], 1)]


def result(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "f", 2, "v", 3) for r in rows], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, **options).collect())


@pytest.mark.parametrize("slab", [1 << 14, 40])
def test_negatives_are_brute_force(spark, slab):
    rows = rows_of(420) + ODD
    got = result(spark, rows, slab=slab)
    assert got == brute(rows) and len(got) > 100


def test_zero_scores_and_ties(spark):
    rows = [(100, [1.0, 0.0], 1), (900, [0.0, 1.0], 1), (901, [0.0, 2.0], 1)] + [(i, [0.0, 1.0], 2) for i in range(1, 31) if i % 7]
    got = result(spark, rows)
    assert got == brute(rows) and [r[3] for r in got if r[1] == 900] == [i for i in range(1, 12) if i % 7][:10]


def test_repeated_rows(spark):
    rows = rows_of(120) + [(50, [0.4] * 6, 3)] * 60 + [(100, [0.3] * 6, 1)] * 40
    assert result(spark, rows) == brute(rows)


def test_few_rows(spark):
    assert result(spark, []) == [] and result(spark, ODD[:3]) == []
    assert result(spark, [(100, [1.0], 1)]) == [] and result(spark, [(100, [1.0], 1), (101, [1.0], 1)]) == []


def test_large_scores(spark):
    rows = [(100, [2.0**22, 3.0], 1), (101, [2.0**22, 0.5], 1), (102, [2.0**21, 1.25], 2), (103, [2.0**21, 1.5], 2)]
    assert result(spark, rows) == brute(rows) != []
    with pytest.raises(Exception, match="fit a long"):
        result(spark, [(100, [2.0**40], 1), (101, [2.0**40], 1)])


def test_bounds_are_integers():
    for s in (-7, 0, 1, 33, 10**19):
        a, b = negatives.bounds_of(s, 30, 90)
        assert 30 * s <= 100 * a < 30 * s + 100 and 90 * s - 100 < 100 * b <= 90 * s
