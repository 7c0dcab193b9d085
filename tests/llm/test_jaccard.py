"""Jaccard join against brute force, with every kind of region."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.llm import jaccard
from lakeloom.llm.components import stars

SCHEMA = "doc_id long, text string, n string, key int, region string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """(doc_id, set size, component) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return sorted(((i, len(x), None if i is None else find(i)) for i, x in sets), key=str)


def corpus(seed=0, clusters=12, members=9):
    """Groups of near copies at all distances around the bound, passages shared by many, and odd rows."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for c in range(clusters):
        base = [rng.choice(words) for _ in range(rng.choice([4, 5, 6, 12, 40, 90, 200]))]
        for m in range(rng.randint(1, members)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 40))):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.4:
                text = text[rng.randint(0, len(text) // 6) :]
            if rng.random() < 0.3:
                text = text + passage
            rows.append((len(rows), " ".join(w.upper() if rng.random() < 0.02 else w for w in text), "", 0, ""))
    rng.shuffle(rows)
    rows += [(9_000, None, "", 0, ""), (9_001, "", "", 0, ""), (9_002, " \t ", "", 0, ""), (9_003, "one", "", 0, ""), (9_004, "ONE", "", 0, ""), (9_005, "É é", "", 0, ""), (9_006, "é é", "", 0, "")]
    return rows


def result(spark, rows, **options):
    found = jaccard.jaccard_components(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str)


@pytest.mark.parametrize("seed", [0, 1])
def test_components_are_brute_force(spark, seed):
    rows = corpus(seed)
    assert result(spark, rows, bucket=2_000) == brute(rows)


@pytest.mark.parametrize("bound", [300, 2_000])
def test_large_regions_are_cut(spark, bound):
    rows = corpus(3)
    assert result(spark, rows, bound=bound) == brute(rows)


def test_order_of_shingles_changes_nothing(spark):
    rows = corpus(5)
    assert result(spark, rows, sample=1) == result(spark, rows) == brute(rows)


def test_repeated_rows_ids_and_nulls(spark):
    rows = [(5, "a b c d e f g h", "", 0, ""), (5, "a b c d e f g h", "", 0, ""), (2, "a b c d e f g h", "", 0, ""), (None, "a b c d e f g h", "", 0, ""), (None, None, "", 0, ""), (7, "x y", "", 0, ""), (8, "x  y ", "", 0, "")]
    assert result(spark, rows) == brute(rows)
    both = [(1, "a b c d e f g h", "", 0, ""), (1, "other words of the same id here", "", 0, ""), (3, "other words of the same id here", "", 0, "")]
    assert {(i, c) for i, _, c in result(spark, both)} == {(1, 1), (3, 1)}
    assert result(spark, []) == []


def test_hot_group(spark):
    base = [f"t{i}" for i in range(300)]
    rng = random.Random(2)
    rows = []
    for i in range(240):
        text = list(base)
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text if i % 2 else base), "", 0, ""))
    assert result(spark, rows, bound=20_000) == brute(rows)


@pytest.mark.parametrize("leaf", [1, 5, 50])
def test_local_regions(leaf):
    rows = [r for r in corpus(leaf, 20, 12) if shingles(r[1])]
    region = jaccard.Region([s for s in jaccard.shingle_sets(pa.array([r[1] for r in rows]))], leaf=leaf, pivots=4)
    region.join()
    got = region.roots()
    want = {i: c for i, _, c in brute(rows)}
    groups = {}
    for (i, *_), root in zip(rows, got.tolist(), strict=True):
        groups.setdefault(root, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(i for i in want if want[i] == c) for c in set(want.values()))


def test_every_linked_pair_meets_in_a_region():
    rng = np.random.default_rng(1)
    sets = [set(rng.choice(30, rng.integers(3, 20), replace=False).tolist()) for _ in range(120)]
    pivots = sets[:6]
    d = np.array([[1 - len(s & p) / len(s | p) for p in pivots] for s in sets])
    cells = [set(c.tolist()) for c in jaccard.voronoi(d, 0.25)]
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 1 - len(x & y) / len(x | y) <= 0.25:
                assert any(i in c and j in c for c in cells)


def test_prefixes_of_linked_sets_meet():
    rng = random.Random(0)
    for _ in range(2_000):
        n = rng.randint(1, 40)
        x = rng.sample(range(60), n)
        y = set(x[: rng.randint(max(1, n * 3 // 4), n)]) | set(rng.sample(range(60), rng.randint(0, 4)))
        x = set(x)
        if jaccard.linked(len(x & y), len(x), len(y), 75):
            a, b = (set(sorted(s)[: jaccard.prefix_size(len(s), 75)]) for s in (x, y))
            assert a & b


def test_stars(spark):
    rng = random.Random(7)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1_000 + i, 1_001 + i) for i in range(60)] + [(5, 5), (None, 4)]
    got = {r["hi"]: r["lo"] for r in stars(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        if a is not None:
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    assert got == {i: find(i) for i in parent if find(i) != i}
    assert stars(spark.createDataFrame([], "a long, b long")).collect() == []


def test_copies_do_not_look_shared(spark, monkeypatch):
    """Texts that are repeated under other ids are one class each: only sets that share shingles with another class are compared."""
    rng, compared, real = random.Random(5), [], jaccard.common_shingles
    monkeypatch.setattr(jaccard, "common_shingles", lambda rows, *a, **b: compared.append(rows.count()) or real(rows, *a, **b))
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 30, 80]))) for _ in range(120)]
    texts.append(texts[0] + " one more")
    rows = [(i + 1_000 * k, t, "", 0, "") for k in range(5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs).collect()), key=str)
    assert found == brute(rows) and compared[0] < len(texts) / 4


def test_blocks_are_written_once(spark, monkeypatch):
    """A region that no pivot makes smaller: its rows lie in the shared folder once, however many pairs its blocks have."""
    rows, paths, real = [r for r in corpus(3) if len(shingles(r[1])) > 1], [], jaccard.scratch_path
    monkeypatch.setattr(jaccard, "scratch_path", lambda *a: paths.append(real(*a)) or paths[-1])
    sets = jaccard.shingle_sets(pa.array([r[1] for r in rows]))
    one = {jaccard.class_key(s): (7, jaccard.class_key(s), r[1], len(s)) for r, s in zip(rows, sets, strict=True)}
    total = sum(x[3] for x in one.values())
    held = spark.createDataFrame([(*x[:3], total) for x in one.values()], "region long, key long, text string, total long")
    links = stars(jaccard._block_pairs(held, 75, 5, total // 6))
    names = {r["hi"]: r["lo"] for r in links.collect()}
    keys, ids = list(one), {k: i for i, k in enumerate(one)}
    want = brute([(ids[k], one[k][2]) for k in keys])
    groups = {}
    for k in keys:
        groups.setdefault(names.get(k, k), set()).add(ids[k])
    assert sorted(min(g) for g in groups.values() for _ in g) == sorted(c for _, _, c in want)
    assert spark.read.parquet(paths[0]).count() == len(keys)


@pytest.mark.parametrize("size, some, most", [(0, 0, 1), (900, 900, 3), (900, 20, 3), (90_000, 2, 70_000), (500, 9, 600), (5, 5, 300), (70_000, 5, 3)])
def test_counts_keep(size, some, most):
    numbers = np.zeros(size, np.int64)
    numbers[np.random.default_rng(size).permutation(size)[:some]] = most
    packed = jaccard._small(numbers)
    assert (jaccard._counts(packed) == numbers).all() and len(packed) <= 9 + 8 * some
