"""Tree search and exact top-k against brute force."""

import numpy as np
import pytest

from lakeloom.llm import ann, vafile

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score string"


def rows_of(n, width=8, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).astype(np.float32)
    x[n // 2 : n // 2 + n // 3] = x[0]  # a third are copies
    rows = [(i, [float(v) for v in row], 0, 7, "own") for i, row in enumerate(x)]
    odd = [(1_000, None, 0, 0, ""), (1_050, [], 0, 0, ""), (1_100, [float("nan")] * width, 0, 0, ""), (1_150, [1.0, None] * (width // 2), 0, 0, ""), (None, [1.0] * width, 0, 0, ""),
           (1_200, [float("inf")] * width, 0, 0, ""), (1_250, [0.0] * width, 0, 0, ""), (1_300, [1.0, 2.0], 0, 0, "")]
    return rows, odd


def brute(rows, k, score, zero=True):
    out = {}
    good = [(i, np.array(v, float)) for i, v, *_ in rows]
    for q, x in good:
        if q % 50 == 0 and (zero or x.any()):
            found = sorted(((-score(x, y), i) for i, y in good if i != q and (zero or y.any())))[:k]
            out[q] = [(i, -s) for s, i in found]
    return out


def test_exact_top_k_is_brute_force(spark):
    rows, odd = rows_of(300)
    found = vafile.top_k(spark.createDataFrame(rows + odd, SCHEMA), slab=64).collect()
    want = brute(rows + [(1_250, [0.0] * 8)], 5, lambda x, y: int((np.floor(256 * x) * np.floor(256 * y)).sum()))
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == want


def test_bounds_hold_every_vector():
    rng = np.random.default_rng(0)
    x = vafile.quantised(rng.normal(size=(200, 6)))
    cells = vafile.Cells(x.min(axis=0), x.max(axis=0), 3)
    codes = cells.code(x)
    for d in range(6):
        assert (cells.edges[d, codes[:, d]] <= x[:, d]).all() and (x[:, d] <= cells.edges[d, codes[:, d] + 1]).all()
    q = vafile.quantised(rng.normal(size=(20, 6)))
    assert (cells.bounds(q, codes) >= q @ x.T - 1e-6).all()


def test_large_products_stay_exact():
    q, x = np.array([2.0**40, 3.0]), np.array([[2.0**20, 5.0], [1.0, 1.0]])
    assert vafile.exact_products(q, x).tolist() == [2**60 + 15, 2**40 + 3]


@pytest.mark.parametrize("rows", [[], [(50, None, 0, 0, "")]])
def test_nothing_to_search(spark, rows):
    empty = spark.createDataFrame(rows, SCHEMA)
    assert vafile.top_k(empty).collect() == [] and ann.tree_search(empty).collect() == []


def test_tree_search_ties_and_copies(spark):
    rows, odd = rows_of(400)
    df = spark.createDataFrame(rows + odd, SCHEMA)
    got = ann.tree_search(df, goal=1.0, leaf_size=20, group=32, asked=400).toPandas()
    want = ann.brute_force(df).toPandas()
    key = ["query_id", "rank"]
    assert got.sort_values(key).to_numpy().tolist() == want.sort_values(key).to_numpy().tolist()
    of_copy = want[want.query_id == 0].sort_values("rank")
    assert of_copy.vec_id.tolist() == list(range(200, 205)) and (abs(of_copy.score - 1) < 1e-12).all()


def test_tree_recall(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in x], 0, 0, "") for i, x in enumerate(rng.normal(size=(3_000, 16)))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["query_id"], r["vec_id"]) for r in ann.tree_search(df, leaf_size=60).collect()}
    want = {(r["query_id"], r["vec_id"]) for r in ann.brute_force(df).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_small_leaves_widen_until_k_candidates(spark):
    rows = [(i, [1.0, float(i)], 0, 0, "") for i in range(0, 60)]
    got = ann.tree_search(spark.createDataFrame(rows, SCHEMA), goal=0.1, leaf_size=2, branches=2, asked=8).toPandas()
    assert got.groupby("query_id").size().to_dict() == {0: 5, 50: 5}


def test_best_bin_first_visits_every_leaf_once():
    tree = ann.Tree(np.random.default_rng(1).normal(size=(500, 4)), leaf_size=20)
    assert sorted(tree.visits(np.ones(4), tree.leaves)) == list(range(tree.leaves))
