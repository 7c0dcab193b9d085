"""Exact search over cells of vectors, against every pair."""

import os

import numpy as np
import pyarrow.dataset as ds
import pytest

from lakeloom.operators import balls as B
from lakeloom.operators import vectors as V
from lakeloom.session import shared_folder


def rows(df):
    return sorted((r["q"] if r["q"] is not None else -1, r["rank"], r["id"], round(r["distance"], 9)) for r in df.collect())


def table(spark, x, name="id"):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], f"{name} long, embedding array<double>")


@pytest.mark.parametrize("cells, slab, spread", [(9, 20, 0.05), (1, 1000, 1.0), (200, 3, 0.3)])
def test_same_as_every_pair(spark, cells, slab, spread):
    r = np.random.default_rng(cells)
    mids = r.normal(size=(8, 6)) * 4
    x = mids[r.integers(0, 8, 240)] + r.normal(size=(240, 6)) * spread
    x[50:90] = x[50]  # equal vectors: ties go to smaller ids
    v, q = table(spark, x), table(spark, np.r_[x[::7], r.normal(size=(5, 6)) * 9], "q")
    stats = {}
    found = rows(B.knn_pruned(v, q, 3, "id", "q", cells=cells, slab=slab, block=4, stats=stats))
    assert found == rows(V.knn_l2(v, q, 3, "id", "q"))
    assert stats["all"] == 240 * q.count() and stats["pairs"] <= stats["all"]
    if cells == 9:
        assert stats["pairs"] < 0.6 * stats["all"]


def test_missing_repeated_and_few(spark, make):
    v = make("id long, embedding array<float>", (1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, None), (4, [6.0, 8.0]), (5, [float("nan"), 0.0]), (6, [None, 1.0]))
    q = make("q long, embedding array<double>", (7, [0.0, 0.0]), (7, [6.0, 8.0]), (None, [3.0, 4.0]), (8, None), (9, [float("inf"), 0.0]))
    found = rows(B.knn_pruned(v, q, 2, "id", "q"))
    assert found == [(-1, 1, 2, 0.0), (-1, 2, 1, 5.0), (7, 1, 1, 0.0), (7, 1, 4, 0.0), (7, 2, 2, 5.0), (7, 2, 2, 5.0)]
    assert len(rows(B.knn_pruned(v, q, 9, "id", "q"))) == 9
    assert rows(B.knn_pruned(v.limit(0), q, 2, "id", "q")) == []
    with pytest.raises(ValueError):
        B.knn_pruned(v, q.limit(0), 2, "id", "q")


def test_nothing_is_written_per_visit(spark):
    """Where no cell can be ruled out, each vector is still written once, and a query not once per cell."""
    x = np.random.default_rng(3).normal(size=(500, 8))
    v, q = table(spark, x), table(spark, x, "q")
    top = f"{shared_folder(spark)}/lakeloom"
    before, stats = set(os.listdir(top)) if os.path.isdir(top) else set(), {}
    assert rows(B.knn_pruned(v, q, 3, "id", "q", cells=40, stats=stats)) == rows(V.knn_l2(v, q, 3, "id", "q"))
    written = {d: ds.dataset(f"{top}/{d}", format="parquet").count_rows() for d in set(os.listdir(top)) - before if not d.startswith("knn-queries")}
    assert stats["pairs"] > 0.9 * stats["all"] and 0 < sum(written.values()) <= 5 * 500
