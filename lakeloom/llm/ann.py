"""Approximate nearest neighbours: a hierarchical k-means tree with best-bin-first search."""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.vafile import main_width, matrix, query_blocks, slabs, usable
from lakeloom.session import materialize, scratch_path


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centres of unit vectors by spherical k-means; fewer than k where groups stay empty."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    if len(distinct) <= k:
        return distinct
    centres = distinct[rng.choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        at = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        norms = np.linalg.norm(sums, axis=1)
        centres = sums[norms > 1e-12] / norms[norms > 1e-12, None]
        if len(centres) < 2:
            break
    return centres


@dataclass
class Node:
    centres: np.ndarray | None = None
    children: list = field(default_factory=list)
    leaf: int = -1


class Tree:
    """Hierarchical k-means tree; inner nodes hold the centres of their children, leaves a number."""

    def __init__(self, sample: np.ndarray, branches: int = 8, leaf_size: int = 250, seed: int = 7):
        self.leaves = 0
        self.root = self._grow(sample, branches, leaf_size, seed)

    def _grow(self, x: np.ndarray, branches: int, leaf_size: int, seed: int) -> Node:
        centres = kmeans(x, branches, seed) if len(x) > leaf_size else x[:0]
        if len(centres) < 2:
            self.leaves += 1
            return Node(leaf=self.leaves - 1)
        at = np.argmax(x @ centres.T, axis=1)
        kept = [c for c in range(len(centres)) if (at == c).any()]
        if len(kept) < 2:
            self.leaves += 1
            return Node(leaf=self.leaves - 1)
        return Node(centres[kept], [self._grow(x[at == c], branches, leaf_size, seed + 1) for c in kept])

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector: the nearest child at every level."""
        out = np.zeros(len(x), np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node.centres is None:
                out[rows] = node.leaf
            elif len(rows):
                at = np.argmax(x[rows] @ node.centres.T, axis=1)
                todo += [(child, rows[at == i]) for i, child in enumerate(node.children)]
        return out

    def visits(self, q: np.ndarray, most: int) -> list[int]:
        """Leaves in best-bin-first order: the branch with the nearest centre is opened next, from a priority queue."""
        queue, count, found = [(-math.inf, 0, self.root)], 1, []
        while queue and len(found) < most:
            _, _, node = heapq.heappop(queue)
            if node.centres is None:
                found.append(node.leaf)
                continue
            for s, child in zip(node.centres @ q, node.children, strict=True):
                heapq.heappush(queue, (-float(s), count, child))
                count += 1
        return found


def spare_copies(ids: np.ndarray, xs: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among the ``k`` nearest of some query: of equal vectors those with the k + 1 smallest ids."""
    order = np.argsort(ids, kind="stable")
    _, names = np.unique(xs[order], axis=0, return_inverse=True)
    names = names.ravel()
    by_name = np.argsort(names, kind="stable")
    starts = np.searchsorted(names[by_name], np.arange(names.max() + 1)) if len(names) else np.zeros(0, np.int64)
    place = np.arange(len(names)) - starts[names[by_name]]
    return np.sort(order[by_name[place <= k]])


def nearest(qids, qs, ids, xs, k: int, chunk: int = 128, leaves=None, visited=None):
    """Best ``k`` rows per query, (query ids, ids, scores): a matrix product picks candidates, ``cosine`` scores them.

    With ``leaves`` (of the rows) and ``visited`` (a list of leaves per query) each query meets its leaves' rows only."""
    kept = spare_copies(ids, xs, k)
    ids, xs = ids[kept], xs[kept]
    unit = xs / np.linalg.norm(xs, axis=1)[:, None]
    unit_q = qs / np.linalg.norm(qs, axis=1)[:, None]
    if leaves is None:
        blocks = [(np.arange(a, min(a + chunk, len(qids))), np.arange(len(ids))) for a in range(0, len(qids), chunk)]
    else:
        leaves = leaves[kept]
        asked = np.repeat(np.arange(len(qids)), [len(v) for v in visited])
        wanted = np.concatenate(visited) if len(visited) else np.zeros(0, np.int64)
        blocks = []
        for leaf in np.unique(leaves):
            q, r = asked[wanted == leaf], np.flatnonzero(leaves == leaf)
            blocks += [(q[a : a + chunk], r) for a in range(0, len(q), chunk)]
    pairs_q, pairs_r, rough = [], [], []
    for q, r in blocks:
        if not len(q) or not len(r):
            continue
        scores = unit_q[q] @ unit[r].T
        scores[qids[q][:, None] == ids[r][None, :]] = -np.inf
        kth = np.partition(scores, len(r) - k, axis=1)[:, len(r) - k] if len(r) > k else np.full(len(q), -np.inf)
        a, b = np.nonzero((scores >= kth[:, None] - 1e-9) & (scores > -np.inf))
        pairs_q.append(q[a]), pairs_r.append(r[b]), rough.append(scores[a, b])
    if not pairs_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    q, r, rough = np.concatenate(pairs_q), np.concatenate(pairs_r), np.concatenate(rough)
    order = np.lexsort((-rough, q))
    q, r, rough = q[order], r[order], rough[order]
    first = np.searchsorted(q, np.arange(len(qids)))
    last = np.minimum(first + k - 1, np.searchsorted(q, np.arange(len(qids)), side="right") - 1)
    near = rough >= rough[np.maximum(last, 0)][q] - 1e-9
    q, r = q[near], r[near]
    exact = np.empty(len(q))
    for a in range(0, len(q), 1 << 15):
        x, y = xs[r[a : a + (1 << 15)]], qs[q[a : a + (1 << 15)]]
        exact[a : a + (1 << 15)] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
    order = np.lexsort((ids[r], -exact, q))
    q, r, exact = q[order], r[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    top = place < k
    return qids[q[top]], ids[r[top]], exact[top]


def directed(vectors: DataFrame) -> DataFrame:
    """Usable vectors scaled by a power of two so that squares neither overflow nor vanish; zero vectors are left out."""
    v = usable(vectors).withColumn("_most", F.array_max(F.transform("vector", lambda x: F.abs(x)))).where("_most > 0")
    # far from 1 only for odd inputs; a power of two leaves the cosine exactly as it was
    scale = F.when((F.col("_most") > 1e100) | (F.col("_most") < 1e-100), F.pow(F.lit(2.0), -F.floor(F.log2("_most")))).otherwise(F.lit(1.0))
    return v.withColumn("_scale", scale).select("vec_id", F.transform("vector", lambda x: x * F.col("_scale")).alias("vector"), F.size("vector").alias("width"))


def fit_tree(rows: DataFrame, width: int, sample: int, leaf_size: int, branches: int) -> Tree:
    """Tree of a bounded sample: the ``sample`` rows with the smallest hash."""
    got = rows.select("vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()["vector"].combine_chunks()
    x = matrix(got, width) if len(got) else np.zeros((0, width))
    return Tree(x / np.linalg.norm(x, axis=1)[:, None] if len(x) else x, branches, leaf_size)


def calibrate(indexed: DataFrame, tree: Tree, width: int, asked: int, k: int, goal: float) -> tuple[int, float]:
    """(leaf visits, recall): ``asked`` rows are searched by brute force over all rows; visits widen until at least
    ``goal`` of their true neighbours lie in visited leaves."""
    picked = indexed.orderBy(F.xxhash64(F.col("vec_id"), F.lit(1)), "vec_id").limit(asked).select("vec_id", "vector").toArrow()
    qids = picked["vec_id"].to_numpy()
    if not len(qids):
        return 1, 1.0
    qs = matrix(picked["vector"].combine_chunks(), width)

    def brute(batches):
        for batch in batches:
            if batch.num_rows:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                q, i, s = nearest(qids, qs, ids, matrix(batch.column(1), width), k)
                leaf = dict(zip(ids.tolist(), batch.column(2).to_pylist(), strict=True))
                yield pa.RecordBatch.from_pydict({"query_id": q.astype(np.int64), "vec_id": i.astype(np.int64), "score": s.astype(float), "leaf": np.array([leaf[x] for x in i.tolist()], np.int64)})

    found = indexed.select("vec_id", "vector", "leaf").mapInArrow(brute, "query_id long, vec_id long, score double, leaf long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    truth = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("query_id", "leaf").collect()  # asked x k rows
    place = {}
    for qid, q in zip(qids.tolist(), qs, strict=True):
        place[qid] = {leaf: i for i, leaf in enumerate(tree.visits(q / np.linalg.norm(q), tree.leaves))}
    needed = np.sort([place[r["query_id"]][r["leaf"]] + 1 for r in truth]) if truth else np.ones(1)
    visits = 1
    while (recall := float((needed <= visits).mean())) < goal:
        visits = min(tree.leaves, max(visits + 1, visits * 5 // 4))
    return visits, recall


def shards(sizes: dict[int, int], leaves: int, group: int) -> tuple[dict[int, int], dict[int, int]]:
    """First shard and number of shards of each leaf: neighbouring leaves share a shard of about ``group`` rows, larger
    leaves are spread over several of their own."""
    first, parts, at, held = {}, {}, 0, 0
    for leaf in range(leaves):
        n = sizes.get(leaf, 0)
        if not n:
            continue
        if held and held + n > group:
            at, held = at + 1, 0
        first[leaf], parts[leaf] = at, max(1, -(-n // group))
        if n > group:
            at, held = at + parts[leaf], 0
        else:
            held += n
    return first, parts


def tree_search(
    vectors: DataFrame, every: int = 50, k: int = 5, goal: float = 0.95, sample: int = 20_000, asked: int = 256, leaf_size: int = 250, branches: int = 8, group: int = 2048
) -> DataFrame:
    """``k`` nearest rows by cosine for every row whose ``vec_id`` is divisible by ``every``: ``query_id``, ``rank``, ``vec_id``, ``score``.

    The tree is fitted on at most ``sample`` rows; every row is put into its leaf. The number of leaves visited is
    calibrated: for ``asked`` rows brute force over all rows tells the leaves of the true neighbours, and visits widen
    until ``goal`` of them are covered. Neighbouring leaves form shards of about ``group`` rows, and a leaf with more rows is
    spread over several by hash; a query goes once to each shard that holds leaves it visits, and the exact cosine (double
    precision, original vectors) ranks the rows of these leaves. Where the visited leaves hold fewer than k candidates, the query
    visits all leaves. Ties go to the smaller id. Null ids, vectors that are null, zero, empty or hold null or
    non-finite components, and vectors of another length than most, take no part; a repeated query id is asked once. Empty
    tables give no rows.
    """
    spark = vectors.sparkSession
    ready = directed(vectors)
    ready = materialize(ready, "tree-vectors")
    width = main_width(ready)
    rows = ready.where(F.col("width") == width).select("vec_id", "vector")
    tree = fit_tree(rows, width, sample, leaf_size, branches)
    if not tree.leaves or not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def index(batches):
        for batch in batches:
            x = matrix(batch.column(1), width)
            leaf = tree.assign(x / np.linalg.norm(x, axis=1)[:, None]) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf, pa.int64())], names=["vec_id", "vector", "leaf"])

    indexed = materialize(rows.mapInArrow(index, "vec_id long, vector array<double>, leaf long"), "tree-index")
    visits, _ = calibrate(indexed, tree, width, asked, k, goal)
    sizes = {r["leaf"]: r["n"] for r in indexed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # one row per leaf
    first, parts = shards(sizes, tree.leaves, group)
    places = F.create_map(*[F.lit(x) for leaf in sizes for x in (leaf, first[leaf])])
    spread = F.create_map(*[F.lit(x) for leaf in sizes for x in (leaf, parts[leaf])])
    leaf = F.col("leaf")
    placed = indexed.withColumn("shard", places[leaf] + F.pmod(F.xxhash64("vec_id"), spread[leaf])).select("shard", "vec_id", "vector", "leaf")

    def route(batches):
        for batch in batches:
            ids, x = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch.column(1), width)
            at, shard, lists = [], [], []
            for i, q in enumerate(x):
                held, seen, to = 0, 0, {}
                for one in tree.visits(q / np.linalg.norm(q), tree.leaves):
                    if seen >= visits and held > k:
                        break
                    seen, held = seen + 1, held + sizes.get(one, 0)
                    for s in range(first.get(one, 0), first.get(one, 0) + parts.get(one, 0)):
                        to.setdefault(s, []).append(one)
                at += [i] * len(to)
                shard += to.keys()
                lists += to.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int64()), pa.array(ids[at], pa.int64()), batch.column(1).take(pa.array(at, pa.int64())), pa.array(lists, pa.list_(pa.int64()))],
                names=["shard", "vec_id", "vector", "leaves"],
            )

    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    queries = queries.mapInArrow(route, "shard long, vec_id long, vector array<double>, leaves array<long>")

    def match(asked_rows: pa.Table, held: pa.Table) -> pa.Table:
        if not asked_rows.num_rows or not held.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        visited = [np.array(x, np.int64) for x in asked_rows["leaves"].to_pylist()]
        q, i, s = nearest(
            asked_rows["vec_id"].to_numpy(), matrix(asked_rows["vector"].combine_chunks(), width), held["vec_id"].to_numpy(), matrix(held["vector"].combine_chunks(), width), k,
            leaves=held["leaf"].to_numpy(), visited=visited,
        )
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.float64())})

    found = queries.groupBy("shard").cogroup(placed.groupBy("shard")).applyInArrow(match, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def brute_force(vectors: DataFrame, every: int = 50, k: int = 5, slab: int = 1 << 14) -> DataFrame:
    """The same answer by comparing every query with every row, for measuring recall."""
    ready = materialize(directed(vectors), "brute-vectors")
    width = main_width(ready)
    rows = ready.where(F.col("width") == width).select("vec_id", "vector")
    asked = scratch_path(vectors.sparkSession, "brute-queries")
    rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"]).write.parquet(asked)

    def search(batches):
        for ids, xs in slabs(batches, width, slab):
            for qids, qs in query_blocks(asked, width):
                q, i, s = nearest(qids, qs, ids, xs, k)
                yield pa.RecordBatch.from_pydict({"query_id": q.astype(np.int64), "vec_id": i.astype(np.int64), "score": s.astype(float)})

    found = rows.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
