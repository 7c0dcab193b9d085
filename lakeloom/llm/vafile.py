"""Exact top-k by inner product with a vector-approximation file."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.files import listed, place
from lakeloom.session import materialize, scratch_path

SCHEMA = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` (array of double) of vectors that take part: neither null nor with null or non-finite components."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(id_column).isNotNull() & F.col(column).isNotNull()).select(F.col(id_column).cast("long").alias("vec_id"), v.alias("vector")).where(fine)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), width)


def quantised(x: np.ndarray, scale: float = 256.0) -> np.ndarray:
    return np.floor(x * scale)


class Cells:
    """Per dimension ``2 ** bits`` equal cells between the lowest and highest component of the corpus."""

    def __init__(self, low: np.ndarray, high: np.ndarray, bits: int):
        self.count = 1 << bits
        self.edges = low[:, None] + (high - low)[:, None] * (np.arange(self.count + 1) / self.count)[None, :]
        self.edges[:, -1] = high
        self.low, self.width = low, np.where(high > low, (high - low) / self.count, 1.0)

    def code(self, x: np.ndarray) -> np.ndarray:
        at = np.clip(np.floor((x - self.low) / self.width), 0, self.count - 1).astype(np.uint8)
        # rounding may put a value one cell off; its cell must hold it
        for _ in range(2):
            dims = np.arange(x.shape[1])
            at = np.where((x < self.edges[dims, at]) & (at > 0), at - 1, at).astype(np.uint8)
            at = np.where((x > self.edges[dims, at + 1]) & (at < self.count - 1), at + 1, at).astype(np.uint8)
        return at

    def bounds(self, queries: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """(queries, vectors) highest inner product that any vector in the same cells could have."""
        middle = (self.edges[:, :-1] + self.edges[:, 1:]) / 2
        half = (self.edges[:, 1:] - self.edges[:, :-1]) / 2
        dims = np.arange(codes.shape[1])
        return queries @ middle[dims, codes].T + np.abs(queries) @ half[dims, codes].T


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of one query with rows of ``x``; doubles are exact below 2^53, beyond that integers."""
    if not len(x):
        return np.zeros(0, np.int64)
    most = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, x.shape[1])
    if most < 2**53:
        return (x @ q).astype(np.int64)
    ints = [int(a) for a in q]
    return np.array([sum(a * int(b) for a, b in zip(ints, row, strict=True)) for row in x], np.int64)


def topk_block(query_ids, queries, ids, vectors, cells: Cells, k: int, slab: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Best ``k`` of one block of vectors for each query: cells are scanned for bounds; exact vectors are read in the
    order of their bounds until the kth exact score is above every bound left (equal bounds are read: ties go to ids)."""
    codes = cells.code(vectors)
    for start in range(0, len(query_ids), slab):
        upper = cells.bounds(queries[start : start + slab], codes)
        upper += np.abs(upper) * 1e-9 + 1e-6
        for j, bound in enumerate(upper):
            qid, q = query_ids[start + j], queries[start + j]
            best_s, best_i = np.zeros(0, np.int64), np.zeros(0, np.int64)
            read, step, left = np.zeros(len(ids), bool), 4 * k, len(ids)
            floor_ = -math.inf
            while left:
                take = min(step, left)
                masked = np.where(read, -np.inf, bound)
                part = np.argpartition(-masked, take - 1)[:take] if take < len(ids) else np.flatnonzero(~read)
                part = part[~read[part]]
                if masked[part].max() < floor_:
                    break
                part = part[masked[part] >= floor_]
                read[part] = True
                left = len(ids) - int(read.sum())
                own = part[ids[part] != qid]
                best_s = np.concatenate([best_s, exact_products(q, vectors[own])])
                best_i = np.concatenate([best_i, ids[own]])
                order = np.lexsort((best_i, -best_s))[:k]
                best_s, best_i = best_s[order], best_i[order]
                floor_ = best_s[-1] if len(best_s) == k else -math.inf
                step *= 4
            yield np.full(len(best_i), qid), best_i, best_s


def slabs(batches, width: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a task's rows, about ``most`` at a time."""
    ids, xs, n = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids.append(batch.column(0).to_numpy(zero_copy_only=False))
        xs.append(matrix(batch.column(1), width))
        n += batch.num_rows
        if n >= most:
            yield np.concatenate(ids), np.concatenate(xs)
            ids, xs, n = [], [], 0
    if n:
        yield np.concatenate(ids), np.concatenate(xs)


def query_blocks(path: str, width: int, most: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of a query table (``vec_id``, ``vector``) written to the shared folder, read by the tasks themselves."""
    store, _ = place(path)
    for name in listed(path, ".parquet"):
        with store.open_input_file(name) as f:
            for batch in pq.ParquetFile(f).iter_batches(most, columns=["vec_id", "vector"]):
                if batch.num_rows:
                    yield batch.column(0).to_numpy(zero_copy_only=False), matrix(batch.column(1), width)


def main_width(ready: DataFrame) -> int:
    """Length of most vectors (the larger one of equal counts)."""
    row = ready.groupBy("width").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col("width").desc()).first()
    return row["width"] if row else 0


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0, bits: int = 4, slab: int = 1 << 15) -> DataFrame:
    """Largest integer inner products of floor(``scale`` * x) over all vectors: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates all rows but the query's own id (a
    repeated query id is asked once, repeated candidates are candidates each). Null ids and vectors that are null, empty
    or hold null or non-finite components take no part, nor do vectors of another length than most. Ties go to the smaller
    id. An empty table gives no rows; scores must fit a long.

    The vectors are scanned once. A task holds ``slab`` of them, with their cells, and reads the query table block by block
    from the shared folder; it hands on k rows per query and slab.
    """
    ready = materialize(usable(vectors).withColumn("width", F.size("vector")), "va-vectors")
    width = main_width(ready)
    own = ready.where((F.col("width") == width) & (F.col("width") > 0))
    edges = own.select(F.posexplode("vector").alias("d", "x")).groupBy("d").agg(F.floor(F.min("x") * scale).cast("double").alias("a"), F.floor(F.max("x") * scale).cast("double").alias("b"))
    edges = edges.orderBy("d").collect()  # one row per dimension
    if not edges:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    cells = Cells(np.array([r["a"] for r in edges]), np.array([r["b"] for r in edges]), bits)
    asked = scratch_path(vectors.sparkSession, "va-queries")
    own.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"]).select("vec_id", "vector").write.parquet(asked)

    def search(batches):
        for ids, xs in slabs(batches, width, slab):
            xs = quantised(xs, scale)
            for qids, qs in query_blocks(asked, width):
                got = list(topk_block(qids, quantised(qs, scale), ids, xs, cells, k))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([g[j] for g in got]), pa.int64()) for j in range(3)], names=["query_id", "vec_id", "score"])

    found = own.select("vec_id", "vector").mapInArrow(search, SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
