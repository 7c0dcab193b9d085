"""Exact nearest neighbours that skip cells of vectors by the triangle inequality."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.scalars import stable_hash
from lakeloom.operators.vectors import SLICE, _first_k, _matrix, _together
from lakeloom.session import materialize, scratch_path
from lakeloom.sources.shared import parquet_blocks

MAX_CELLS = 4_096
CELL_ROWS = 512
MARGIN = 1e-9
MAX_TASKS = 4_096


def _centres(vectors: DataFrame, vector_id: str, vector: str, cells: int) -> np.ndarray:
    """``cells`` vectors picked by a hash of their ids; at most ``MAX_CELLS`` of them, the same on every run."""
    picked = vectors.select(stable_hash(vector_id, seed=11).alias("h"), vector_id, vector).orderBy("h", vector_id).limit(cells)
    return np.unique(np.array([r[vector] for r in picked.collect()], dtype=np.float64), axis=0)


def _whole(vector: str) -> Column:
    """Vectors that can be compared: all components are known and finite."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T)
    return np.sqrt(np.maximum(square, 0.0))


def _slack(x: np.ndarray, centres: np.ndarray) -> float:
    """What rounding may cost a distance made from squares and products: bounds are widened by it."""
    top = max(float((x * x).sum(1).max(initial=0.0)), float((centres * centres).sum(1).max(initial=0.0)))
    return float(np.sqrt(1e-14 * x.shape[1] * (top + 1e-300)) * 4)


def in_cells(vectors: DataFrame, vector_id: str, vector: str, centres: np.ndarray) -> tuple[str, DataFrame]:
    """Folder of the vectors by cell (id, vector, gap to the centre) in the shared folder, and the cells' sizes and rings.

    Vectors keep their type. A cell that holds a third of all rows is written by several tasks.
    """
    kind = vectors.schema[vector].dataType.simpleString()

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                gaps = _distances(_matrix(rows.column(1)), centres)
                cell = gaps.argmin(1)
                own = gaps[np.arange(len(cell)), cell]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), rows.column(0), rows.column(1), pa.array(own)], names=["cell", "id", "v", "gap"]
                )

    spark, shape = vectors.sparkSession, f"cell int, id long, v {kind}, gap double"
    path = scratch_path(spark, "cells")
    plain = vectors.select(F.col(vector_id).cast("long").alias("id"), F.col(vector).alias("v"))
    plain.mapInArrow(put, shape).hint("rebalance", "cell").write.partitionBy("cell").parquet(path)
    placed = spark.read.schema("id long, gap double, cell int").parquet(path)
    rings = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("gap").alias("inner"), F.max("gap").alias("outer"))
    return path, rings


def knn_pruned(
    vectors: DataFrame, queries: DataFrame, k: int, vector_id: str, query_id: str,
    vector: str = "embedding", query_vector: str = "embedding", cells: int | None = None, slab: int = SLICE, block: int = 2_048,
    stats: dict | None = None,
) -> DataFrame:
    """The rows of ``knn_l2``, exactly, from a part of the pairs: (query_id, vector_id, distance, rank).

    Each vector goes to the cell of its nearest centre; there is about one cell per ``CELL_ROWS`` rows, at most ``MAX_CELLS``
    (then cells grow). A query first searches the nearest cells that hold ``k`` vectors between them; its ``k``-th distance
    there is a bound. Only cells whose ring around the centre comes nearer than the bound can hold better ones, and only
    these are searched next, nearest first, while the bound falls; in a cell, vectors are skipped whose gap to the centre
    differs from the query's by more than the bound. Queries are dealt out by their nearest cell; a task takes them in blocks
    of ``block``, reads the cells that a block needs from the shared folder, ``slab`` rows at a time, and hands on ``k`` rows
    per query at the end. So each query and each vector is shuffled once, the vectors are written once, and nothing is
    written per pair or per visit to a cell.
    Each query row is asked by itself, also where ids repeat or are NULL; vectors that are NULL or hold NULL or
    non-finite components are neither asked nor found, and no queries is an error. Vectors have one length. ``stats`` gets the number of ``pairs`` computed and of ``all`` pairs.
    """
    spark = vectors.sparkSession
    asked = queries.where(_whole(query_vector)).select(F.col(query_id).cast("long").alias("name"), F.col(query_vector).alias("x"))
    asks = asked.count()
    if not asks:
        raise ValueError("no queries")
    known = vectors.where(_whole(vector))
    total = known.count()
    if not total:
        return spark.createDataFrame([], f"`{query_id}` long, `{vector_id}` long, distance double, rank int")
    count = cells or min(MAX_CELLS, max(1, -(-total // CELL_ROWS)))
    centres = _centres(known, vector_id, vector, min(count, MAX_CELLS))
    path, rings = in_cells(known, vector_id, vector, centres)
    ring = {r["cell"]: (r["n"], r["inner"], r["outer"]) for r in rings.collect()}  # at most MAX_CELLS rows
    used = np.array(sorted(ring), dtype=np.int64)
    n, inner, outer = (np.array([ring[c][i] for c in used], dtype=np.float64) for i in range(3))
    mid = centres[used]

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                cell = _distances(_matrix(rows.column(1)), mid).argmin(1)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *rows.columns], names=["cell", "name", "x"])

    def first_cells(gaps: np.ndarray) -> np.ndarray:
        """Which cells hold a query's first ``k`` vectors, nearest first."""
        out = np.zeros(gaps.shape, bool)
        for at in range(0, len(gaps), 256):
            part = slice(at, at + 256)
            order = np.argsort(gaps[part], axis=1, kind="stable")
            before = np.cumsum(n[order], axis=1) - n[order]
            np.put_along_axis(out[part], order, before < k, axis=1)
        return out

    def nearest(x: np.ndarray) -> tuple:
        """The best of a block of queries: (row, id, distance), in order, and the pairs computed for each row."""
        gaps, slack = _distances(x, mid), _slack(x, mid)
        own = first_cells(gaps)
        bound, pairs = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
        best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        for first in (True, False):
            for c in np.argsort(gaps.min(0), kind="stable"):
                if first:
                    visit = own[:, c]
                else:
                    least = np.maximum(gaps[:, c] - outer[c], inner[c] - gaps[:, c]) - slack
                    visit = ~own[:, c] & (least <= (bound + slack) * (1 + MARGIN))
                rows = np.flatnonzero(visit)
                if not len(rows):
                    continue
                pairs[rows] += int(n[c])
                for piece in parquet_blocks(f"{path}/cell={used[c]}", ["id", "v", "gap"], slab):
                    if not piece.num_rows:
                        continue
                    ids, v = _together([piece.select(["id", "v"])])
                    far = np.abs(piece.column("gap").to_numpy()[None, :] - gaps[rows, c][:, None])
                    may = far <= ((bound[rows] + 2 * slack) * (1 + MARGIN))[:, None]
                    some = np.flatnonzero(may.any(1))
                    if not len(some):
                        continue
                    q, more = x[rows[some]], 2 * _slack(x[rows[some]], v)
                    rough, limit = _distances(q, v), bound[rows[some]] + more
                    if not np.isfinite(limit).all():
                        keep = min(k, rough.shape[1]) - 1
                        limit = np.minimum(limit, np.partition(rough, keep, axis=1)[:, keep] + more)
                    row, col = np.nonzero((rough <= limit[:, None]) & may[some])
                    if not len(row):
                        continue
                    apart = v[col] - q[row]
                    found = (rows[some][row], ids[col], np.sqrt((apart * apart).sum(1)))
                    best = _first_k(*[np.concatenate(pair) for pair in zip(best, found)], k)
                    size = np.bincount(best[0], minlength=len(x))
                    full = np.flatnonzero(size == k)
                    bound[full] = best[2][np.cumsum(size)[full] - 1]
        return *best, pairs

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, block):
            row, ids, distance, pairs = nearest(_matrix(batch.column("x")))
            rank = np.arange(len(row)) - np.searchsorted(row, row, side="left") + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("name").take(pa.array(row)), pa.array(ids), pa.array(distance), pa.array(rank.astype(np.int32)), pa.array(pairs[row])],
                names=["name", "id", "distance", "rank", "pairs"],
            )

    kind = asked.schema["x"].dataType.simpleString()
    tasks = max(1, min(MAX_TASKS, -(-asks // block)))
    near_by = asked.mapInArrow(home, f"cell int, name long, x {kind}").withColumn("n", F.monotonically_increasing_id())
    dealt = near_by.repartitionByRange(tasks, "cell", "n").sortWithinPartitions("cell", "n").select("name", "x")
    found = dealt.mapInArrow(search, "name long, id long, distance double, rank int, pairs long")
    if stats is not None:
        found = materialize(found, "near")
        stats["pairs"] = found.where("rank = 1").agg(F.sum("pairs")).first()[0]
        stats["all"] = total * asks
    return found.select(F.col("name").alias(query_id), F.col("id").alias(vector_id), "distance", "rank")


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """A task's rows in blocks of ``most``, whatever the batches."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        at = 0
        while batch.num_rows - at:
            part = batch.slice(at, most - rows)
            held.append(part)
            at, rows = at + part.num_rows, rows + part.num_rows
            if rows == most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
