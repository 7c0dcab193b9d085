"""Embedding, exact nearest neighbours and page-restricted similarity search."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.joins import broadcast_small
from lakeloom.operators.rows import top_per_group
from lakeloom.session import scratch_path
from lakeloom.sources.shared import parquet_blocks

QUERY_BLOCK = 2_048
SLICE = 2_048


def hashed_embedding(text: str, dim: int = 64) -> list[float]:
    """Unit vector of signed word counts; a local stand-in for an embedding service."""
    words = (text or "").lower().encode().split()
    h = np.fromiter(map(crc32, words), np.int64, len(words))
    out = np.bincount(h % dim, weights=((h >> 16) & 1) * 2.0 - 1.0, minlength=dim)
    norm = np.sqrt((out * out).sum())
    return (out / norm if norm else out).tolist()


def embed(df: DataFrame, text: str, name: str = "embedding", call: Callable[[Sequence[str]], list] | None = None, batch: int = 10) -> DataFrame:
    """Vector per text. ``call`` gets ``batch`` texts at a time, as an embedding service wants them."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.FloatType()))])
    each = call or (lambda texts: [hashed_embedding(t) for t in texts])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            vectors: list = []
            for at in range(0, len(rows), batch):
                vectors += each(rows[text].iloc[at:at + batch].tolist())
            yield rows.assign(**{name: vectors})

    return df.mapInPandas(run, schema)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Arrow list column without NULL vectors to a 2-D array without a Python loop; all vectors have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def knn_l2(
    vectors: DataFrame, queries: DataFrame, k: int, vector_id: str, query_id: str,
    vector: str = "embedding", query_vector: str = "embedding", block: int = QUERY_BLOCK,
) -> DataFrame:
    """Exact ``k`` nearest vectors of every query row: (query_id, vector_id, distance, rank).

    Every query row is asked by itself, also where ids repeat or are NULL; NULL vectors are neither asked nor found.
    The queries are written to the shared folder once. The vectors are scanned once; each task holds ``SLICE`` x 16 of
    them, reads the queries in blocks of ``block`` rows and emits ``k`` rows per query, never a row per pair.
    """
    asked = queries.filter(F.col(query_vector).isNotNull()).select(
        F.monotonically_increasing_id().alias("__q"), F.col(query_id).cast("long").alias("__id"), F.col(query_vector).cast("array<double>").alias("__v")
    )
    if asked.isEmpty():
        raise ValueError("no queries")
    path = scratch_path(vectors.sparkSession, "knn-queries")
    asked.write.parquet(path)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for v_ids, v in _held(batches, SLICE * 16):
            for rows in parquet_blocks(path, ["__q", "__id", "__v"], block):
                if not rows.num_rows:
                    continue
                numbers, names, q = rows.column(0).to_numpy(), rows.column(1), _matrix(rows.column(2))
                best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
                q_norm = (q * q).sum(1)
                for at in range(0, len(v_ids), SLICE):
                    ids, x = v_ids[at:at + SLICE], v[at:at + SLICE]
                    # squares and products pick the candidates, with a margin for rounding; differences rank them
                    rough = q_norm[:, None] + (x * x).sum(1)[None, :] - 2.0 * (q @ x.T)
                    keep = min(k, len(ids)) - 1
                    border = np.partition(rough, keep, axis=1)[:, keep]
                    near_q, near_v = np.nonzero(rough <= (border + 1e-9 * (1.0 + np.abs(border)))[:, None])
                    gap = x[near_v] - q[near_q]
                    found = (near_q, ids[near_v], np.sqrt((gap * gap).sum(1)))
                    best = _first_k(*[np.concatenate(pair) for pair in zip(best, found)], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[best[0]]), names.take(pa.array(best[0])), pa.array(best[1]), pa.array(best[2])],
                    names=["__q", query_id, vector_id, "distance"],
                )

    found = vectors.filter(F.col(vector).isNotNull()).select(F.col(vector_id).cast("long"), vector).mapInArrow(
        search, f"__q long, `{query_id}` long, `{vector_id}` long, distance double"
    )
    return top_per_group(found, ["__q"], [F.col("distance"), F.col(vector_id)], k).drop("__q")


def _held(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a task's rows, about ``most`` at a time."""
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            parts.append(batch)
        if sum(p.num_rows for p in parts) >= most:
            yield _together(parts)
            parts = []
    if parts:
        yield _together(parts)


def _together(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    ids = np.concatenate([p.column(0).to_numpy(zero_copy_only=False).astype(np.int64) for p in parts])
    return ids, np.concatenate([_matrix(p.column(1)) for p in parts])


def _first_k(group: np.ndarray, ids: np.ndarray, distance: np.ndarray, k: int) -> tuple:
    """The ``k`` smallest distances of each group, smaller ids first among ties."""
    order = np.lexsort((ids, distance, group))
    group, ids, distance = group[order], ids[order], distance[order]
    first = np.searchsorted(group, group, side="left")
    top = np.arange(len(group)) - first < k
    return group[top], ids[top], distance[top]


@F.arrow_udf(T.DoubleType())
def cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    """Cosine similarity of two vector columns; NULL for a zero or a missing vector."""
    known = np.flatnonzero(a.is_valid().to_numpy(zero_copy_only=False) & b.is_valid().to_numpy(zero_copy_only=False))
    x, y = _matrix(a.take(pa.array(known))), _matrix(b.take(pa.array(known)))
    out, size = np.zeros(len(a)), np.zeros(len(a))
    size[known] = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    with np.errstate(invalid="ignore", divide="ignore"):
        out[known] = (x * y).sum(1) / size[known]
    return pa.array(out, mask=size == 0)


def cosine_topk(
    documents: DataFrame, queries: DataFrame, page: str, document_id: str,
    vector: str = "embedding", query_vector: str = "query_embedding", threshold: float = 0.75, k: int = 5,
) -> DataFrame:
    """The ``k`` most similar documents of each query's own page with at least ``threshold`` similarity.

    The page is an equi-join key and each page has one query, so the result of the join is as long as the
    documents. Few queries are broadcast; many are joined by shuffle, where Spark splits a hot page. Each map
    task keeps ``k`` rows per page before the shuffle of the ranking.
    """
    # marked so, the function runs once per row although both the filter and the output use it
    similarity = cosine.asNondeterministic()
    pairs = documents.join(broadcast_small(queries.select(page, query_vector)), page).select(
        page, document_id, similarity(F.col(vector), F.col(query_vector)).alias("similarity")
    )
    close = pairs.filter(F.col("similarity") >= threshold)
    return top_per_group(close, [page], [F.col("similarity").desc(), F.col(document_id)], k)


def joined_keywords(top: DataFrame, page: str, text: str, rank: str = "rank", delimiter: str = ",") -> DataFrame:
    """Top documents of a page as one text in rank order; at most ``k`` parts each."""
    ordered = F.sort_array(F.collect_list(F.struct(rank, text)))
    return top.groupBy(page).agg(F.array_join(F.transform(ordered, lambda s: s[text]), delimiter).alias("updated_keywords"))


def retrieval_accuracy(top1: DataFrame, found: str, truth: str) -> DataFrame:
    """Share of queries whose best match is the true one."""
    return top1.agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.avg(F.when(F.col(found).eqNullSafe(F.col(truth)), 1.0).otherwise(0.0)).alias("accuracy"),
    )


def centroids(df: DataFrame, group: str, vector: str, dim: int) -> DataFrame:
    """Mean vector per group from per-position averages (partial sums per map task)."""
    means = [F.avg(F.col(vector)[i].cast("double")) for i in range(dim)]
    return df.groupBy(group).agg(F.array(*means).alias(vector))
