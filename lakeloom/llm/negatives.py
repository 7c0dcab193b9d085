"""Hard negatives: scores are sorted by (anchor, falling score, id) in the shuffle and read once as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.files import listed, place
from lakeloom.llm.vafile import exact_products, main_width, matrix, quantised
from lakeloom.session import materialize, scratch_path

#: Sort key of a score: anchor, falling score, positives before others of equal score, id.
KEY = ["anchor_id", "falling", "kind", "vec_id"]
SCORES = "anchor_id long, falling long, kind int, vec_id long"
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def labelled_vectors(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """``vec_id``, ``label``, ``vector``, ``width`` of rows that take part. Where ``vec_id`` is divisible by ``every``, the
    label is moved on by one."""
    v, label = F.col("embedding").cast("array<double>"), F.col("label").cast("long")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % every == 0, (label + 1) % labels).otherwise(label)
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), v.alias("vector"), F.size(v).alias("width"))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """(queries, rows) integer inner products, exactly; a ValueError where one doesn't fit a long."""
    if not (np.isfinite(q).all() and np.isfinite(x).all()):
        raise ValueError("components are too large: scores must fit a long")
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, x.shape[1]) < 2**53:
        return (q @ x.T).astype(np.int64)
    try:
        return np.stack([exact_products(row, x) for row in q])
    except OverflowError as e:
        raise ValueError("scores must fit a long") from e


def first_places(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, highest first, equal scores in order of place."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")][:k]


def bounds_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest integer score s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def row_slabs(batches, width: int, scale: float, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of a task's rows, about ``most`` at a time, in order of ids."""
    held, n = [], 0

    def done():
        ids, labels = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in (0, 1))
        x = quantised(np.concatenate([matrix(b.column(2), width) for b in held]), scale)
        order = np.argsort(ids, kind="stable")
        return ids[order], labels[order], x[order]

    for batch in batches:
        for a in range(0, batch.num_rows, most):
            held.append(batch.slice(a, most))
            n += held[-1].num_rows
            if n >= most:
                yield done()
                held, n = [], 0
    if n:
        yield done()


def anchor_blocks(path: str, width: int, scale: float, more: tuple[str, ...] = (), most: int = 1024):
    """Anchors (id, label, vector and ``more`` columns) from the shared folder, block by block."""
    store, _ = place(path)
    for name in listed(path, ".parquet"):
        with store.open_input_file(name) as f:
            for b in pq.ParquetFile(f).iter_batches(most, columns=["vec_id", "label", "vector", *more]):
                if b.num_rows:
                    ids, labels = (b.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
                    yield ids, labels, quantised(matrix(b.column("vector"), width), scale), [b.column(c).to_pylist() for c in more]


def score_rows(anchors: list, scores: list, ids: list, kind: int) -> pa.RecordBatch:
    a, s, i = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (anchors, scores, ids))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(-s), pa.array(np.full(len(a), kind, np.int32)), pa.array(i)], names=KEY)


def windows(batches, k: int, low: int, high: int):
    """Negatives of sorted scores (``KEY``). A positive opens its window; each other row falls into the open windows that
    hold its score and still lack rows. The stream keeps one anchor's windows, never its rows."""
    anchor, opened, out = None, [], []
    for batch in batches:
        for a, falling, kind, vec in zip(*(batch.column(c).to_pylist() for c in KEY), strict=True):
            if a != anchor:
                anchor, opened = a, []
            if kind == 0:
                least, most = bounds_of(-falling, low, high)
                opened.append([vec, -falling, least, most, 0])
                continue
            for w in opened:
                if w[4] < k and w[2] <= -falling <= w[3]:
                    w[4] += 1
                    out.append((a, w[0], w[4], vec, w[1], -falling))
            if len(out) >= 50_000:
                yield _found(out)
                out = []
    yield _found(out)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in FOUND.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "rank" else pa.int64()) for n, c in zip(names, columns, strict=True)], names=names)


def hard_negatives(
    rows: DataFrame, every: int = 100, positives: int = 5, k: int = 10, low: int = 30, high: int = 90, scale: float = 256.0, slab: int = 1 << 14
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of the same label, the first ``k`` rows of other labels whose
    score is between ``low`` and ``high`` per cent of the positive's: ``anchor_id``, ``positive_id``, ``rank``,
    ``negative_id``, ``positive_score``, ``negative_score``.

    Scores are inner products of floor(``scale`` * x), highest first, ties to smaller ids. Anchors are the rows whose
    ``vec_id`` is divisible by ``every``; a repeated anchor id is asked once, by its row with the smallest label and vector.
    Rows that carry the anchor's own id are not its candidates; other repeated rows count each. Null ids, labels and
    vectors, vectors with null or non-finite components and vectors of another length than most take no part. Positive
    scores below 0 have no window. An empty table gives no rows; a score beyond a long is an error.

    The table is scanned twice. Tasks read the anchors block by block from the shared folder. The first scan finds the
    positives, the second one hands on, of each task's rows, only those among the first ``k`` of some window, so the
    shuffle holds positives * k scores an anchor and slab at most. Scores are dealt by anchor, sorted by (anchor, falling
    score, id) as they arrive, and read as a stream that opens a positive's window when it meets the positive.
    """
    spark = rows.sparkSession
    ready = materialize(labelled_vectors(rows), "negatives-vectors")
    width = main_width(ready)
    own = ready.where((F.col("width") == width) & (F.col("width") > 0)).select("vec_id", "label", "vector")
    asked = scratch_path(spark, "negatives-anchors")
    least = own.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("least"))
    least.select("vec_id", "least.label", "least.vector").write.parquet(asked)

    def near(batches):
        for ids, labels, x in row_slabs(batches, width, scale, slab):
            by_label = {label: np.flatnonzero(labels == label) for label in np.unique(labels).tolist()}
            for qids, qlabels, q, _ in anchor_blocks(asked, width, scale):
                names, scores, found = [], [], []
                for label in np.unique(qlabels).tolist():
                    at = by_label.get(label)
                    if at is None:
                        continue
                    mine = np.flatnonzero(qlabels == label)
                    for j, row in zip(mine.tolist(), products(q[mine], x[at]), strict=True):
                        other = ids[at] != qids[j]
                        best = first_places(row[other], positives)
                        names.append(np.full(len(best), qids[j])), scores.append(row[other][best]), found.append(ids[at][other][best])
                yield score_rows(names, scores, found, 0)

    best = Window.partitionBy("anchor_id").orderBy("falling", "vec_id")
    near_rows = own.mapInArrow(near, SCORES).withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives).drop("place")
    near_rows = materialize(near_rows, "negatives-positives")
    tops = near_rows.groupBy("anchor_id").agg(F.collect_set(-F.col("falling")).alias("tops"))  # at most ``positives`` numbers
    armed = scratch_path(spark, "negatives-windows")
    spark.read.schema("vec_id long, label long, vector array<double>").parquet(asked).join(tops, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id").write.parquet(armed)

    def far(batches):
        for ids, labels, x in row_slabs(batches, width, scale, slab):
            for qids, qlabels, q, (held,) in anchor_blocks(armed, width, scale, ("tops",)):
                names, scores, found = [], [], []
                for j, row in enumerate(products(q, x)):
                    others = (labels != qlabels[j]) & (ids != qids[j])
                    taken = []
                    for positive in held[j]:
                        a, b = bounds_of(positive, low, high)
                        at = np.flatnonzero(others & (row >= a) & (row <= b))
                        taken.append(at[first_places(row[at], k)])
                    at = np.unique(np.concatenate(taken))
                    names.append(np.full(len(at), qids[j])), scores.append(row[at]), found.append(ids[at])
                yield score_rows(names, scores, found, 1)

    everything = near_rows.select(*KEY).unionByName(own.mapInArrow(far, SCORES))
    dealt = everything.repartition("anchor_id").sortWithinPartitions(*KEY)
    return dealt.mapInArrow(lambda batches: windows(batches, k, low, high), FOUND)
