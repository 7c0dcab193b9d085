"""Linear models that are updated batch by batch from sums that can be added."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _columns(features: Sequence[str]) -> list[Column]:
    """1, the features: the design row."""
    return [F.lit(1.0), *[F.col(f).cast("double") for f in features]]


def sufficient_sums(rows: DataFrame, features: Sequence[str], target: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys``, ``xx`` (upper triangle of X'X, its first entry is the number of rows), ``xy`` and ``yy``.

    Rows with a missing or non-finite feature or target don't count. Sums are combined on the map side."""
    used = [F.col(c).cast("double") for c in (*features, target)]
    fine = F.lit(True)
    for c in used:
        fine = fine & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    x, y = _columns(features), F.col(target).cast("double")
    pairs = [F.sum(a * b) for i, a in enumerate(x) for b in x[i:]]
    return rows.where(fine).groupBy(*keys).agg(F.array(*pairs).alias("xx"), F.array(*[F.sum(a * y) for a in x]).alias("xy"), F.sum(y * y).alias("yy"))


def update_each_batch(path: str, features: Sequence[str], target: str, keys: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that keeps each micro-batch's sums below its own number.

    A batch that is run again overwrites its own sums, so nothing counts twice; no model is held between batches, and no row
    is read again."""

    def run(batch: DataFrame, batch_id: int) -> None:
        sufficient_sums(batch, features, target, keys).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run


def model_after(spark: SparkSession, path: str, features: Sequence[str], keys: Sequence[str] = (), last: int | None = None, ridge: float = 0.0) -> DataFrame:
    """The least-squares model of all batches up to number ``last`` (all so far): ``keys``, ``n``, ``intercept``, a column
    per feature and ``rmse``. Where the features don't determine the weights they are null."""
    sums = spark.read.parquet(path)
    if last is not None:
        sums = sums.where(F.col("batch") <= last)
    size = len(features) + 1
    entries = size * (size + 1) // 2

    def total(column: str, count: int) -> Column:
        return F.array(*[F.sum(F.col(column)[i]) for i in range(count)])

    added = sums.groupBy(*keys).agg(total("xx", entries).alias("xx"), total("xy", size).alias("xy"), F.sum("yy").alias("yy"))
    if not keys:
        added = added.where(F.col("yy").isNotNull())
    kinds = ", ".join([*[f"`{k}` {sums.schema[k].dataType.simpleString()}" for k in keys], "n long", "intercept double", *[f"`{f}` double" for f in features], "rmse double"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.triu_indices(size)
        for batch in batches:
            count = batch.num_rows
            xx = np.zeros((count, size, size))
            flat = batch.column("xx").flatten().to_numpy(zero_copy_only=False).reshape(count, entries)
            xx[:, upper[0], upper[1]] = flat
            xx[:, upper[1], upper[0]] = flat
            xy = batch.column("xy").flatten().to_numpy(zero_copy_only=False).reshape(count, size)
            n, yy = xx[:, 0, 0], batch.column("yy").to_numpy(zero_copy_only=False)
            # centred: the intercept's row is taken out first, which keeps digits where means are large
            mean, middle = xx[:, 0, 1:] / n[:, None], xy[:, 0] / n
            cxx = xx[:, 1:, 1:] - n[:, None, None] * mean[:, :, None] * mean[:, None, :] + ridge * np.eye(size - 1)
            cxy = xy[:, 1:] - n[:, None] * mean * middle[:, None]
            cyy = yy - n * middle**2
            weights = np.full((count, size - 1), np.nan)
            for i in range(count):
                scale = np.sqrt(np.maximum(np.diag(cxx[i]), 0))
                if (scale > 0).all() and np.linalg.matrix_rank(cxx[i] / np.outer(scale, scale), tol=1e-9) == size - 1:
                    weights[i] = np.linalg.solve(cxx[i], cxy[i])
            start = middle - (weights * mean).sum(axis=1)
            left = np.maximum(cyy - 2 * (weights * cxy).sum(axis=1) + np.einsum("ki,kij,kj->k", weights, cxx - ridge * np.eye(size - 1), weights), 0)
            columns = [pa.array(start, from_pandas=True), *[pa.array(weights[:, j].copy(), from_pandas=True) for j in range(size - 1)], pa.array(np.sqrt(left / n), from_pandas=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], pa.array(n.astype(np.int64)), *columns], names=[*keys, "n", "intercept", *features, "rmse"])

    return added.mapInArrow(solve, kinds)


def predicted(rows: DataFrame, model: DataFrame, features: Sequence[str], keys: Sequence[str] = (), name: str = "prediction") -> DataFrame:
    """Rows with the model's value; rows without a model or with a missing feature get null."""
    wide = model.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("intercept").alias("__b"), *[F.col(f).alias(f"__w_{f}") for f in features])
    value = F.col("__b")
    for f in features:
        value = value + F.col(f"__w_{f}") * F.col(f)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    joined = rows.join(wide, same, "left") if keys else rows.join(F.broadcast(wide), how="left")  # without keys one row
    return joined.withColumn(name, value).select(*rows.columns, name)
