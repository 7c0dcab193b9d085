"""Words of whole texts as integer arrays, batch by batch."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

MIX = np.uint64(0x9E3779B97F4A7C15)


BATCH, DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def small_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Let Spark hand texts to Python workers in Arrow batches of ``size`` bytes, as it keeps several copies of a batch; a
    size that the session sets itself stays."""
    if spark.conf.get(BATCH) == DEFAULT:
        spark.conf.set(BATCH, f"{size}b")


def release() -> None:
    """Give freed memory back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches, column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``most_bytes`` per piece (one long text may exceed it)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if total and total + n > most_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)
    release()


def split(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text, flattened, and the offsets of each text in them. Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    flat = pc.list_flatten(lists)
    if lower:  # of a slice of texts, ascii_lower reads beyond the end; the words are an array of their own
        flat = pc.ascii_lower(flat)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.equal(flat, "")
    if pc.any(blank).as_py():
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        gone = np.concatenate([[0], np.cumsum(blank.to_numpy(zero_copy_only=False).astype(np.int64))])
        offsets = offsets - gone[offsets]
        return flat.filter(pc.invert(blank)), offsets
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word; every distinct word is hashed once."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    keys = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    return keys.astype(np.uint64)[coded.indices.to_numpy(zero_copy_only=False)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(keys: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of ``n`` keys."""
    if len(keys) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(keys) - n + 1, n, np.uint64)
    for i in range(n):
        out = out * MIX + keys[i : len(keys) - n + 1 + i]
    return mixed(out)
