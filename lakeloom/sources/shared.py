"""Files of the shared folder as tasks read them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder as Spark names it (``file:``, ``hdfs:``, ``s3a:`` or a plain path)."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def parquet_blocks(path: str, columns: Sequence[str], most: int) -> Iterator[pa.RecordBatch]:
    """Rows of a Parquet folder in blocks of at most ``most``, read in the task that asks for them."""
    store, top = place(path)
    found = store.get_file_info(fs.FileSelector(top, recursive=True))
    for name in sorted(f.path for f in found if f.is_file and f.path.endswith(".parquet")):
        with store.open_input_file(name) as f:
            yield from pq.ParquetFile(f).iter_batches(most, columns=list(columns))
