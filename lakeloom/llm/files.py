"""Shared files as tasks see them."""

from __future__ import annotations

from pyarrow import fs


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path for a folder as Spark names it (``file:``, ``hdfs:``, ``s3a:`` or a plain path)."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def listed(path: str, suffix: str) -> list[str]:
    store, at = place(path)
    found = store.get_file_info(fs.FileSelector(at, recursive=True))
    return sorted(f.path for f in found if f.is_file and f.path.endswith(suffix))
