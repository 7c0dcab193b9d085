"""Document chunking, list documents, external enrichment and answer merging."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: where a text may be cut, from coarse to fine
SEPARATORS = ("\n\n", "\n", " ", "")


def split_recursive(text: str, size: int = 900, overlap: int = 90, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Chunks of at most ``size`` characters, cut at the coarsest separator that gives small enough parts.

    Neighbouring chunks share up to ``overlap`` characters, made of whole parts.
    """
    level = next((i for i, s in enumerate(separators) if not s or s in text), len(separators) - 1)
    mark, finer = separators[level], separators[level + 1:]
    if mark:
        head, *rest = text.split(mark)
        parts = [p for p in [head, *(mark + r for r in rest)] if p]
    else:
        parts = list(text)
    chunks: list[str] = []
    window: list[str] = []
    length = 0

    def close() -> None:
        chunk = "".join(window).strip()
        if chunk:
            chunks.append(chunk)

    for part in parts:
        if len(part) >= size and mark:
            # a part too large for one chunk ends the current one and is cut on its own
            if window:
                close()
                window, length = [], 0
            chunks.extend(split_recursive(part, size, overlap, finer) if finer else [part])
            continue
        if window and length + len(part) > size:
            close()
            drop = 0
            while length > overlap or (length > 0 and length + len(part) > size):
                length -= len(window[drop])
                drop += 1
            window = window[drop:]
        window.append(part)
        length += len(part)
    if window:
        close()
    return chunks


def chunk_documents(
    df: DataFrame, text: str, source: str, size: int = 900, overlap: int = 90, metadata: Sequence[str] = ()
) -> DataFrame:
    """One row per chunk: ``id`` = ``{source}/{index}/pl``, ``chunk_index``, ``chunk`` and copied metadata.

    Each row is cut on its own, so Spark spreads documents over tasks; the whole text is read.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than the chunk size")

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_recursive(t, size, overlap) if t else [])

    pieces = df.select(F.col(source).cast("string").alias("__src"), *metadata, F.posexplode(cut(text)).alias("chunk_index", "chunk"))
    return pieces.select(
        F.format_string("%s/%d/pl", "__src", "chunk_index").alias("id"), *metadata, "chunk_index", "chunk"
    )


def chunk_fixed(df: DataFrame, text: str, keep: Sequence[str], size: int = 900, overlap: int = 90) -> DataFrame:
    """Fixed windows of ``size`` characters every ``size - overlap``, evaluated in the JVM."""
    step = size - overlap
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1 - overlap, F.lit(0)), F.lit(step))
    at = df.filter(F.length(text) > 0).select(*keep, text, F.posexplode(starts).alias("chunk_index", "__at"))
    return at.select(*keep, "chunk_index", F.substring(F.col(text), F.col("__at") + 1, F.lit(size)).alias("chunk"))


def enrich(
    df: DataFrame, columns: Sequence[str], call: Callable[..., str | None], name: str = "answer",
    on_error: str | None = None,
) -> DataFrame:
    """Call a function per row inside the tasks; a failing row gets ``on_error`` and its message.

    The function is shipped to the executors and may call an outside service. Rows stay in Arrow batches.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType()), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers, errors = [], []
            for values in zip(*[batch[c] for c in columns]):
                try:
                    answers.append(call(*values))
                    errors.append(None)
                except Exception as problem:  # one bad row must not end the job
                    answers.append(on_error)
                    errors.append(f"{type(problem).__name__}: {problem}")
            yield batch.assign(**{name: pd.Series(answers, index=batch.index, dtype=object),
                                  "error": pd.Series(errors, index=batch.index, dtype=object)})

    return df.mapInPandas(run, schema)


def split_answer_lines(lines: DataFrame, names: Sequence[str], delimiter: str = ";", column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Delimited lines to named columns (short lines pad with NULL) and, apart, lines with too many parts.

    White space is cut off the line's ends only.
    """
    parts = F.split(F.regexp_replace(column, r"(?U)^\s+|\s+$", ""), re.escape(delimiter), -1)
    cut = lines.withColumn("__p", parts)
    good = cut.filter(F.size("__p") <= len(names)).select(
        *[F.try_element_at(F.col("__p"), F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    )
    return good, cut.filter(F.size("__p") > len(names)).select(column)


def merge_responses(answers: DataFrame, originals: DataFrame, key: str) -> DataFrame:
    """Originals with their answers; originals without an answer stay. Keys compare as text."""
    return originals.withColumn(key, F.col(key).cast("string")).join(answers, key, "left")
