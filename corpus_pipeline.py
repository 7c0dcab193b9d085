"""Training corpus from raw documents: quality, near copies, personal data, source mix, token sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import jaccard, mixing, packing, pii, quality
from lakeloom.llm.words import small_batches
from lakeloom.session import materialize

ROWS, DEFAULT_ROWS = "spark.sql.parquet.columnarReaderBatchSize", "4096"


def _small_buffers(spark: SparkSession) -> None:
    """Texts go to Python in batches of 1 MB, and Parquet is decoded 512 rows at a time: with whole stages in one session,
    buffers of many MB leave gaps in an executor's heap and native memory that later stages don't get back. Sizes that
    the session sets itself stay."""
    small_batches(spark, 1 << 20)
    if spark.conf.get(ROWS) == DEFAULT_ROWS:
        spark.conf.set(ROWS, "512")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps; the others go. Null texts are empty and rows that repeat an id share their
    noise; an empty table gives no rows; other columns stay as they are."""
    _small_buffers(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.resample(docs, labels)[0]


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have in any case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; rows that repeat an id stay or go together, rows
    without an id stay."""
    _small_buffers(spark)
    found = jaccard.jaccard_components(docs)
    key = _free(docs, "gone")
    gone = materialize(found.where("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct(), "near-copies")
    return docs.join(gone, F.col("doc_id") == F.col(key), "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the new text. Null texts stay null, every row and column
    stays, an empty table gives no rows."""
    _small_buffers(spark)
    return pii.masked(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes its words, to the nearest whole number; documents whose words the
    mixture doesn't take go, and so do those without words. Rows that repeat an id share what they give."""
    _small_buffers(spark)
    key, copies, copy = (_free(docs, name) for name in ("key", "copies", "copy"))
    share = mixing.mix(mixing.sized(docs))[1].groupBy("doc_id").agg(F.try_divide(F.sum("taken"), F.sum("size")).alias("share"))
    taken = share.select(F.col("doc_id").alias(key), F.round("share").cast("int").alias(copies)).where(F.col(copies) > 0)
    rows = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(key)))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids. Null texts are empty, repeated rows are packed each, columns other
    than ``doc_id`` and ``text`` don't matter, an empty table gives no rows."""
    _small_buffers(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json")).drop("copy")


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("personal data", mask_personal_data),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]

#: Resampling, the field and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
