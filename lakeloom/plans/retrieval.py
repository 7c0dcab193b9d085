"""Chunking, embedding, similarity search and enrichment over the supplied texts and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import balls as B
from lakeloom.operators import text as X
from lakeloom.operators import vectors as V
from lakeloom.operators.columns import explode_list
from lakeloom.operators.joins import broadcast_small
from lakeloom.operators.rows import sample_rows
from lakeloom.plans.registry import Tables, hash_sql, near_all, near_sql, query
from lakeloom.session import scratch_path
from lakeloom.sources import files

DIM = 64


@query("chunk_fixed", """
SELECT doc_id, CAST(i AS INTEGER) AS chunk_index, substr(text, CAST(i * 810 + 1 AS BIGINT), 900) AS chunk
FROM documents, unnest(range(0, CAST(floor(greatest(length(text) - 91, 0) / 810) AS BIGINT) + 1)) AS u(i) WHERE length(text) > 0""")
def chunk_fixed(t: Tables) -> DataFrame:
    return X.chunk_fixed(t.documents.select("doc_id", "text"), "text", ["doc_id"])


@query("chunk_recursive")
def chunk_recursive(t: Tables) -> DataFrame:
    return X.chunk_documents(t.documents, "text", "doc_id", metadata=["lang", "source"])


@query("chunk_coverage", """
SELECT doc_id, CAST(length(regexp_replace(text, '\\s', '', 'g')) AS BIGINT) AS n FROM documents WHERE length(trim(text)) > 0""")
def chunk_coverage(t: Tables) -> DataFrame:
    """Chunks without overlap hold every visible character of a document once."""
    chunks = X.chunk_documents(t.documents, "text", "doc_id", 900, 0, metadata=["doc_id"])
    visible = F.length(F.regexp_replace("chunk", r"\s", "")).cast("long")
    return chunks.groupBy("doc_id").agg(F.sum(visible).alias("n"))


@query("keyword_documents", """
SELECT p_partkey AS page, string_split(p_name, ' ')[i] AS keyword
FROM part, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS u(i)""")
def keyword_documents(t: Tables) -> DataFrame:
    listed = t.part.select(F.col("p_partkey").alias("page"), F.translate("p_name", " ", ",").alias("keywords"))
    return explode_list(listed, "keywords", ",", "keyword")


@query("embed_hash")
def embed_hash(t: Tables) -> DataFrame:
    """A vector for every document, from its whole text."""
    return V.embed(t.documents.select("doc_id", "text"), "text").drop("text")


CENTROID_SQL = f"""
c AS (SELECT label, list(m ORDER BY d) AS q FROM (
        SELECT label, d, avg(CAST(embedding[d] AS DOUBLE)) AS m FROM embeddings, (SELECT unnest(range(1, {DIM + 1})) AS d) GROUP BY label, d) GROUP BY label)"""


def label_centroids(t: Tables) -> DataFrame:
    return V.centroids(t.embeddings, "label", "embedding", DIM)


@query("knn_l2", f"""
WITH {CENTROID_SQL},
r AS (SELECT c.label, vec_id, list_distance(CAST(embedding AS DOUBLE[]), q) AS distance FROM embeddings, c)
SELECT CAST(label AS BIGINT) AS label, vec_id, {near_sql('distance')} AS distance, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY distance, vec_id) AS rn FROM r) WHERE rn <= 4""")
def knn_l2(t: Tables) -> DataFrame:
    """The four vectors nearest to the mean vector of every label, searched over the whole table."""
    found = V.knn_l2(t.embeddings, label_centroids(t), 4, "vec_id", "label")
    return near_all(found)


@query("recall_at_1", f"""
WITH {CENTROID_SQL},
r AS (SELECT c.label AS truth, e.label AS found, row_number() OVER (PARTITION BY c.label ORDER BY list_distance(CAST(embedding AS DOUBLE[]), q), vec_id) AS rn FROM embeddings e, c)
SELECT count(*) AS n_queries, {near_sql('avg(CASE WHEN truth = found THEN 1.0e0 ELSE 0 END)')} AS accuracy FROM r WHERE rn = 1""")
def recall_at_1(t: Tables) -> DataFrame:
    """Share of labels whose mean vector finds a vector of the same label first."""
    top = V.knn_l2(t.embeddings, label_centroids(t), 1, "vec_id", "label")
    found = broadcast_small(top).join(t.embeddings.select("vec_id", F.col("label").alias("found")), "vec_id")
    return near_all(V.retrieval_accuracy(found, "found", "label"))


@query("retrieval_accuracy", f"""
WITH q AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * 0.5e0) AS q FROM embeddings ORDER BY {hash_sql('vec_id', seed=3)}, vec_id LIMIT 20),
r AS (SELECT q.vec_id AS truth, e.vec_id AS found, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(CAST(e.embedding AS DOUBLE[]), q.q), e.vec_id) AS rn FROM embeddings e, q)
SELECT count(*) AS n_queries, {near_sql('avg(CASE WHEN truth = found THEN 1.0e0 ELSE 0 END)')} AS accuracy FROM r WHERE rn = 1""")
def retrieval_accuracy(t: Tables) -> DataFrame:
    """Twenty sampled vectors, shrunk to half length, looked up again: how often the right one comes first."""
    sampled = sample_rows(t.embeddings, ["vec_id"], 20, 3)
    queries = sampled.select(F.col("vec_id").alias("truth"), F.transform("embedding", lambda x: x.cast("double") * 0.5).alias("embedding"))
    top = V.knn_l2(t.embeddings, queries, 1, "vec_id", "truth")
    return near_all(V.retrieval_accuracy(top, "vec_id", "truth"))


@query("retrieval_accuracy_all", f"""
WITH r AS (SELECT q.vec_id AS truth, e.vec_id AS found, row_number() OVER (PARTITION BY q.vec_id
  ORDER BY list_distance(CAST(e.embedding AS DOUBLE[]), list_transform(CAST(q.embedding AS DOUBLE[]), lambda x: x * 0.5e0)), e.vec_id) AS rn FROM embeddings e, embeddings q)
SELECT count(*) AS n_queries, {near_sql('avg(CASE WHEN truth = found THEN 1.0e0 ELSE 0 END)')} AS accuracy FROM r WHERE rn = 1""")
def retrieval_accuracy_all(t: Tables) -> DataFrame:
    """The same for every vector of the table."""
    queries = t.embeddings.select(F.col("vec_id").alias("truth"), F.transform("embedding", lambda x: x.cast("double") * 0.5).alias("embedding"))
    top = V.knn_l2(t.embeddings, queries, 1, "vec_id", "truth")
    return near_all(V.retrieval_accuracy(top, "vec_id", "truth"))


KNN_ALL_SQL = f"""
WITH r AS (SELECT q.vec_id AS query_id, e.vec_id, list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS distance FROM embeddings e, embeddings q)
SELECT query_id, vec_id, {near_sql('distance')} AS distance, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rn FROM r) WHERE rn <= 4"""


@query("knn_all", KNN_ALL_SQL)
def knn_all(t: Tables) -> DataFrame:
    """The four nearest vectors of every vector, in several blocks of queries."""
    queries = t.embeddings.select(F.col("vec_id").alias("query_id"), "embedding")
    return near_all(V.knn_l2(t.embeddings, queries, 4, "vec_id", "query_id", block=128))


@query("knn_pruned", KNN_ALL_SQL)
def knn_pruned(t: Tables) -> DataFrame:
    """The same, from the cells of vectors that a query's bound can't rule out."""
    queries = t.embeddings.select(F.col("vec_id").alias("query_id"), "embedding")
    return near_all(B.knn_pruned(t.embeddings, queries, 4, "vec_id", "query_id"))


@query("cosine_topk", f"""
WITH {CENTROID_SQL},
s AS (SELECT e.label, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) AS similarity FROM embeddings e JOIN c ON e.label = c.label)
SELECT label, vec_id, {near_sql('similarity')} AS similarity, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id) AS rn FROM s WHERE similarity >= 0.3) WHERE rn <= 5""")
def cosine_topk(t: Tables) -> DataFrame:
    """The five vectors of each label most similar to the label's mean."""
    queries = label_centroids(t).withColumnRenamed("embedding", "query_embedding")
    return near_all(V.cosine_topk(t.embeddings, queries, "label", "vec_id", threshold=0.3))


@query("updated_keywords", f"""
WITH {CENTROID_SQL},
s AS (SELECT e.label, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) AS similarity FROM embeddings e JOIN c ON e.label = c.label),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id) AS rn FROM s WHERE similarity >= 0.3)
SELECT label, string_agg('v' || vec_id, ',' ORDER BY rn) AS updated_keywords FROM r WHERE rn <= 5 GROUP BY label""")
def updated_keywords(t: Tables) -> DataFrame:
    queries = label_centroids(t).withColumnRenamed("embedding", "query_embedding")
    top = V.cosine_topk(t.embeddings, queries, "label", "vec_id", threshold=0.3)
    return V.joined_keywords(top.withColumn("word", F.concat(F.lit("v"), "vec_id")), "label", "word")


@query("enrich_rows", """
SELECT page_id, language, CASE WHEN page_id % 10 = 7 THEN 'no answer' ELSE language || ':' || upper(split_part(url, '/', 3)) END AS answer,
       CASE WHEN page_id % 10 = 7 THEN 'ValueError: refused' END AS error
FROM pages, (SELECT unnest(['de', 'fr', 'pl']) AS language)""")
def enrich_rows(t: Tables) -> DataFrame:
    """Each page in three languages through a function that sometimes fails."""

    def answer(page_id: int, url: str, language: str) -> str:
        if page_id % 10 == 7:
            raise ValueError("refused")
        return f"{language}:{url.split('/')[2].upper()}"

    rows = t.pages.select("page_id", "url", F.explode(F.array(*[F.lit(v) for v in ("de", "fr", "pl")])).alias("language"))
    return X.enrich(rows, ["page_id", "url", "language"], answer, on_error="no answer").drop("url")


ANSWER = ("id", "product", "usage", "pros", "cons", "recommendation")


def answer_lines(t: Tables) -> DataFrame:
    """Answers as delimited lines, some short and some with too many parts."""
    text = F.concat_ws(";", F.col("p_partkey").cast("string"), "p_name", "p_type", "p_brand")
    k = F.col("p_partkey") % 10
    line = F.when(k == 0, F.concat(text, F.lit(";x;y;z"))).when(k < 6, F.concat(text, F.lit(";none;yes"))).otherwise(text)
    return t.part.select(line.alias("value"))


@query("scan_lines_split", """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS product, p_type AS usage, p_brand AS pros, CASE WHEN p_partkey % 10 < 6 THEN 'none' END AS cons,
       CASE WHEN p_partkey % 10 < 6 THEN 'yes' END AS recommendation FROM part WHERE p_partkey % 10 > 0""")
def scan_lines_split(t: Tables) -> DataFrame:
    """Lines written to text files and split back into six columns."""
    path = scratch_path(t.spark, "lines")
    answer_lines(t).write.text(path)
    good, _ = X.split_answer_lines(files.scan_lines(t.spark, path), ANSWER)
    return good


@query("rejected_lines", "SELECT p_partkey || ';' || p_name || ';' || p_type || ';' || p_brand || ';x;y;z' AS value FROM part WHERE p_partkey % 10 = 0")
def rejected_lines(t: Tables) -> DataFrame:
    return X.split_answer_lines(answer_lines(t), ANSWER)[1]


@query("merge_responses", """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_retailprice AS price, CASE WHEN p_partkey % 10 > 0 THEN p_name END AS product FROM part""")
def merge_responses(t: Tables) -> DataFrame:
    good, _ = X.split_answer_lines(answer_lines(t), ANSWER)
    # lines with too many parts gave no answer, so those originals stay without one
    originals = t.part.select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"))
    return X.merge_responses(good.select("id", "product"), originals, "id")
