"""Registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import ann, htmltext, jaccard, licenses, mixing, negatives, packing, phrases, pii, quality, urls, vafile, warc
from lakeloom.llm.words import small_batches
from lakeloom.session import scratch_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_tree_neighbours")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Five nearest rows by cosine through the k-means tree."""
    return ann.tree_search(table(spark, folder, "embeddings"))


@query("op3_mix_sources")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Words each document gives to the mixture."""
    return mixing.mix(mixing.sized(table(spark, folder, "documents")))[1]


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op7_va_top_k", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Five largest integer inner products, exactly."""
    return vafile.top_k(table(spark, folder, "embeddings"))


OP10_SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), r(rule, verdict) AS (
  VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')
), m AS (
  SELECT page_id, host, path, (
    SELECT max(struct_pack(n := length(rule), rule := rule, verdict := verdict)) FROM r
    WHERE ('.' || host) LIKE ('%.' || split_part(rule, '/', 1)) AND starts_with(path, substr(rule, instr(rule, '/')))
  ) AS best FROM u
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM m
"""


@query("op10_bloom_cascade", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every url by the rules of the query."""
    rules = spark.createDataFrame([(k, v) for v, k in urls.RULES], "key string, verdict string")
    return urls.judge(table(spark, folder, "pages"), rules)


OP2_SQL = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""


@query("op2_warc_round_trip", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all pages as read back from the archives."""
    place = scratch_path(spark, "warc")
    return warc.read_warc(spark, warc.write_warc(table(spark, folder, "pages"), place), place).drop("url")


@query("op6_pack_sequences")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids."""
    docs = table(spark, folder, "documents")
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json")).drop("copy")


@query("op8_resample_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that importance resampling keeps, with their weights."""
    kept = quality.resample(table(spark, folder, "documents"), table(spark, folder, "labels"))[1]
    return kept.select("doc_id", "log_weight")


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), t AS MATERIALIZED (SELECT doc_id, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM t a JOIN t b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b WHERE 100 * i >= 75 * (len(sa.s) + len(sb.s) - i)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT s.doc_id, CAST(any_value(len(s.s)) AS BIGINT) AS n_shingles, min(r.c) AS component_id FROM s JOIN r USING (doc_id) GROUP BY s.doc_id
"""


@query("op5_jaccard_join", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Shingle counts and components of near copies."""
    return jaccard.jaccard_components(table(spark, folder, "documents"))


@query("op9_host_suffix_text")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, folder, "pages"))


@query("op4_crf_personal_data")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return pii.detect(table(spark, folder, "documents"))


def _license_sql(threshold: float = 0.85) -> str:
    """Every block against every template."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    known = [licenses.Template(label, text, threshold) for label, text in licenses.TEMPLATES]
    templates = ", ".join(f"('{t.label}', {t.step}, {t.needed}, {quoted(t.tokens)})" for t in known)
    phrases_ = ", ".join(f"({quoted(p.split())}, '{label}')" for p, label in licenses.PHRASES)
    return rf"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), p(phrase, label) AS (VALUES {phrases_}), t(label, step, needed, tokens) AS (VALUES {templates}),
s AS (SELECT row, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1:i + len(phrase)] = phrase)) AS place FROM w, p),
n AS (SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word FROM s GROUP BY row),
b AS (
  SELECT row, step, list_distinct(w[i * step + 1:i * step + 2 * step]) AS b
  FROM (SELECT row, w, step, unnest(range(0, greatest(CAST(ceil(len(w) / step) AS BIGINT) - 1, 1))) AS i FROM w, (SELECT DISTINCT step FROM t))
), m AS (
  SELECT row, label, len(list_intersect(b, tokens)) / len(tokens) AS c FROM b JOIN t USING (step) WHERE len(list_intersect(b, tokens)) >= needed
), o AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM s GROUP BY row),
l AS (SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT row, label FROM s UNION SELECT row, label FROM m) GROUP BY row),
c AS (SELECT row, max(c) AS score FROM m GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM w LEFT JOIN n USING (row) LEFT JOIN o USING (row) LEFT JOIN l USING (row) LEFT JOIN c USING (row)
"""


@query("op11_license_scan", _license_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """License labels of every document."""
    return licenses.scan(table(spark, folder, "documents"))


OP12_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(list_zip(a.x, c.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), t AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM p WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM t JOIN p USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""


@query("op12_sorted_negatives", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    return negatives.hard_negatives(table(spark, folder, "embeddings"))


OP13_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
g AS MATERIALIZED (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
n AS (SELECT lang, count(*) AS n FROM g GROUP BY lang),
u AS MATERIALIZED (SELECT lang, x, count(*) AS f FROM g GROUP BY ALL),
b AS MATERIALIZED (SELECT lang, x, y, count(*) AS f FROM g WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
t AS MATERIALIZED (SELECT lang, x, y, z, count(*) AS f FROM g WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
o AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM t UNION ALL SELECT lang, y, z, f FROM t) GROUP BY ALL),
two AS (
  SELECT b.lang, b.x || ' ' || b.y AS phrase, b.f AS a, l.f AS l, r.f AS r, (1000000::HUGEINT * b.f * b.f) // (l.f::HUGEINT * r.f) AS score
  FROM b JOIN u l ON l.lang = b.lang AND l.x = b.x JOIN u r ON r.lang = b.lang AND r.x = b.y
  LEFT JOIN o ON o.lang = b.lang AND o.x = b.x AND o.y = b.y WHERE 100 * coalesce(o.f, 0) < 50 * b.f
), three AS (
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.f AS a, ux.f AS l1, byz.f AS r1, bxy.f AS l2, uz.f AS r2,
    (1000000::HUGEINT * t.f * t.f) // (ux.f::HUGEINT * byz.f) AS s1, (1000000::HUGEINT * t.f * t.f) // (bxy.f::HUGEINT * uz.f) AS s2
  FROM t JOIN u ux ON ux.lang = t.lang AND ux.x = t.x JOIN u uz ON uz.lang = t.lang AND uz.x = t.z
  JOIN b bxy ON bxy.lang = t.lang AND bxy.x = t.x AND bxy.y = t.y JOIN b byz ON byz.lang = t.lang AND byz.x = t.y AND byz.y = t.z
), c AS (
  SELECT * FROM two UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM three
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM c JOIN n USING (lang) QUALIFY rank <= 2000
"""


@query("op13_stripe_phrases", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Collocations of two and three words of each language."""
    return phrases.collocations(table(spark, folder, "documents"))
