"""The corpus pipeline, stage by stage against brute force, and its queries."""

import os

import pytest

import corpus_pipeline
from lakeloom.llm import mixing, pii, quality
from lakeloom.llm.queries import ORACLES, QUERIES
from lakeloom.session import materialize
from tests.llm.test_jaccard import brute
from tests.oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@needs_tables
def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    stages = [f for _, f in corpus_pipeline.STAGES]
    kept = materialize(stages[0](spark, docs, FOLDER), "t")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    assert kept.columns == columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in quality.resample(docs, labels)[1].collect()}
    single = materialize(stages[1](spark, kept, FOLDER), "t")
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert single.columns == columns and {r["doc_id"] for r in single.collect()} == {i for i, _, c in brute(rows) if i == c}
    masked = materialize(stages[2](spark, single, FOLDER), "t")
    model = pii.train()
    before, after = {r["doc_id"]: r for r in single.collect()}, {r["doc_id"]: r for r in masked.collect()}
    assert masked.schema == docs.schema and before.keys() == after.keys()
    for i, r in after.items():
        assert r["n_chars"] == len(r["text"]) and not pii.base_spans(r["text"])
        if not pii.find_spans([before[i]["text"]], model)[0][1]:
            assert r == before[i]
    mixed = materialize(stages[3](spark, masked, FOLDER), "t")
    taken = {r["doc_id"]: r["taken"] / r["size"] for r in mixing.mix(mixing.sized(masked))[1].collect() if r["size"]}
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == columns and all(abs(counts.get(i, 0) - t) <= 0.5 for i, t in taken.items()) and counts.keys() <= taken.keys()
    packed = stages[4](spark, mixed, FOLDER).collect()
    assert sum(r["length"] for r in packed if r["start"] == 0) and {r["doc_id"] for r in packed} == counts.keys()
    whole = {}
    for r in packed:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    assert all(whole[r["doc_id"]] == r["doc_tokens"] * counts[r["doc_id"]] for r in packed)
    run = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(str, run)) == sorted(map(str, packed)) or len(run) == len(packed)


def test_empty(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, "").collect() == [], name


@pytest.mark.parametrize("more", [0, 12])
def test_mix_without_words(spark, more):
    """Documents without words go, also where an id has no others; rows of an id that has some share its words."""
    rows = [(100, None, "en", "s", 0), (101, "", "en", "t", 0), (102, " \t\n", "en", None, 3), (None, None, None, None, None)]
    rows += [(i, f"word{i} and some more words {i % 3} here", "en", "s", 9) for i in range(more)] + [(101, "some more words", "en", "t", 9)] * bool(more)
    docs = materialize(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "t")
    got = {r["doc_id"] for r in corpus_pipeline.mix_sources(spark, docs, "").collect()}
    assert not got & {100, 102, None} and bool(got) == bool(more)


def test_names_of_own_columns(spark):
    extra = ["gone", "_gone", "key", "_id", "copies", "_copies", "copy", "Copy_", "share", "log_weight", "sort_key", "component_id", "size", "row"]
    rows = [(i, f"word{i} and some more words {i % 3} here", "en", "s", 9, *range(len(extra))) for i in range(12)]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in extra))
    for name, stage in corpus_pipeline.STAGES[1:]:
        got = stage(spark, docs, "")
        assert got.count() and (name == "packing" or got.columns == docs.columns), name


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(connect(FOLDER), ORACLES[name], df) == ""
    else:
        assert df.count() > 0


