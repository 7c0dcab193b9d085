import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import text as X
from lakeloom.operators import vectors as V


def got(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def test_split_prefers_coarse_separators():
    assert X.split_recursive("aaa\n\nbbb\n\nccc", 7, 0) == ["aaa", "bbb", "ccc"]
    assert X.split_recursive("aaa\n\nbbb", 20, 0) == ["aaa\n\nbbb"]
    assert X.split_recursive("one two three four", 9, 0) == ["one two", "three", "four"]
    assert X.split_recursive("one two six ten", 12, 4) == ["one two six", "six ten"]
    assert X.split_recursive("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]
    assert X.split_recursive("", 4, 1) == []


def test_split_invariants():
    rng = random.Random(2)
    for _ in range(60):
        # numbered words, so that a chunk is found in one place only
        text = "".join(rng.choice([f"w{i}é ", f"x{i}", "\n", "\n\n", f"longerword{i} "]) for i in range(rng.randrange(1, 400)))
        size, overlap = rng.choice([(40, 0), (40, 10), (90, 30)])
        chunks = X.split_recursive(text, size, overlap)
        assert all(0 < len(c) <= size for c in chunks)
        at = 0
        for c in chunks:  # chunks come in order, and all but white space is covered
            found = text.find(c)
            assert found >= 0
            assert not text[at:found].strip()
            at = max(at, found + len(c))
        assert not text[at:].strip()


def test_chunk_documents(make):
    df = make("id string, text string, lang string", ("a.md", "word " * 400, "en"), ("b.md", None, "fr"), ("c.md", "short", "de"))
    out = X.chunk_documents(df, "text", "id", metadata=["lang"])
    rows = got(out.orderBy("id"))
    assert [r[0] for r in rows] == ["a.md/0/pl", "a.md/1/pl", "a.md/2/pl", "c.md/0/pl"]
    assert rows[-1][1:] == ("de", 0, "short")
    with pytest.raises(ValueError):
        X.chunk_documents(df, "text", "id", 10, 10)


def test_chunk_fixed_covers_the_text(make):
    text = "".join(chr(97 + i % 26) for i in range(2500))
    chunks = [r[2] for r in got(X.chunk_fixed(make("d int, t string", (1, text), (2, "")), "t", ["d"], 900, 90).orderBy("chunk_index"))]
    assert chunks[0] + "".join(c[90:] for c in chunks[1:]) == text


def test_enrich_keeps_going(make):
    df = make("i int", (0,), (1,), (2,))
    rows = sorted(got(X.enrich(df, ["i"], lambda i: str(10 // i), on_error="none")))
    assert rows == [(0, "none", "ZeroDivisionError: integer division or modulo by zero"), (1, "10", None), (2, "5", None)]


def test_answers(make):
    names = ["id", "product", "usage", "pros", "cons", "recommendation"]
    lines = make("value string", (" 1;product_1;usage_1;pros_1;cons_1;recommend_1\n",), ("2; p",), ("3;a;b;c;d;e;f",))
    good, bad = X.split_answer_lines(lines, names)
    assert got(good) == [("1", "product_1", "usage_1", "pros_1", "cons_1", "recommend_1"), ("2", " p", None, None, None, None)]
    assert got(bad) == [("3;a;b;c;d;e;f",)]
    merged = X.merge_responses(good.select("id", "product"), make("id int, video string", (1, "v1"), (9, "v9")), "id")
    assert sorted(got(merged), key=str) == [("1", "v1", "product_1"), ("9", "v9", None)]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(700, 8)).astype(np.float32)
    data[10] = data[20]  # a tie
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, page int").cache()


def brute(vectors, queries, k):
    data = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in vectors.collect()}
    out = set()
    for q in queries.collect():
        near = sorted((float(np.sqrt(((v - np.array(q["embedding"], dtype=float)) ** 2).sum())), i) for i, v in data.items())[:k]
        out |= {(q["q"], i, n + 1) for n, (_, i) in enumerate(near)}
    return out


@pytest.mark.parametrize("block", [2048, 4])
def test_knn_is_exact(vectors, block):
    queries = vectors.filter("vec_id % 70 = 10").select(F.col("vec_id").alias("q"), "embedding")
    out = V.knn_l2(vectors.repartition(5), queries, 3, "vec_id", "q", block=block)
    assert {(r["q"], r["vec_id"], r["rank"]) for r in out.collect()} == brute(vectors, queries, 3)


def test_knn_with_fewer_vectors_than_k(vectors):
    two = vectors.filter("vec_id < 2")
    out = V.knn_l2(two, two.select(F.col("vec_id").alias("q"), "embedding"), 5, "vec_id", "q")
    assert out.count() == 4
    with pytest.raises(ValueError):
        V.knn_l2(two, two.limit(0).select(F.col("vec_id").alias("q"), "embedding"), 5, "vec_id", "q")


@pytest.mark.parametrize("block", [1, 2, 100])
def test_knn_repeated_and_missing(make, block):
    v = make("vec_id long, embedding array<float>", (1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, None), (4, [6.0, 8.0]))
    q = make("q long, embedding array<double>", (7, [0.0, 0.0]), (7, [6.0, 8.0]), (None, [3.0, 4.0]), (7, [0.0, 0.0]), (8, None))
    out = V.knn_l2(v, q, 2, "vec_id", "q", block=block).collect()
    found = sorted(((r["q"] or 0), r["vec_id"], r["distance"], r["rank"]) for r in out)
    assert found == [(0, 1, 5.0, 2), (0, 2, 0.0, 1), (7, 1, 0.0, 1), (7, 1, 0.0, 1), (7, 2, 5.0, 2), (7, 2, 5.0, 2), (7, 2, 5.0, 2), (7, 4, 0.0, 1)]


def test_cosine_of_missing_vectors(make):
    df = make("a array<float>, b array<float>", ([1.0, 0.0], [2.0, 0.0]), (None, [1.0, 0.0]), ([1.0, 0.0], None), ([0.0, 0.0], [1.0, 1.0]))
    assert got(df.select(V.cosine("a", "b"))) == [(1.0,), (None,), (None,), (None,)]


def test_cosine_topk_stays_on_the_page(vectors):
    queries = vectors.filter("vec_id < 3").select("page", F.col("embedding").alias("query_embedding"))
    rows = V.cosine_topk(vectors, queries, "page", "vec_id", threshold=0.5, k=4).collect()
    data = vectors.collect()
    for page in range(3):
        q = np.array(data[page]["embedding"], dtype=float)
        sims = []
        for r in data:
            v = np.array(r["embedding"], dtype=float)
            s = float(v @ q / np.sqrt((v @ v) * (q @ q)))
            if r["page"] == page and s >= 0.5:
                sims.append((-s, r["vec_id"]))
        want = [i for _, i in sorted(sims)[:4]]
        assert [r["vec_id"] for r in sorted((r for r in rows if r["page"] == page), key=lambda r: r["rank"])] == want


def test_zero_vector_has_no_similarity(make):
    df = make("a array<float>, b array<float>", ([0.0, 0.0], [1.0, 0.0]), ([2.0, 0.0], [1.0, 0.0]))
    assert got(df.select(V.cosine("a", "b"))) == [(None,), (1.0,)]


def test_keywords_and_accuracy(make):
    top = make("page int, rank int, w string", (1, 2, "b"), (1, 1, "a"), (2, 1, "c"))
    assert sorted(got(V.joined_keywords(top, "page", "w"))) == [(1, "a,b"), (2, "c")]
    assert got(V.retrieval_accuracy(make("f int, t int", (1, 1), (2, 3)), "f", "t")) == [(2, 0.5)]


def test_embed_batches(make):
    def call(texts):
        assert len(texts) <= 2
        return [[float(len(t)), 0.0] for t in texts]

    rows = got(V.embed(make("t string", ("a",), ("bb",), ("ccc",)).coalesce(1), "t", call=call, batch=2))
    assert rows == [("a", [1.0, 0.0]), ("bb", [2.0, 0.0]), ("ccc", [3.0, 0.0])]
    unit = np.array(V.hashed_embedding("some words here", 16))
    assert np.isclose((unit * unit).sum(), 1) and V.hashed_embedding("", 4) == [0.0] * 4


def test_centroids(make):
    out = V.centroids(make("g int, v array<float>", (1, [1.0, 2.0]), (1, [3.0, 4.0])), "g", "v", 2)
    assert got(out) == [(1, [2.0, 3.0])]
