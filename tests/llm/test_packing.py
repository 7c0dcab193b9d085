"""Tokens and sequences against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, normalizers

from lakeloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, start int, length string, ids int, sequence_id int"


def plain(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.sampled_from(["<|endoftext|> x", "<|ENDOFTEXT|>", "a'S b's!!", "É.é.", "é. x́!", "x≮ y", "İ İ.", "a b c", "don't!!! it's,,, 's", "12,345.6", "ſs K.", "a|>", "hi.\x1cyo"])), min_size=1, max_size=5))
def test_ids_are_the_tokenizers(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, bounds = packing.token_ids(pa.array(texts), packing.Words(PATH))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [plain(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.text(packing.LETTERS + ".\u0301×÷İ'A9", min_size=1, max_size=30), max_size=20).map(" ".join), min_size=1, max_size=4))
def test_simple_words_are_the_tokenizers(texts):
    ids, bounds = packing.token_ids(pa.array(texts), packing.Words(PATH))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [plain(t) for t in texts]


def test_simple_words_pass_by_the_regular_expressions():
    words = packing.Words(PATH)
    names = [f"{a}{b}straße" for a in "abc" for b in packing.LETTERS]
    ids, _ = packing.token_ids(pa.array([" ".join(names) + " x9"]), words)
    assert ids.tolist() == plain(" ".join(names) + " x9") and list(words.young) == ["x9"] and not words.old


def test_other_tokenizers_keep_their_expressions(tmp_path):
    other = Tokenizer.from_file(PATH)
    other.normalizer = normalizers.Sequence([normalizers.NFD(), normalizers.StripAccents(), normalizers.Lowercase()])
    other.save(str(tmp_path / "other.json"))
    words = packing.Words(str(tmp_path / "other.json"))
    ids, _ = packing.token_ids(pa.array(["élan vital à côté"]), words)
    assert words.merges is None and ids.tolist() == [*other.encode("élan vital à côté", add_special_tokens=False).ids, 2]


def test_cache_may_overflow():
    words = packing.Words(PATH, 5)
    text = " ".join(f"w{i}!? v{i}" for i in range(300))
    ids, _ = packing.token_ids(pa.array([text, text]), words)
    assert ids.tolist() == plain(text) * 2


def test_cache_is_bounded():
    words = packing.Words(PATH, 40_000)
    for i in range(0, 3_000, 100):
        names = [f"v{j}" for j in range(i, i + 100)]
        assert words.ids(names) == words.ids(names)
    assert len(words.young) + len(words.old) <= 40_000 // packing.ENTRY + 200


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=40))
def test_first_fit_decreasing(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, offsets, used = packing.first_fit(np.array(lengths, np.int64), 16)
    room = []
    for i, n in enumerate(lengths):
        at = next((b for b, r in enumerate(room) if r >= n), None)
        if at is None:
            room.append(16)
            at = len(room) - 1
        assert (bins[i], offsets[i]) == (at, 16 - room[at])
        room[at] -= n
    assert used == len(room)


def test_pieces_fill_sequences(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(["one", "two,", "Three!", "vier"], rng.integers(1, 120))), 0, "", 0, 0) for i in range(300)]
    rows += [(900, None, 0, "", 0, 0), (901, "", 0, "", 0, 0), (902, "long " * 5_000, 0, "", 0, 0), (None, "no id", 0, "", 0, 0)] + [(903, "twice the same", 0, "", 0, 0)] * 2
    found = packing.packed(spark.createDataFrame(rows, SCHEMA), PATH, 256, with_ids=True)
    got = found.collect()
    texts = {r[0]: r[1] for r in rows}
    by_doc = {}
    for r in got:
        ids = plain(texts[r["doc_id"]])
        piece = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert piece == bytes(r["ids"]) and zlib.crc32(piece) == r["ids_crc32"] and len(ids) == r["doc_tokens"]
        by_doc.setdefault((r["doc_id"], r["copy"]), []).append((r["start"], r["length"]))
    assert len(by_doc) >= len(texts)
    assert sum(r["length"] for r in got) == sum(len(plain(t)) for _, t, *_ in rows)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    total = sum(r["length"] for r in got)
    assert len(sequences) <= total // 256 + 2
    whole = packing.sequences(found, 256).collect()
    assert len(whole) == len(sequences)
    for r in whole:
        n = sum(x for _, x in sequences[r["sequence_id"]])
        assert len(r["ids"]) == (n if n & (n - 1) == 0 else 256)


@pytest.mark.parametrize("group", [1, 7])
def test_groups(spark, group):
    pieces = spark.createDataFrame([(i % 3, 0, 1 + i % 9, 0, 9, i) for i in range(50)], "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, copy long")
    got = packing.pack(pieces, 9, group).collect()
    assert len(got) == 50 and len({(r["sequence_id"], r["offset"]) for r in got}) == 50


def test_empty(spark):
    assert packing.packed(spark.createDataFrame([], SCHEMA), PATH).collect() == []
