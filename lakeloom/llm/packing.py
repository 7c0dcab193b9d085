"""Token sequences of fixed length: first-fit decreasing with a tournament tree, in randomised groups."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.words import slices, split
from lakeloom.session import materialize

END = 2
#: Bytes of words and their ids that a task keeps.
CACHED = 32 << 20
ENTRY = 200
TOGETHER = 64
#: ASCII marks but the apostrophe between an ASCII letter or digit and white space: the tokenizer always splits before them.
MARKED = r"([A-Za-z0-9])([!-&(-/:-@\[-`{-~]+)([\x20\x09-\x0D]|$)"
#: Lower-case letters that no normal form changes or joins; words of them only are one piece to the tokenizer.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SIMPLE = f"^[{LETTERS}]+$"


class Words:
    """Ids of words; a task encodes a frequent word once, but words of ``LETTERS`` in every slice of texts anew.

    These go to the byte pairs past the regular expressions of the tokenizer, which take most of its time: they are cheaper
    to encode than to keep. White space is dropped by the tokenizer and never joins ids, so a text's ids are those of its
    words in turn. Known words stand in two halves of ``most / 2`` bytes: when the young one is full it becomes the old
    one, and words of the old one that come again move to the young one. Everything goes when the task ends.
    """

    def __init__(self, path: str, most: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.half = Tokenizer.from_file(path), most // 2
        special = sorted((i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and t.content.startswith("<|"))
        self.between = (f" {special[0][1]} ", special[0][0]) if special else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0
        self.merges, self.last = self._merges()

    def _merges(self):
        """The tokenizer's byte pairs alone, and which ids end a word; (None, None) if it does more to plain words."""
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        model, suffix = self.tokenizer.model, getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not isinstance(model, BPE) or not suffix or model.dropout or model.unk_token:
            return None, None
        merges = Tokenizer(model)
        merges.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        whole, normal = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        for word in (LETTERS, *LETTERS):
            pieces = [piece for piece, _ in whole.pre_tokenize_str(word)] if whole else []
            if normal and normal.normalize_str(word) != word or pieces != [piece for piece, _ in merges.pre_tokenizer.pre_tokenize_str(word)]:
                return None, None
        vocabulary = self.tokenizer.get_vocab()
        last = np.zeros(max(vocabulary.values()) + 1, bool)
        last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        return merges, last

    def simple(self, words: list[str], step: int = 10_000) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of ``LETTERS``, one after the other, and how many each word has."""
        ids = [np.zeros(0, "<u4")]
        for a in range(0, len(words), step):
            some = words[a : a + step]
            lines = [" ".join(some[b : b + TOGETHER]) for b in range(0, len(some), TOGETHER)]
            ids += [np.array(got.ids, "<u4") for got in self.merges.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.concatenate(ids)
        return flat, np.diff(np.flatnonzero(self.last[flat]), prepend=-1)

    def _keep(self, word: str, ids: bytes) -> None:
        if self.size > self.half:
            self.young, self.old, self.size = {}, self.young, 0
        self.young[word] = ids
        self.size += ENTRY + len(word) + len(ids)

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word; plain words are encoded many at a time, with a special token between them."""
        if self.between is None or any("<|" in w for w in words):
            return [np.array(got.ids, "<u4").tobytes() for got in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        text, mark = self.between
        lines = [text.join([*words[a : a + TOGETHER], ""]) for a in range(0, len(words), TOGETHER)]
        ids = np.concatenate([np.array(got.ids, "<u4") for got in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)])
        ends = np.flatnonzero(ids == mark)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *(4 * ends[:-1] + 4).tolist()], (4 * ends).tolist(), strict=True)]

    def ids(self, words: list[str], step: int = 10_000) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each (distinct) word."""
        out, fresh = list(map(self.young.get, words)), []
        for i, got in enumerate(out):
            if got is None:
                got = self.old.get(words[i])
                if got is None:
                    fresh.append(i)
                else:
                    out[i] = got
                    self._keep(words[i], got)
        for a in range(0, len(fresh), step):
            some = fresh[a : a + step]
            for i, got in zip(some, self._encode([words[i] for i in some]), strict=True):
                out[i] = got
                self._keep(words[i], got)
        return out


def _distinct_ids(distinct: pa.Array, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all distinct words, in any order, and start and number of each word's."""
    simple = np.zeros(len(distinct), bool)
    pool, counts = np.zeros(0, "<u4"), np.zeros(0, np.int64)
    if words.merges is not None and len(distinct):
        mask = pc.match_substring_regex(distinct, SIMPLE)
        simple = mask.to_numpy(zero_copy_only=False)
        pool, counts = words.simple(distinct.filter(mask).to_pylist())
    known = words.ids(distinct.filter(pa.array(~simple)).to_pylist())
    order = np.concatenate([np.flatnonzero(simple), np.flatnonzero(~simple)])
    sizes, starts = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
    sizes[order] = counts = np.concatenate([counts, np.array([len(x) // 4 for x in known], np.int64)])
    starts[order] = np.cumsum(counts) - counts
    return np.concatenate([pool, np.frombuffer(b"".join(known), "<u4")]), starts, sizes


def token_ids(texts: pa.Array, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of texts, each text ending in ``END``, and the offsets of the texts in them."""
    plain = not pc.any(pc.match_substring(pc.fill_null(texts, ""), "<|")).as_py()
    if plain:  # fewer distinct words
        texts = pc.replace_substring_regex(texts, MARKED, r"\1 \2\3")
    flat, offsets = split(texts, lower=plain)  # the tokenizer lower-cases; special strings must stay as they are
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pool, starts, sizes = _distinct_ids(coded.dictionary, words)
    counts = sizes[codes] if len(codes) else np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    total = np.concatenate([[0], ends])[offsets]  # ids before each text, without END
    n = len(offsets) - 1
    out = np.full(int(total[-1]) + n, END, "<u4")
    keep = np.ones(len(out), bool)
    bounds = total + np.arange(n + 1)
    keep[bounds[1:] - 1] = False
    if len(codes):
        at = np.repeat(starts[codes] - (ends - counts), counts) + np.arange(int(ends[-1]))
        out[keep] = pool[at]
    return out, bounds


def tokenized_pieces(docs: DataFrame, tokenizer: str, length: int = 4096, with_ids: bool = False) -> DataFrame:
    """Documents (``doc_id``, ``text``) cut into pieces of at most ``length`` ids: ``doc_id``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``, ``copy`` (tells repeated rows apart) and, if asked for, ``ids`` (little-endian)."""
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, copy long" + (", ids binary" if with_ids else "")

    def cut(batches):
        words, row = Words(tokenizer), 0
        for batch in slices(batches, "text"):
            ids, bounds = token_ids(batch.column("text"), words)
            docs_, starts, lengths, sums, totals, copies, raw = [], [], [], [], [], [], []
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                for s in range(a, b, length):
                    piece = ids[s : min(b, s + length)].tobytes()
                    docs_.append(doc), starts.append(s - a), lengths.append(len(piece) // 4), sums.append(zlib.crc32(piece)), totals.append(b - a), copies.append(row)
                    if with_ids:
                        raw.append(piece)
                row += 1
            arrays = [pa.array(x, pa.int64()) for x in (docs_, starts, lengths, sums, totals, copies)] + ([pa.array(raw, pa.binary())] if with_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "copy"] + ["ids"] * with_ids)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, kind)


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of items in the given order and the number of bins: each goes to the first bin with room.

    ``room`` is a tournament tree: a node holds the most room of the bins below it, so the first bin with enough is found
    from the root by going left wherever the left half has room.
    """
    leaves = 1 << max(0, (len(lengths) - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, n in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < n:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        used = max(used, node - leaves + 1)
        room[node] -= n
        while node > 1:
            node //= 2
            most = room[2 * node] if room[2 * node] >= room[2 * node + 1] else room[2 * node + 1]
            if room[node] == most:
                break
            room[node] = most
    return bins, offsets, used


def pack(pieces: DataFrame, capacity: int = 4096, group: int = 8192, seed: int = 11) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: pieces in sequences of at most ``capacity`` ids.

    Pieces are dealt by hash to groups of about ``group``; each group is packed on its own by first-fit decreasing (equal
    lengths by doc_id, start, copy). A group leaves about one sequence partly empty. Sequence ids are the group's number
    times 2^32 plus the bin. ``pieces`` should be a written table; an empty one gives no rows.
    """
    count = pieces.count()
    groups = max(1, -(-count // group))
    keyed = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "copy", F.lit(seed)), F.lit(groups)))
    kind = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"

    def fill(held: pa.Table) -> pa.Table:
        lengths = held["length"].to_numpy()
        keys = [held[c].to_numpy() for c in ("copy", "start")] + [pc.fill_null(held["doc_id"], -1).to_numpy()]
        order = np.lexsort((*keys, -lengths))
        bins, offsets, _ = first_fit(lengths[order], capacity)
        out = held.take(pa.array(order))
        number = int(held["_group"][0].as_py()) << 32
        return out.drop_columns(["_group"]).append_column("sequence_id", pa.array(bins + number)).append_column("offset", pa.array(offsets))

    return keyed.groupBy("_group").applyInArrow(fill, kind)


def packed(docs: DataFrame, tokenizer: str, capacity: int = 4096, with_ids: bool = False) -> DataFrame:
    """Pieces of every document in sequences. Null texts are empty (their only id is ``END``); repeated rows are packed
    each; every id lies in exactly one piece; whole texts are tokenized."""
    return pack(materialize(tokenized_pieces(docs, tokenizer, capacity, with_ids), "pack-pieces"), capacity)


def sequences(packed_pieces: DataFrame, capacity: int = 4096, pad: int = 0) -> DataFrame:
    """The sequences themselves: ``sequence_id`` and ``ids`` (array of int), padded to ``capacity`` unless their length is a
    power of two. Needs pieces with ``ids``; a sequence is bounded by ``capacity``."""

    def join(held: pa.Table) -> pa.Table:
        order = np.argsort(held["offset"].to_numpy(), kind="stable")
        ids = np.frombuffer(b"".join(held["ids"].take(pa.array(order)).to_pylist()), "<u4").astype(np.int32)
        if len(ids) & (len(ids) - 1):
            ids = np.concatenate([ids, np.full(capacity - len(ids), pad, np.int32)])
        return pa.table({"sequence_id": held["sequence_id"].slice(0, 1), "ids": pa.array([ids.tolist()], pa.list_(pa.int32()))})

    return packed_pieces.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(join, "sequence_id long, ids array<int>")
