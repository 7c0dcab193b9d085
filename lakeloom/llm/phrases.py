"""Collocations by stripes: each prefix keys a counter of its next words; stripes are merged element by element."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.files import listed, place
from lakeloom.llm.words import MIX, hashed, mixed, slices, split
from lakeloom.session import materialize, scratch_path

SEPARATORS = r"[.,;:!?\x0A-\x0D]"
MARK = "."
REST = ""
BITS = 21
IDS = 1 << BITS
STEP = 400_000
ENTRIES = 2_000_000
PROBES = 4
WORD_SLOTS = 256
STRIPE = "lang string, prefix string, slot int, nexts array<string>, counts array<long>"


def marked_words(texts: pa.Array) -> pa.Array:
    """Words of all texts in turn, A-Z in lower case, with at least one ``MARK`` after each piece: no word is a mark, for
    marks separate pieces."""
    cut = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), SEPARATORS, f" {MARK} ")
    ended = pc.binary_join_element_wise(cut, pa.scalar(MARK, pa.large_string()), pa.scalar(" ", pa.large_string()))
    return split(ended, lower=True)[0]


def word_keys(words: np.ndarray, lang: np.uint64) -> np.ndarray:
    return mixed(words * MIX + lang)


def pair_keys(first: np.ndarray, second: np.ndarray, lang: np.uint64) -> np.ndarray:
    return mixed((first * MIX + second) * MIX + lang + np.uint64(1))


class Filter:
    """Bloom filter of 2^n bits as its tasks read it from the shared folder."""

    def __init__(self, path: str, size: int):
        self.bits, self.mask = np.zeros(size // 64, np.uint64), np.uint64(size - 1)
        store, _ = place(path)
        for name in listed(path, ".parquet"):
            with store.open_input_file(name) as f:
                got = pq.read_table(f, columns=["word", "bits"])
                self.bits[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in places(keys, self.mask):
            out &= (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def places(keys: np.ndarray, mask: np.uint64) -> list[np.ndarray]:
    """Bits of a filter that stand for each key."""
    return [mixed(keys + np.uint64(i * int(MIX) % 2**64)) & mask for i in range(PROBES)]


def write_filter(phrases: DataFrame, columns: list[str], most_bits: int = 1 << 27) -> tuple[str, int]:
    """Folder and size of a Bloom filter over phrases of one or two words (``lang`` and ``columns``).

    It has at least 16 bits a phrase up to ``most_bits``; beyond that it lets more of the others pass, which costs time but
    no exactness. Bits are joined in Spark and never meet on the driver.
    """
    size = min(most_bits, max(1 << 16, 1 << (16 * phrases.count()).bit_length()))
    mask = np.uint64(size - 1)

    def bits(batches):
        for batch in batches:
            langs = hashed(batch.column("lang"))
            words = [hashed(batch.column(c)) for c in columns]
            keys = word_keys(words[0], langs) if len(words) == 1 else pair_keys(*words, langs)
            at = np.unique(np.concatenate(places(keys, mask))) if len(keys) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64))], names=["at"])

    path = scratch_path(phrases.sparkSession, "phrase-filter")
    found = phrases.select("lang", *columns).mapInArrow(bits, "at long")
    found.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).write.parquet(path)
    return path, size


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class Stripes:
    """A task's stripes for prefixes of ``level - 1`` words, handed on whenever they hold about ``ENTRIES`` entries.

    Only prefixes and next words that the ``filters`` of the levels below let pass are told apart; what else follows a
    prefix, the end of its piece included, counts under ``REST``. So the sum of a stripe is the count of its prefix.
    ``heavy`` says into how many slots, by a hash of the next word, the stripes of a prefix are dealt.
    """

    def __init__(self, level: int, filters: list[Filter], heavy: dict[tuple[str, str], int]):
        self.level, self.filters, self.heavy = level, filters, heavy
        self._start()

    def _start(self) -> None:
        self.ids: dict[str, dict[str, int]] = {}
        self.words, self.langs, self.hashes = [REST], [""], [np.zeros(1, np.uint64)]
        self.keys, self.counts, self.fresh, self.waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def _known(self, lang: str, words: list[str], hashes: np.ndarray) -> np.ndarray:
        own = self.ids.setdefault(lang, {})
        out, new = np.empty(len(words), np.int64), []
        for i, w in enumerate(words):
            at = own.get(w)
            if at is None:
                at = own[w] = len(self.words)
                self.words.append(w)
                new.append(i)
            out[i] = at
        self.langs.extend([lang] * len(new))
        self.hashes.append(hashes[new])
        return out

    def add(self, lang: str, part: pa.Array, count: int):
        """Count what starts at the first ``count`` words; the others are looked at only as what follows."""
        coded = part.dictionary_encode()
        names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if len(self.words) + len(names) > IDS:
            yield from self.flush()
        hashes, key = hashed(names), hashed(pa.array([lang]))[0]
        fine = pc.not_equal(names, MARK).to_numpy(zero_copy_only=False)
        if self.level > 1:
            fine &= self.filters[0].has(word_keys(hashes, key))
        ids = np.zeros(len(names) + 1, np.int64)
        ids[:-1][fine] = self._known(lang, names.filter(pa.array(fine)).to_pylist(), hashes[fine])
        codes = np.concatenate([codes, np.full(count + 2 - min(len(codes), count + 2), len(names))])  # as if marks followed
        fine = np.concatenate([fine, [False]])
        if self.level == 1:
            keys = ids[codes[:count][fine[codes[:count]]]]
        elif self.level == 2:
            first, second = codes[:count], codes[1 : count + 1]
            keys = (ids[first] << BITS | np.where(fine[second], ids[second], 0))[fine[first]]
        else:
            hashes = np.concatenate([hashes, [np.uint64(0)]])
            pair = fine[codes[: count + 1]] & fine[codes[1 : count + 2]]
            at = np.flatnonzero(pair)
            pair[at] = self.filters[1].has(pair_keys(hashes[codes[at]], hashes[codes[at + 1]], key))
            at = np.flatnonzero(pair[:count])
            keys = ids[codes[at]] << 2 * BITS | ids[codes[at + 1]] << BITS | np.where(pair[at + 1], ids[codes[at + 2]], 0)
        self.fresh.append(keys)
        self.waiting += len(keys)
        if self.waiting > ENTRIES:
            self._settle()
            if len(self.keys) > ENTRIES:
                yield from self.flush()

    def _settle(self) -> None:
        keys = np.concatenate([self.keys, *self.fresh])
        counts = np.concatenate([self.counts, np.ones(len(keys) - len(self.keys), np.int64)])
        (self.keys, self.counts), self.fresh, self.waiting = added(keys, counts), [], 0

    def _slots(self, prefix: np.ndarray, following: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        if self.level == 1:
            return (hashes[following] % np.uint64(WORD_SLOTS)).astype(np.int64)
        slots = np.full(len(prefix), -1, np.int64)
        for (lang, phrase), count in self.heavy.items():
            known = [self.ids.get(lang, {}).get(w) for w in phrase.split(" ")]
            if None in known:
                continue
            code = known[0] if self.level == 2 else known[0] << BITS | known[1]
            a, b = np.searchsorted(prefix, [code, code + 1])
            slots[a:b] = (hashes[following[a:b]] % np.uint64(count)).astype(np.int64)
        return slots

    def flush(self):
        self._settle()
        words, hashes = pa.array(self.words, pa.large_string()), np.concatenate(self.hashes)
        following = self.keys & (IDS - 1)
        if self.level == 1:
            names, prefix = np.unique(np.array(self.langs, object)[following].astype(str), return_inverse=True)
        else:
            prefix = self.keys >> BITS
        slots = self._slots(prefix, following, hashes)
        order = np.lexsort((slots, prefix))
        prefix, slots, following, counts = prefix[order], slots[order], following[order], self.counts[order]
        first = np.flatnonzero(np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (slots[1:] != slots[:-1])])) if len(prefix) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(prefix))
        a = 0
        while a < len(first):
            b = max(a + 1, int(np.searchsorted(ends, first[a] + ENTRIES // 8, side="right")))
            some, low, high = prefix[first[a:b]], first[a], ends[b - 1]
            if self.level == 1:
                langs, phrases = pa.array(names[some].tolist(), pa.string()), pa.array([""] * (b - a), pa.string())
            else:
                top = some if self.level == 2 else some >> BITS
                langs = pa.array([self.langs[i] for i in top], pa.string())
                phrases = words.take(pa.array(top))
                if self.level == 3:
                    phrases = pc.binary_join_element_wise(phrases, words.take(pa.array(some & (IDS - 1))), pa.scalar(" ", pa.large_string()))
            offsets = pa.array(np.append(first[a:b], high) - low, pa.int32())
            nexts = pa.ListArray.from_arrays(offsets, words.take(pa.array(following[low:high])).cast(pa.string()))
            sums = pa.ListArray.from_arrays(offsets, pa.array(counts[low:high]))
            yield pa.RecordBatch.from_arrays([langs, phrases.cast(pa.string()), pa.array(slots[first[a:b]].astype(np.int32)), nexts, sums], names=["lang", "prefix", "slot", "nexts", "counts"])
            a = b
        self._start()


def stripes(docs: DataFrame, level: int, filters: list[tuple[str, int]], heavy: dict[tuple[str, str], int]) -> DataFrame:
    """Stripes of each task over ``docs`` (``lang``, ``text``): ``lang``, ``prefix``, ``slot``, ``nexts``, ``counts``."""

    def count(batches):
        held = Stripes(level, [Filter(*f) for f in filters], heavy)
        for batch in slices(batches, "text"):
            for lang in batch.column("lang").unique().to_pylist():
                words = marked_words(batch.filter(pc.equal(batch.column("lang"), lang)).column("text"))
                for a in range(0, len(words), STEP):
                    yield from held.add(lang, words.slice(a, STEP + 2), min(STEP, len(words) - a))
        yield from held.flush()

    return docs.select("lang", "text").mapInArrow(count, STRIPE)


def merge(parts: DataFrame, least: int) -> DataFrame:
    """Stripes added up element by element: ``lang``, ``prefix``, ``slot``, ``total`` and ``kept``, the next words that
    follow at least ``least`` times with their counts. Stripes are shuffled whole, by prefix and slot; entries are told apart
    and added after that, where Spark can spill. Prefixes below ``least`` go."""
    cells = parts.repartition("lang", "prefix", "slot").select("lang", "prefix", "slot", F.explode(F.arrays_zip("nexts", "counts")).alias("cell"))
    sums = cells.groupBy("lang", "prefix", "slot", F.col("cell.nexts").alias("next")).agg(F.sum("cell.counts").alias("f"))
    entry = F.when((F.col("f") >= least) & (F.col("next") != REST), F.struct("next", "f"))
    merged = sums.groupBy("lang", "prefix", "slot").agg(F.sum("f").alias("total"), F.collect_list(entry).alias("kept"))
    return merged.where((F.col("slot") >= 0) | (F.col("total") >= least))


def heavy_prefixes(phrases: DataFrame, total: int, shares: int = 4096, floor: int = 1 << 20) -> dict[tuple[str, str], int]:
    """Slots of the prefixes that hold more than ``floor`` and one ``shares``-th of all words: at most ``shares``."""
    size = max(floor, -(-total // shares))
    return {(r["lang"], r["phrase"]): -(-r["f"] // size) for r in phrases.where(F.col("f") > size).collect()}


def score(a, left, right):
    """floor(10^6 a^2 / (left right)); exact for counts below 10^16."""
    wide = [F.col(c).cast("decimal(20,0)") for c in (a, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2])


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000, floor: int = 1 << 20) -> DataFrame:
    """The ``top`` phrases of two or three words of each ``lang``: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Three passes over the texts make stripes for prefixes of 0, 1 and 2 words; each level leaves out what can't reach
    ``least`` by the counts of the level below (a phrase is at most as frequent as its parts), which tasks know from a Bloom
    filter. A stripe gives the extensions of its prefix, the prefix's own count (its sum) and the largest extension; the
    same entries by their last two words give the largest extension to the left. A phrase of two words goes if one of
    three words around it has ``share`` per cent of its count.

    Stripes of frequent prefixes are dealt to slots by the next word, so no key holds more than about ``floor`` words or
    1/4096 of all. Null texts are empty; a null ``lang`` is ``und``; repeated rows count each; an empty table gives
    no rows; other columns don't matter.
    """
    read = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    first = materialize(merge(stripes(read, 1, [], {}), least), "words")
    totals = first.groupBy("lang").agg(F.sum("total").alias("n"))
    words = first.select("lang", F.inline("kept")).withColumnRenamed("next", "phrase")
    total = totals.agg(F.sum("n")).first()[0] or 0
    common = write_filter(words, ["phrase"])
    second = materialize(merge(stripes(read, 2, [common], heavy_prefixes(words, total, floor=floor)), least), "pairs")
    pairs = second.select("lang", F.col("prefix").alias("x"), F.inline("kept")).withColumnRenamed("next", "y")
    heavy = heavy_prefixes(pairs.select("lang", F.concat_ws(" ", "x", "y").alias("phrase"), "f"), total, floor=floor)
    third = materialize(merge(stripes(read, 3, [common, write_filter(pairs, ["x", "y"])], heavy), least), "triples")

    largest = F.coalesce(F.array_max(F.col("kept.f")), F.lit(0))
    held = third.groupBy("lang", "prefix").agg(F.sum("total").alias("f"), F.max(largest).alias("more")).where(F.col("f") >= least)
    held = materialize(held.withColumnRenamed("prefix", "phrase"), "held")
    part = F.split("phrase", " ")
    longer = third.select("lang", "prefix", F.inline("kept")).withColumnsRenamed({"next": "z", "f": "a"})
    longer = longer.select("lang", F.concat_ws(" ", "prefix", "z").alias("phrase"), "prefix", "z", F.split("prefix", " ")[0].alias("x"), F.concat_ws(" ", F.split("prefix", " ")[1], "z").alias("rest"), "a")
    longer = materialize(longer, "longer")

    def counted(rows: DataFrame, key: str, table: DataFrame, name: str) -> DataFrame:
        return rows.join(table.select("lang", F.col("phrase").alias(key), F.col("f").alias(name)), ["lang", key])

    left = longer.groupBy("lang", F.col("rest").alias("phrase")).agg(F.max("a").alias("before"))
    two = held.join(left, ["lang", "phrase"], "left").where(100 * F.greatest("more", F.coalesce("before", F.lit(0))) < share * F.col("f"))
    two = two.select("lang", "phrase", F.col("f").alias("a"), part[0].alias("x"), part[1].alias("y"))
    two = counted(counted(two, "x", words, "l"), "y", words, "r").select("lang", "phrase", "a", "l", "r", score("a", "l", "r").alias("score"))
    three = counted(counted(longer, "x", words, "l1"), "rest", held, "r1")
    three = counted(counted(three, "prefix", held, "l2"), "z", words, "r2")
    three = three.withColumns({"s1": score("a", "l1", "r1"), "s2": score("a", "l2", "r2")})
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", "phrase", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = two.unionByName(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
