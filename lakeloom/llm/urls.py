"""URL rules answered by cascades of Bloom filters: exact membership without a join."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.session import materialize

#: Rules (verdict, host/path) of the registered query.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
MOST_FILTER_BYTES = 64 << 20


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_keys(host: Column, path: Column) -> Column:
    """Every rule that could fit a url, longest first: each parent of the host with each prefix of the path that ends in
    ``/``, written ``host`` + path. Ties in length go to the longer host."""
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    steps = F.split(path, "/")
    ends = F.when(F.size(steps) > 1, F.sequence(F.lit(1), F.size(steps) - 1)).otherwise(F.array().cast("array<int>"))
    paths = F.transform(ends, lambda i: F.concat(F.concat_ws("/", F.slice(steps, F.lit(1), i)), F.lit("/")))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))
    # all keys end the same url, so a host's length tells its place
    ranked = F.sort_array(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), F.instr(k, "/").alias("h"), k.alias("key"))), asc=False)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(ranked, lambda k: k["key"]))


def _places(keys: list[str] | np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """(keys, hashes) bit positions in the filter of one level."""
    keys = np.asarray(keys, object)
    one = pd.util.hash_array(keys, hash_key=f"bloom-a-{level:08d}", categorize=False).astype(np.uint64)
    two = pd.util.hash_array(keys, hash_key=f"bloom-b-{level:08d}", categorize=False).astype(np.uint64) | np.uint64(1)
    steps = np.arange(hashes, dtype=np.uint64)
    return ((one[:, None] + steps[None, :] * two[:, None]) % np.uint64(bits)).astype(np.int64)


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: bytes  # the bit array, packed

    def holds(self, level: int, keys: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(keys), bool)
        table = np.frombuffer(self.words, np.uint8)
        at = _places(keys, level, self.bits, self.hashes)
        return ((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool).all(axis=1)


@dataclass(frozen=True)
class Cascade:
    """Levels 0, 2, ... hold listed keys, levels 1, 3, ... the other keys that the level before let pass."""

    levels: tuple[Level, ...]

    def size(self) -> int:
        return sum(len(x.words) for x in self.levels)

    def listed(self, keys) -> np.ndarray:
        """For keys of the universe it was built over: exactly whether each one is listed."""
        keys = np.asarray(keys, object)
        out = np.zeros(len(keys), bool)
        open_ = np.arange(len(keys))
        for i, level in enumerate(self.levels):
            passed = level.holds(i, keys[open_])
            out[open_[~passed]] = i % 2 == 1
            open_ = open_[passed]
            if not len(open_):
                return out
        out[open_] = len(self.levels) % 2 == 1
        return out


def _shape(count: int, rate: float, most_bytes: int) -> tuple[int, int]:
    if not count:
        return 0, 0
    bits = max(64, math.ceil(-count * math.log(rate) / math.log(2) ** 2))
    if bits > most_bytes * 8:
        raise MemoryError(f"{count} keys need {bits // 8} bytes in one filter; split the keys into shards")
    return bits, max(1, round(bits / count * math.log(2)))


def _filled(keys: DataFrame, level: int, bits: int, hashes: int) -> Level:
    """Set bits are found in the tasks and combined by word of the filter; only the filter reaches the driver."""
    if not bits:
        return Level(0, 0, b"")

    def chunks(batches):
        for batch in batches:
            at = np.unique(_places(batch.column(0).to_numpy(zero_copy_only=False), level, bits, hashes))
            yield pa.RecordBatch.from_pydict({"word": at >> 5, "bit": np.int64(1) << (at & 31)})

    found = keys.select("key").mapInArrow(chunks, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit"))
    table = np.zeros((bits + 31) // 32, np.uint32)
    got = found.toPandas()
    table[got["word"].to_numpy(np.int64)] = got["bit"].to_numpy(np.int64).astype(np.uint32)
    return Level(bits, hashes, table.tobytes())


def build_cascade(universe: DataFrame, listed: DataFrame, most_bytes: int = MOST_FILTER_BYTES, most_levels: int = 64) -> Cascade:
    """Cascade over ``universe`` (all keys ever asked, column ``key``) for the keys in ``listed`` (column ``key``).

    Level 0 holds the listed keys; each next level holds the keys of the other side that the level before lets pass, until
    none is left. The first rate is listed / others / sqrt(2), further ones 1/2, so the filters' size follows the number
    of listed keys, not the universe. A filter above ``most_bytes`` is refused; ``judge`` then shards the keys. Null keys are
    ignored, repeated keys count once; empty tables give a cascade that lists nothing.
    """
    listed = listed.select("key").where("key is not null").distinct()
    others = universe.select("key").where("key is not null").distinct().join(listed, "key", "left_anti")
    sides = [materialize(listed, "bloom-listed"), materialize(others, "bloom-others")]
    counts = [sides[0].count(), sides[1].count()]
    levels: list[Level] = []
    while counts[len(levels) % 2] and len(levels) < most_levels:
        i = len(levels)
        side = i % 2
        rate = min(0.5, counts[0] / max(counts[1], 1) / math.sqrt(2)) if i == 0 else 0.5
        levels.append(_filled(sides[side], i, *_shape(counts[side], rate, most_bytes)))
        last, at = levels[-1], i

        def passing(batches, last=last, at=at):
            for batch in batches:
                hit = last.holds(at, batch.column(0).to_numpy(zero_copy_only=False))
                yield batch.filter(pa.array(hit))

        sides[1 - side] = materialize(sides[1 - side].select("key").mapInArrow(passing, "key string"), "bloom-passed")
        counts[1 - side] = sides[1 - side].count()
    if counts[len(levels) % 2]:
        raise RuntimeError("the cascade did not close")
    return Cascade(tuple(levels))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", most_bytes: int = MOST_FILTER_BYTES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages`` (``page_id``, ``url``).

    ``rules`` has ``key`` (like ``net/es/``; the path ends in ``/``) and ``verdict`` (allow or block). A rule fits its
    host and all subdomains if the url's path starts with the rule's; the longest wins (of equal ones the one with the
    longer host). Two cascades decide: one over all keys that the urls could fit, for the rules; one over the rules, for
    the blocked ones. Urls that no listed key fits get ``default``. Repeated rules count once, block before allow.
    Null urls and urls without ``://`` have empty host and path and no rule; repeated rows are judged each; empty tables
    give no rows. Only the filters are sent to tasks; where one would exceed ``most_bytes``, the keys are cut into hash
    shards with cascades of their own.
    """
    rules = rules.groupBy("key").agg(F.max("verdict").alias("verdict"))
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    keyed = parsed.withColumn("keys", url_keys(F.col("host"), F.col("path")))
    universe = keyed.select(F.explode("keys").alias("key")).distinct()
    try:
        ruled = build_cascade(universe, rules, most_bytes)
        blocked = build_cascade(rules, rules.where("verdict = 'block'"), most_bytes)
    except MemoryError:
        return _judge_in_shards(keyed, universe, rules, default, most_bytes)

    def decide(batches):
        for batch in batches:
            lists = batch.column(3)
            flat = lists.flatten()
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            words = flat.dictionary_encode()
            vocabulary = words.dictionary.to_numpy(zero_copy_only=False)
            codes = words.indices.to_numpy(zero_copy_only=False)
            known = ruled.listed(vocabulary) if len(vocabulary) else np.zeros(0, bool)
            bad = np.zeros(len(vocabulary), bool)
            if known.any():
                bad[known] = blocked.listed(vocabulary[known])
            hits = np.flatnonzero(known[codes]) if len(codes) else np.zeros(0, np.int64)
            rows = np.searchsorted(starts, hits, side="right") - 1
            owner, first = np.unique(rows, return_index=True)
            rule = np.full(batch.num_rows, None, object)
            verdict = np.full(batch.num_rows, default, object)
            best = codes[hits[first]]
            rule[owner] = vocabulary[best] if len(best) else []
            verdict[owner] = np.where(bad[best], "block", "allow") if len(best) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    kind = dict(pages.dtypes)["page_id"]
    return keyed.mapInArrow(decide, f"page_id {kind}, host string, path string, rule string, verdict string")


def _judge_in_shards(keyed: DataFrame, universe: DataFrame, rules: DataFrame, default: str, most_bytes: int) -> DataFrame:
    """``judge`` by a cascade per hash shard of the keys; shards are halved until their filters fit. Every shard reads the
    urls' keys once and hands on those that are listed; each row takes its longest one."""
    rows = materialize(keyed.withColumn("_row", F.monotonically_increasing_id()), "bloom-rows")
    asked = rows.select("_row", F.posexplode("keys").alias("pos", "key"))
    universe, rules = materialize(universe, "bloom-universe"), materialize(rules.where("key is not null"), "bloom-rules")

    def hits(shards: int, shard: int) -> list[DataFrame]:
        mine = F.pmod(F.xxhash64("key", F.lit(17)), F.lit(shards)) == shard
        listed = rules.where(mine)
        try:
            ruled = build_cascade(universe.where(mine), listed, most_bytes)
            blocked = build_cascade(listed, listed.where("verdict = 'block'"), most_bytes)
        except MemoryError:
            if listed.count() < 2:
                raise
            return hits(2 * shards, shard) + hits(2 * shards, shard + shards)

        def match(batches):
            for batch in batches:
                some = batch.filter(pa.array(ruled.listed(batch.column(2).to_numpy(zero_copy_only=False))))
                if some.num_rows:
                    bad = blocked.listed(some.column(2).to_numpy(zero_copy_only=False))
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(bad)], names=["_row", "pos", "key", "bad"])

        return [asked.where(mine).mapInArrow(match, "_row long, pos int, key string, bad boolean")]

    found = None
    for part in hits(2, 0) + hits(2, 1):
        found = part if found is None else found.union(part)
    best = found.groupBy("_row").agg(F.min(F.struct("pos", "key", "bad")).alias("best"))
    verdict = F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.bad"), "block").otherwise("allow")
    return rows.join(best, "_row", "left").select("page_id", "host", "path", F.col("best.key").alias("rule"), verdict.alias("verdict"))
