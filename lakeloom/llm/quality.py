"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.words import MIX, hashed, mixed, slices, split
from lakeloom.session import materialize

SEGMENT = 1 << 15
MARKS = """.,;:!?"'()[]{}<>|&*%$#@~^=+-_/\\`"""


@dataclass(frozen=True)
class Model:
    """The buckets of the two hash tables with a log ratio other than 0, and the log weight from which a document rather
    belongs to the target."""

    at: np.ndarray
    ratio: np.ndarray
    bound: float
    bits: int

    @classmethod
    def of(cls, ratios: np.ndarray, bits: int) -> Model:
        at = np.flatnonzero(ratios)
        return cls(at, ratios[at], float("-inf"), bits)

    def table(self) -> np.ndarray:
        """Ratio of every bucket; a task makes it once."""
        out = np.zeros(2 << self.bits, np.float32)
        out[self.at] = self.ratio
        return out


def shapes(words: pa.Array) -> pa.Array:
    """Word shapes: runs of capitals, small letters and digits become one sign each, marks stay."""
    for pattern, sign in ((r"\p{Lu}+", "A"), (r"[\p{Ll}\p{Lo}\p{M}]+", "a"), (r"\p{N}+", "0")):
        words = pc.replace_substring_regex(words, pattern, sign)
    return words


def grams(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(2, grams) buckets of the distinct grams of each text in two hash tables, one after the other, and the text each
    gram belongs to.

    Grams are words in lower case without marks around them, their first four letters, word shapes, pairs of shapes, and
    the share of words that equal the one before (in sixteenths, from four such words on). A gram counts once per text: repeats say little more.
    """
    flat, offsets = split(texts)
    if not len(flat):
        return np.zeros((2, 0), np.int64), np.zeros(0, np.int64)
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    bare = pc.utf8_trim(pc.utf8_lower(coded.dictionary), characters=MARKS)
    start = hashed(pc.utf8_slice_codeunits(bare, 0, 4)) + np.uint64(1)
    shape = hashed(shapes(coded.dictionary))
    kinds = np.unique(shape, return_inverse=True)[1]
    count = len(offsets) - 1
    owner = np.repeat(np.arange(count, dtype=np.uint64), np.diff(offsets))
    same = owner[1:] == owner[:-1]
    equal = np.bincount(owner[1:][same & (codes[1:] == codes[:-1])].astype(np.int64), minlength=count)
    sizes = np.maximum(np.diff(offsets), 1)
    top = np.uint64(2 * bits)
    shift = np.uint64(64) - top
    parts, owners = [], []
    for key in (hashed(bare), mixed(start * MIX)):
        parts.append((mixed(key * MIX) >> shift)[codes])
        owners.append(owner)
    seen, wide = kinds[codes].astype(np.uint64), np.uint64(kinds.max() + 1)
    first = np.zeros(int(wide), np.uint64)
    first[kinds] = shape
    pairs = np.unique((owner[1:][same] * wide + seen[:-1][same]) * wide + seen[1:][same])
    singles = np.unique(owner * wide + seen)
    parts.append(mixed(first[singles % wide] + np.uint64(2)) >> shift)
    owners.append(singles // wide)
    parts.append(mixed(first[pairs // wide % wide] * MIX + first[pairs % wide] + np.uint64(3)) >> shift)
    owners.append(pairs // wide // wide)
    steps = np.where(equal >= 4, equal * 16 // sizes, 0)  # all shares up to a text's own are its grams
    parts.append(mixed(np.concatenate([np.arange(n + 1) for n in steps.tolist()]).astype(np.uint64) * MIX + np.uint64(4)) >> shift)
    owners.append(np.repeat(np.arange(count, dtype=np.uint64), steps + 1))
    both = np.unique(np.concatenate([o << top | x for o, x in zip(owners, parts, strict=True)]))
    low = np.uint64((1 << bits) - 1)
    at = np.stack([both >> np.uint64(bits) & low, (both & low) + np.uint64(1 << bits)])
    return at.astype(np.int64), (both >> top).astype(np.int64)


def labelled_sample(labels: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and targets (1: good and not toxic) of at most ``most`` labelled rows, those with the smallest hash.

    Null ids or qualities don't count; of repeated ids every row must be good."""
    known = labels.where("doc_id is not null and quality is not null")
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    rows = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(good.cast("int")).alias("good"))
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).toPandas()
    got = got.sort_values("doc_id")
    return got["doc_id"].to_numpy(np.int64), got["good"].to_numpy(np.int64)


PARTS = ("raw", "target", "rejected")


def _counts(docs: DataFrame, ids: np.ndarray, good: np.ndarray, bits: int) -> dict[str, np.ndarray]:
    """Counts per bucket over all documents, the target's and the labelled others; each task hands on one array of each,
    cut into segments."""
    wanted, others, size = ids[good == 1], ids[good == 0], 2 << bits
    width = min(SEGMENT, size)

    def count(batches):
        sums = {p: np.zeros(size, np.int32) for p in PARTS}  # a task has fewer rows than that holds
        for batch in slices(batches, "text"):
            at, owner = grams(batch.column("text"), bits)
            names = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
            valid = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            np.add.at(sums["raw"], at.ravel(), 1)
            for part, some in (("target", wanted), ("rejected", others)):
                known = np.isin(names, some) & valid
                np.add.at(sums[part], at[:, known[owner]].ravel(), 1)
        starts = np.arange(0, size, width)
        packed = [pa.array([zlib.compress(sums[p][s : s + width].tobytes(), 1) for s in starts], pa.binary()) for p in PARTS]
        yield pa.RecordBatch.from_arrays([pa.array(starts // width), *packed], names=["segment", *PARTS])

    def add(held: pa.Table) -> pa.Table:
        out = {"segment": held["segment"].slice(0, 1)}
        for p in PARTS:
            total = np.zeros(width, np.int64)
            for x in held[p]:
                total += np.frombuffer(zlib.decompress(x.as_py()), np.int32)
            out[p] = pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())
        return pa.table(out)

    kind = "segment long, " + ", ".join(f"{p} binary" for p in PARTS)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, kind)
    rows = found.groupBy("segment").applyInArrow(add, kind).collect()  # the model: 3 x 2 x 2^bits numbers, whatever the input
    out = {p: np.zeros(size, np.int64) for p in PARTS}
    for r in rows:
        at = slice(r["segment"] * width, (r["segment"] + 1) * width)
        for p in PARTS:
            out[p][at] = np.frombuffer(zlib.decompress(r[p]), np.int64)
    return out


def log_ratios(raw: np.ndarray, target: np.ndarray, rejected: np.ndarray, pseudo: float = 0.5, least: float = 1.0, sigmas: float = 2.5) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | raw), smoothed by ``pseudo`` counts on the target's scale.

    The ratio is centred on what a typical n-gram of target text has (raw text holds other text too, which lowers
    all its shares alike). Buckets whose two models differ by less than ``least`` or ``sigmas`` deviations of the expected
    count count as equal, so that long documents do not gather noise. So do buckets whose difference the labelled
    documents outside the target don't bear out: a group of copies without labels is common in raw text and missing in the
    target, but says nothing about quality.
    """
    if not raw.sum() or not target.sum():
        return np.zeros(len(raw), np.float32)
    n_raw, n_target, n_rejected = raw.sum(), target.sum(), max(rejected.sum(), 1)
    out = np.zeros(len(raw), np.float32)
    held = np.flatnonzero(target)
    own = np.log((target[held] + pseudo) / (raw[held] * (n_target / n_raw) + pseudo))
    order = np.argsort(own)
    mass = np.cumsum(target[held][order])
    typical = own[order][np.searchsorted(mass, mass[-1] / 2)]
    for a in range(0, len(raw), 1 << 16):  # a stretch at a time, as the driver does this
        r, t, j = (x[a : a + (1 << 16)] for x in (raw, target, rejected))
        expected = r * (n_target / n_raw)
        ratio = np.log((t + pseudo) / (expected + pseudo)) - typical
        unsure = (np.abs(ratio) < least) | (np.abs(t - expected) < sigmas * np.sqrt(expected + 1))
        share = np.log((j + pseudo) / n_rejected / ((t + pseudo) / n_target))
        borne = np.where(ratio < 0, (j >= 2) & (share > least), share < -least)
        out[a : a + (1 << 16)] = np.where(unsure | ~borne, 0.0, ratio)
    return out


def gram_ratios(ratio: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ratio of each gram: of its two buckets the one nearer to 0, for a bucket may be shared with a telling gram but two
    hardly are; 0 where they disagree."""
    a, b = ratio[at].astype(np.float64)
    return np.where(a * b > 0, np.sign(a) * np.minimum(np.abs(a), np.abs(b)), 0.0)


def _weights(batch: pa.RecordBatch, ratios: np.ndarray, bits: int) -> np.ndarray:
    at, owner = grams(batch.column("text"), bits)
    return np.bincount(owner, weights=gram_ratios(ratios, at), minlength=batch.num_rows).astype(np.float64)


def gumbel(ids: np.ndarray, seed: int = 0) -> np.ndarray:
    """A Gumbel variate per id, the same on every run."""
    u = (mixed(ids.astype(np.int64).view(np.uint64) * MIX + np.uint64(seed + 1)) >> np.uint64(11)).astype(np.float64)
    return -np.log(-np.log((u + 0.5) / 2.0**53))


def weigh(docs: DataFrame, model: Model, seed: int = 0) -> DataFrame:
    """``doc_id``, ``log_weight`` and ``sort_key`` (log weight plus Gumbel noise) of every document, over whole texts."""

    def score(batches):
        ratios = model.table()
        for batch in slices(batches, "text"):
            w = _weights(batch, ratios, model.bits)
            ids = batch.column("doc_id")
            keys = w + gumbel(ids.fill_null(-1).to_numpy(zero_copy_only=False), seed)
            yield pa.RecordBatch.from_arrays([ids, pa.array(w), pa.array(keys)], names=["doc_id", "log_weight", "sort_key"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, log_weight double, sort_key double")


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 4096, small: int = 10_000) -> float:
    """The ``k``-th largest value of a column, exactly, by counting in ever narrower ranges; at most ``small`` distinct
    values reach the driver. Above all values for k < 1, below all for k beyond the rows."""
    if k < 1:
        return float("inf")
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if n is None or k > n:
        return float("-inf")
    above = 0
    for _ in range(64):
        inside = rows.where(F.col(column).between(low, high))
        distinct = inside.groupBy(column).count().orderBy(F.col(column).desc()).limit(small + 1)
        got = distinct.collect()
        if len(got) <= small or low >= high:
            for value, count in got:
                above += count
                if above >= k:
                    return value
        width = (high - low) / bins
        at = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).alias("bin")
        for row in inside.groupBy(at).agg(F.count("*").alias("n"), F.min(column).alias("a"), F.max(column).alias("b")).orderBy(F.col("bin").desc()).collect():
            if above + row["n"] >= k:
                low, high = row["a"], row["b"]
                break
            above += row["n"]
    raise RuntimeError("values could not be told apart")


def fit(docs: DataFrame, labels: DataFrame, most_labels: int = 100_000, bits: int = 20) -> Model:
    """Models from all documents (raw) and the labelled good, not toxic ones among them (target).

    At most ``most_labels`` labelled rows are used (about 1.6 MB sent to the tasks). The bound between kept and rejected
    is the log weight that best separates the labelled good from the other labelled documents, all rows of a repeated id
    among them; without labels, or with labels of one kind only, nothing is rejected.
    """
    ids, good = labelled_sample(labels, most_labels)
    if not len(ids):
        return Model.of(np.zeros(0, np.float32), bits)
    counts = _counts(docs, ids, good, bits)
    model = Model.of(log_ratios(*(counts[p] for p in PARTS)), bits)
    del counts

    def known(batches):
        ratios = model.table()
        for batch in slices(batches, "text"):
            names = batch.column("doc_id")
            here = pa.array(np.isin(names.fill_null(-1).to_numpy(zero_copy_only=False), ids) & names.is_valid().to_numpy(zero_copy_only=False))
            some = batch.filter(here)
            if some.num_rows:
                target = good[np.searchsorted(ids, some.column("doc_id").to_numpy())]
                yield pa.RecordBatch.from_arrays([pa.array(_weights(some, ratios, bits)), pa.array(target), pa.array(1 - target)], names=["w", "good", "other"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return replace(model, bound=bound_of_rows(rows.mapInArrow(known, "w double, good long, other long"), most_labels))


def best_bound(weights: np.ndarray, good: np.ndarray) -> float:
    """Halfway between the two labelled weights where the fewest labelled documents fall on the wrong side."""
    if not len(weights) or good.all() or not good.any():
        return float("-inf")
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    wrong = np.concatenate([[0], np.cumsum(g)]) + (len(g) - g.sum()) - np.concatenate([[0], np.cumsum(1 - g)])
    free = np.concatenate([[True], w[1:] > w[:-1], [True]])
    at = int(np.flatnonzero(free)[np.argmin(wrong[free])])
    if at == 0:
        return float("-inf")
    return float((w[at - 1] + w[at]) / 2) if at < len(w) else float("inf")


def bound_of_rows(rows: DataFrame, most: int) -> float:
    """``best_bound`` of all ``rows``: weights ``w`` with the counts ``good`` and ``other``.

    Up to ``most`` rows meet on the driver. More are cut into ranges of about ``most`` weights, each of which finds its
    best place from the counts below it; only sums and places of the ranges reach the driver."""
    counted = materialize(rows.groupBy("w").agg(F.sum("good").alias("good"), F.sum("other").alias("other")), "quality-labelled")
    n, good, other = counted.agg(F.count("w"), F.sum("good"), F.sum("other")).first()
    if not good or not other:
        return float("-inf")
    if good + other <= most:
        got = counted.toPandas()
        both = np.concatenate([np.repeat(got["w"], got["good"]), np.repeat(got["w"], got["other"])])
        return best_bound(both, np.repeat([1, 0], [good, other]))
    ranges = materialize(counted.repartitionByRange(-(-n // most), "w").withColumn("part", F.spark_partition_id()), "quality-ranges")
    sums = ranges.groupBy("part").agg(F.min("w").alias("low"), F.sum(F.col("good") - F.col("other")).alias("more")).orderBy("low").collect()
    before = dict(zip([s["part"] for s in sums], np.cumsum([0, *(s["more"] for s in sums)]).tolist(), strict=False))

    def places(held: pa.Table) -> pa.Table:
        held = held.sort_by("w")
        w, more = held["w"].to_numpy(), held["good"].to_numpy() - held["other"].to_numpy()
        wrong = other + before[held["part"][0].as_py()] + np.cumsum(more)  # with the bound right above each weight
        at = int(np.argmin(wrong))
        return pa.table({"wrong": [int(wrong[at])], "w": [float(w[at])], "above": pa.array([float(w[at + 1]) if at + 1 < len(w) else None], pa.float64())})

    found = ranges.groupBy("part").applyInArrow(places, "wrong long, w double, above double").collect()
    best = min(found, key=lambda f: (f["wrong"], f["w"]))
    if best["wrong"] >= other:
        return float("-inf")
    above = best["above"] if best["above"] is not None else min((s["low"] for s in sums if s["low"] > best["w"]), default=None)
    return float("inf") if above is None else (best["w"] + above) / 2


def resample(docs: DataFrame, labels: DataFrame, seed: int = 0, **options) -> tuple[DataFrame, DataFrame]:
    """(documents kept, their weights): importance resampling of ``docs`` (``doc_id``, ``text`` and any other columns).

    k is the number of documents whose weight is above the fitted bound; the k largest sums of log weight and Gumbel noise
    are kept, which draws k documents without replacement in proportion to their weights. Ties at the end are all
    kept (repeated rows share their noise). Null texts are empty and weigh 0 (log); null ids share one noise. Empty tables
    give no rows. The first frame has all columns and rows of ``docs`` that are kept, the second ``doc_id``,
    ``log_weight``, ``sort_key``.
    """
    model = fit(docs, labels, **options)
    weights = materialize(weigh(docs, model, seed), "quality-weights")
    k = weights.where(F.col("log_weight") > F.lit(model.bound)).count()
    least = kth_largest(weights, "sort_key", k)
    schema = docs.schema

    def keep(batches):
        ratios = model.table()
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(_weights(batch, ratios, model.bits) + gumbel(ids, seed) >= least))

    return docs.mapInArrow(keep, schema), weights.where(F.col("sort_key") >= F.lit(least))
