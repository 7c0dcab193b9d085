"""Jaccard join of word shingles: pivots, Voronoi regions, triangle-inequality windows, exact joins in the regions."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.components import stars
from lakeloom.llm.words import MIX, hashed, mixed, rolled, slices, split
from lakeloom.session import materialize, scratch_path
from lakeloom.sources.shared import parquet_blocks

WORDS, PERCENT = 5, 75
HALF = 0.5  # radius of a pivot's region
FEW = 250_000  # links that are sent to all tasks, so that texts are shuffled once


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``words``-word shingles of each text (A-Z lower-cased); shorter texts are one shingle."""
    flat, offsets = split(texts, lower=True)
    keys = hashed(flat)
    windows = rolled(keys, words)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(windows[a : b - words + 1]))
        elif b > a:
            out.append(mixed(rolled(keys[a:b], b - a) * MIX + np.uint64(b - a)))
        else:
            out.append(keys[:0])
    return out


def class_key(shingles: np.ndarray) -> int | None:
    """Key of all documents with the same set; null for the empty set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True) if len(shingles) else None


def prefix_size(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` of which a linked set must hold one: it shares at least ``percent`` of them."""
    return n - (n * percent + 99) // 100 + 1


def linked(inter, n, m, percent: int):
    return 100 * inter >= percent * (n + m - inter)


# --- exact joins inside one region -------------------------------------------------------------------------------------


class Region:
    """Sets of one region, joined exactly; ``root`` tells the component of each set."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT, pivots: int = 12, leaf: int = 400):
        self.sets, self.percent, self.pivots, self.leaf = sets, percent, pivots, leaf
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.parent = list(range(len(sets)))
        self.radius = 1 - percent / 100

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def union(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.sets))], np.int64)

    def join(self, rows: np.ndarray | None = None, depth: int = 0) -> None:
        rows = np.arange(len(self.sets)) if rows is None else rows
        if len(rows) <= self.leaf or depth > 6 or (cells := self._cells(rows)) is None:
            self._exact(rows)
            return
        for cell in cells:
            self.join(cell, depth + 1)

    def _cells(self, rows: np.ndarray) -> list[np.ndarray] | None:
        """Regions of a few pivots with their boundary sets; None if they would hardly be smaller than the whole."""
        chosen = rows[np.linspace(0, len(rows) - 1, self.pivots).astype(int)]
        tokens = np.concatenate([self.sets[i] for i in rows])
        starts = np.concatenate([[0], np.cumsum(self.sizes[rows])])[:-1]
        inter = np.stack([np.add.reduceat(_member(tokens, self.sets[p]).astype(np.int64), starts) for p in chosen], axis=1)
        for k, p in enumerate(chosen):
            for i in rows[linked(inter[:, k], self.sizes[rows], self.sizes[p], self.percent)]:
                self.union(int(p), int(i))
        cells = [rows[c] for c in voronoi(distances(inter, self.sizes[rows], self.sizes[chosen]), self.radius)]
        cells = [c for c in cells if len(c) > 1 and len({self.find(int(i)) for i in c}) > 1]
        return cells if all(len(c) <= 0.8 * len(rows) for c in cells) and sum(map(len, cells)) <= 3 * len(rows) else None

    def _exact(self, rows: np.ndarray) -> None:
        """All pairs that could still join two components, counted through an inverted index of the rows' shingles."""
        if len(rows) < 2:
            return
        tokens, codes = np.unique(np.concatenate([self.sets[i] for i in rows]), return_inverse=True)
        sizes = self.sizes[rows]
        owner = np.repeat(np.arange(len(rows)), sizes)
        order = np.argsort(codes, kind="stable")
        postings, first = owner[order], np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(tokens)))])
        ends = np.cumsum(sizes)
        done = np.zeros(len(rows), bool)

        def meet(i: int) -> None:
            done[i] = True
            own = codes[ends[i] - sizes[i] : ends[i]]
            counts = first[own + 1] - first[own]
            at = np.repeat(first[own] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
            inter = np.bincount(postings[at], minlength=len(rows))
            for j in np.flatnonzero(linked(inter, sizes[i], sizes, self.percent)):
                self.union(int(rows[i]), int(rows[j]))

        # a pair needs no look once both ends are in one component: all sets outside the largest one meet all others
        for i in range(0, len(rows), max(1, len(rows) // 8)):
            meet(i)
        roots = [self.find(int(r)) for r in rows]
        values, counts = np.unique(roots, return_counts=True)
        main = int(values[np.argmax(counts)])
        for i in range(len(rows)):
            if not done[i] and self.find(int(rows[i])) != self.find(main):
                meet(i)


def _member(tokens: np.ndarray, members: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(members, tokens), len(members) - 1)
    return members[at] == tokens


def distances(inter: np.ndarray, sizes: np.ndarray, pivot_sizes: np.ndarray) -> np.ndarray:
    """(sets, pivots) Jaccard distances from the sizes of the intersections."""
    return 1 - inter / (sizes[:, None] + pivot_sizes[None, :] - inter)


def voronoi(d: np.ndarray, radius: float) -> list[np.ndarray]:
    """Rows of each pivot's region and, last, of the region far from all pivots.

    A row lives with its nearest pivot if that is within HALF, else far away. If x lives with p and y is within ``radius``
    of x, then d(y, p) <= HALF + radius, and d(y, p) <= d(x, p) + radius <= d(x, q) + radius <= d(y, q) + 2 radius for y's
    own pivot q; so y visits every region that keeps both windows, and each linked pair meets where one of them lives.
    """
    nearest = d.min(axis=1)
    home = np.where(nearest <= HALF, d.argmin(axis=1), -1)
    window = np.where(home >= 0, nearest + 2 * radius, 1.0)
    cells = []
    for p in range(d.shape[1]):
        visits = (d[:, p] <= HALF + radius + 1e-9) & (d[:, p] <= window + 1e-9)
        cells.append(np.flatnonzero((home == p) | visits))
    return [*cells, np.flatnonzero(home < 0)]


# --- signatures and candidate regions over all documents -----------------------------------------------------------------


def common_shingles(rows: DataFrame, sample: int, least: int = 4, most: int = 1 << 20, words: int = WORDS) -> np.ndarray:
    """Shingles that many of the sets share, from a sample of at most about ``sample`` sets (by hash): they are put last in
    the order of shingles. The order decides how much is compared, never what is found."""
    count = rows.count()
    share = min(1.0, sample / count) if count else 1.0
    picked = rows.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def count_up(batches):
        seen = []
        for batch in slices(batches, "text"):
            seen += shingle_sets(batch.column("text"), words)
        if seen:
            tokens, counts = np.unique(np.concatenate(seen), return_counts=True)
            part = (tokens >> np.uint64(40)) % np.uint64(64)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(65))
            for b in range(64):
                at = order[edges[b] : edges[b + 1]]
                yield pa.RecordBatch.from_pydict({"part": [b], "tokens": [tokens[at].tobytes()], "counts": [counts[at].astype(np.int32).tobytes()]})

    def often(held: pa.Table) -> pa.Table:
        tokens = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in held["tokens"]])
        counts = np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in held["counts"]])
        names, at = np.unique(tokens, return_inverse=True)
        sums = np.bincount(at, weights=counts).astype(np.int64)
        keep = sums >= least
        return pa.table({"token": names[keep].view(np.int64), "n": sums[keep]})

    found = picked.select("text").mapInArrow(count_up, "part long, tokens binary, counts binary").groupBy("part").applyInArrow(often, "token long, n long")
    top = found.orderBy(F.col("n").desc(), "token").limit(most).toPandas()  # at most ``most`` numbers
    return np.sort(top["token"].to_numpy(np.int64).view(np.uint64))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``n`` (size of the set) and ``key`` (the same for equal sets) of every document."""

    def sign(batches):
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), words)
            arrays = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_key(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "key"])

    return docs.mapInArrow(sign, "doc_id long, n long, key long")


def _small(numbers: np.ndarray) -> bytes:
    """Counts in one byte each, or four where one is too few; where most are 0, only the others, with the gaps before them."""
    wide = len(numbers) and numbers.max() > 255
    kind, at = np.uint32 if wide else np.uint8, np.flatnonzero(numbers)
    gaps = np.diff(at, prepend=-1)
    far = len(gaps) and gaps.max() > 255
    if len(at) * ((4 if far else 1) + (4 if wide else 1)) + 8 < len(numbers) * (4 if wide else 1):
        head = np.array([len(numbers), len(at)], "<u4").tobytes()
        return bytes([(5 if wide else 2) + bool(far) * 4]) + head + gaps.astype("<u4" if far else np.uint8).tobytes() + numbers[at].astype(kind).tobytes()
    return bytes([4 if wide else 1]) + numbers.astype(kind).tobytes()


def _counts(packed: bytes) -> np.ndarray:
    kind = packed[0]
    if kind in (1, 4):
        return np.frombuffer(packed, np.uint32 if kind == 4 else np.uint8, offset=1).astype(np.int64)
    size, some = np.frombuffer(packed, "<u4", 2, 1).tolist()
    far, wide = kind in (6, 9), kind in (5, 9)
    gaps = np.frombuffer(packed, "<u4" if far else np.uint8, some, 9)
    out = np.zeros(size, np.int64)
    out[np.cumsum(gaps, dtype=np.int64) - 1] = np.frombuffer(packed, np.uint32 if wide else np.uint8, some, 9 + gaps.nbytes)
    return out


def sharing_classes(docs: DataFrame, percent: int, words: int, buckets: int, among=None) -> DataFrame:
    """``key`` of the sets of which at least ``percent`` of the shingles occur in other documents too.

    ``among`` (see ``key_filter``) names the documents that stand for their class: without it, a copy of a set anywhere
    makes all of its shingles look shared, and nothing drops out of a table that repeats its texts.
    A set with fewer of them can't be linked to any other, as it can't share more than them. Shingles go to buckets as
    three bytes each, about a million to a bucket, so that chance may make a few of them look shared, never the other way.
    Each chunk of documents sends a set once, however many copies it holds, and gets back one count per set and bucket.
    Chunks grow with the buckets, and counts of 0 are left out where most are, so that rows and counts stay in proportion.
    """
    most = min(1 << 21, max(1 << 18, buckets << 11))

    def chunks(batches):
        sets, size = {}, 0
        for batch in slices(batches if among is None else (b.filter(pa.array(among(b.column("doc_id").to_numpy()))) for b in batches), "text"):
            for s in shingle_sets(batch.column("text"), words):
                if len(s) and (key := class_key(s)) not in sets:
                    sets[key] = s
                    size += len(s)
            if size >= most:
                yield sets
                sets, size = {}, 0
        if sets:
            yield sets

    def spread(batches):
        part = TaskContext.get().partitionId()
        for number, sets in enumerate(chunks(batches)):
            keys, sizes = np.array(list(sets), np.int64), np.array([len(s) for s in sets.values()], np.int64)
            codes = mixed(np.concatenate(list(sets.values())))
            bucket = ((codes >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            owner = np.repeat(np.arange(len(keys)), sizes)[order]
            three = (codes[order] & np.uint64(0xFFFFFF)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            chunk = (part << 32) | number
            rows = [(b, three[x:y].tobytes(), _small(np.bincount(owner[x:y], minlength=len(keys))), b == chunk % buckets) for b, x, y in zip(range(buckets), edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            rows = [r for r in rows if r[1] or r[3]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([chunk] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary()),
                    pa.array([keys.tobytes() if r[3] else None for r in rows], pa.binary()), pa.array([sizes.tobytes() if r[3] else None for r in rows], pa.binary()),
                ],
                names=["bucket", "chunk", "codes", "counts", "keys", "sizes"],
            )

    def flag(held: pa.Table) -> pa.Table:
        raw = np.frombuffer(b"".join(held["codes"].to_pylist()), np.uint8).reshape(-1, 3).astype(np.uint32)
        codes = raw[:, 0] | raw[:, 1] << 8 | raw[:, 2] << 16
        _, at, times = np.unique(codes, return_inverse=True, return_counts=True)
        shared = np.concatenate([[0], np.cumsum(times[at] > 1)])
        out, start = [], 0
        for packed in held["counts"].to_pylist():
            ends = start + np.cumsum(_counts(packed))
            out.append(_small(np.diff(shared[np.concatenate([[start], ends])])))
            start = int(ends[-1])
        return pa.table({"chunk": held["chunk"], "counts": pa.array(out, pa.binary()), "keys": held["keys"], "sizes": held["sizes"]})

    def total(held: pa.Table) -> pa.Table:
        shared = sum(_counts(c) for c in held["counts"].to_pylist())
        keys, sizes = (np.frombuffer(next(x for x in held[c].to_pylist() if x is not None), np.int64) for c in ("keys", "sizes"))
        return pa.table({"key": pa.array(keys[100 * shared >= percent * sizes])})

    kind = "bucket long, chunk long, codes binary, counts binary, keys binary, sizes binary"
    flagged = docs.select("doc_id", "text").mapInArrow(spread, kind).groupBy("bucket").applyInArrow(flag, "chunk long, counts binary, keys binary, sizes binary")
    return flagged.groupBy("chunk").applyInArrow(total, "key long").distinct()


def prefixed(rows: DataFrame, common: np.ndarray, percent: int, words: int) -> DataFrame:
    """``key``, ``n`` and ``prefix`` of every set: of its shingles, rare ones first and by hash, as many as any linked set
    must share at least one of."""

    def sign(batches):
        for batch in slices(batches, "text"):
            prefixes = []
            for s in shingle_sets(batch.column("text"), words):
                often = _member(s, common) if len(common) else np.zeros(len(s), bool)
                prefixes.append(np.concatenate([s[~often], s[often]])[: prefix_size(len(s), percent)].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n"), pa.array(prefixes, pa.binary())], names=["key", "n", "prefix"])

    return rows.select("key", "n", "text").mapInArrow(sign, "key long, n long, prefix binary")


def candidate_links(classes: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Links between sets that share a shingle of their prefixes and could be alike by size, reduced to stars.

    A single shingle is the pivot here: the sets with it in their prefix are its region, and a linked pair shares at least
    one such region. Within it, sets stand in the order of size; neighbours whose sizes allow a link are joined, which joins
    every pair that could be linked, and only a forest of the bucket's links is handed on.
    """

    def spread(batches):
        for batch in slices(batches, "prefix"):
            lengths = np.array([len(p) // 8 for p in batch.column("prefix").to_pylist()], np.int64)
            tokens = np.frombuffer(b"".join(batch.column("prefix").to_pylist()), np.uint64)
            keys = np.repeat(batch.column("key").to_numpy(), lengths)
            sizes = np.repeat(batch.column("n").to_numpy(), lengths).astype(np.int32)
            bucket = (mixed(tokens) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            names, starts = np.unique(bucket[order], return_index=True)
            parts = np.split(order, starts[1:]) if len(names) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(names)] + [pa.array([x[p].tobytes() for p in parts], pa.binary()) for x in (tokens, keys, sizes)], names=["bucket", "tokens", "keys", "sizes"]
            )

    def chain(held: pa.Table) -> pa.Table:
        tokens, keys, sizes = (np.frombuffer(b"".join(held[c].to_pylist()), t) for c, t in (("tokens", np.uint64), ("keys", np.int64), ("sizes", np.int32)))
        order = np.lexsort((keys, sizes, tokens))
        tokens, keys, sizes = tokens[order], keys[order], sizes[order].astype(np.int64)
        near = (tokens[1:] == tokens[:-1]) & (100 * sizes[:-1] >= percent * sizes[1:])
        pairs = np.unique(np.stack([keys[:-1][near], keys[1:][near]], axis=1), axis=0)
        parent: dict[int, int] = {}

        def find(i):
            while (up := parent.setdefault(i, i)) != i:
                parent[i] = i = parent[up]
            return i

        for a, b in pairs.tolist():
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        ends = [(i, find(i)) for i in list(parent)]
        ends = [(i, r) for i, r in ends if i != r]
        return pa.table({"a": pa.array([e[0] for e in ends], pa.int64()), "b": pa.array([e[1] for e in ends], pa.int64())})

    kind = "bucket long, tokens binary, keys binary, sizes binary"
    return classes.mapInArrow(spread, kind).groupBy("bucket").applyInArrow(chain, "a long, b long")


# --- joins of regions ----------------------------------------------------------------------------------------------------


def _sets_of(held: pa.Table, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys and sets of a region's rows, each set once."""
    keys, sets, seen = [], [], set()
    for batch in slices(held.to_batches(), "text"):
        for k, s in zip(batch.column("key").to_pylist(), shingle_sets(batch.column("text"), words), strict=True):
            if k not in seen:
                seen.add(k)
                keys.append(k)
                sets.append(s)
    return np.array(keys, np.int64), sets


def _joiner(percent: int, words: int):
    def join(held: pa.Table) -> pa.Table:
        keys, sets = _sets_of(held, words)
        region = Region(sets, percent)
        region.join()
        roots = keys[region.roots()] if len(keys) else keys
        other = keys != roots
        return pa.table({"a": pa.array(keys[other], pa.int64()), "b": pa.array(roots[other], pa.int64())})

    return join


def region_links(rows: DataFrame, percent: int, words: int, bound: int, pivots: int = 16, most_depth: int = 8) -> tuple[DataFrame, bool]:
    """(links, whole): stars of the linked sets of every region. ``rows`` has ``region``, ``key``, ``n``, ``text``.

    Regions of at most ``bound`` shingles are joined in one task each, and their stars are their components (whole).
    Larger ones are cut around pivots: each row goes to the region of its nearest pivot and to those whose windows it is in;
    cells still too large are cut again. A region that pivots do not make smaller is joined in pairs of blocks.
    """
    links, whole = None, True

    def add(part):
        nonlocal links
        links = part if links is None else links.union(part)

    for depth in range(most_depth + 1):
        sizes = rows.groupBy("region").agg(F.sum("n").alias("total"))
        large = materialize(sizes.where(F.col("total") > bound), "jaccard-large")
        if large.isEmpty():
            add(rows.groupBy("region").applyInArrow(_joiner(percent, words), "a long, b long"))
            return links, whole
        whole = False
        add(rows.join(large, "region", "left_anti").groupBy("region").applyInArrow(_joiner(percent, words), "a long, b long"))
        over = rows.join(large, "region")
        if depth == most_depth:
            add(_block_pairs(over, percent, words, bound))
            return links, whole
        cells, direct, stuck = _cut(over, large, percent, words, pivots)
        add(direct)
        if stuck is not None:
            add(_block_pairs(stuck, percent, words, bound))
        rows = cells
    return links, whole


def _cut(over: DataFrame, large: DataFrame, percent: int, words: int, pivots: int):
    """Cells of too large regions around pivots, links to pivots, and rows of regions that did not get smaller.

    Pivots are the rows with the smallest hash, ``pivots`` per region; there are at most total / bound such regions. Their
    sets travel with the rows by a join on the region, so nothing is collected."""
    place = Window.partitionBy("region").orderBy(F.xxhash64("key", "region"), "key")
    chosen = over.select("region", "key", "text").withColumn("_r", F.row_number().over(place)).where(F.col("_r") <= pivots)

    def make(held: pa.Table) -> pa.Table:
        keys, sets = _sets_of(held, words)
        data = np.concatenate([s for s in sets]).tobytes() if sets else b""
        return pa.table({"region": held["region"].slice(0, 1), "pivots": pa.array([keys.tobytes()], pa.binary()), "lengths": pa.array([np.array([len(s) for s in sets], np.int64).tobytes()], pa.binary()), "sets": pa.array([data], pa.binary())})

    held = materialize(chosen.select("region", "key", "text").groupBy("region").applyInArrow(make, "region long, pivots binary, lengths binary, sets binary"), "jaccard-pivots")
    radius = 1 - percent / 100

    def place_rows(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        keys = np.frombuffer(theirs["pivots"][0].as_py(), np.int64)
        lengths = np.frombuffer(theirs["lengths"][0].as_py(), np.int64)
        flat = np.frombuffer(theirs["sets"][0].as_py(), np.uint64)
        pivot_sets = np.split(flat, np.cumsum(lengths)[:-1])
        out = []
        for batch in slices(mine.to_batches(), "text"):
            sets = shingle_sets(batch.column("text"), words)
            sizes = np.array([len(s) for s in sets], np.int64)
            inter = np.array([[int(_member(s, p).sum()) for p in pivot_sets] for s in sets], np.int64).reshape(len(sets), len(keys))
            region = batch.column("region")[0].as_py()
            for i, cell in enumerate(voronoi(distances(inter, sizes, lengths), radius)):
                name = int(mixed(np.array([region], np.int64).view(np.uint64) * MIX + np.uint64(i + 1)).view(np.int64)[0])
                if len(cell):
                    got = batch.take(pa.array(cell))
                    to = [int(keys[i]) if i < len(keys) and linked(inter[c, i], sizes[c], lengths[i], percent) else None for c in cell]
                    out.append(pa.table({"parent": got.column("region"), "region": pa.array([name] * len(cell), pa.int64()), "key": got.column("key"), "n": got.column("n"), "text": got.column("text"), "pivot": pa.array(to, pa.int64())}))
        return pa.concat_tables(out) if out else pa.table({c: pa.array([], t) for c, t in (("parent", pa.int64()), ("region", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("text", pa.string()), ("pivot", pa.int64()))})

    # shares of a region of about equal size, each with a copy of the pivots
    parts = large.withColumn("_parts", F.greatest(F.lit(1), F.ceil(F.col("total") / (1 << 20))).cast("int"))
    mine = over.join(parts.select("region", "_parts"), "region").withColumn("_part", F.pmod(F.xxhash64("key", F.lit(5)), F.col("_parts")).cast("long"))
    theirs = held.join(parts, "region").withColumn("_part", F.explode(F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda i: i.cast("long"))))
    grouped = mine.select("region", "_part", "key", "n", "text").groupBy("region", "_part").cogroup(theirs.select("region", "_part", "pivots", "lengths", "sets").groupBy("region", "_part"))
    placed = materialize(grouped.applyInArrow(place_rows, "parent long, region long, key long, n long, text string, pivot long"), "jaccard-cells")
    direct = placed.where("pivot is not null").select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    cells = placed.groupBy("parent", "region").agg(F.sum("n").alias("cell"))
    worst = cells.groupBy("parent").agg(F.max("cell").alias("most"), F.sum("cell").alias("all")).join(large.select(F.col("region").alias("parent"), "total"), "parent")
    still = materialize(worst.where("most > 0.8 * total or all > 4 * total").select("parent"), "jaccard-stuck")
    fine = placed.join(still, "parent", "left_anti").select("region", "key", "n", "text")
    stuck = None if still.isEmpty() else over.join(still.withColumnRenamed("parent", "region"), "region").select("region", "key", "n", "text", "total")
    return fine, direct, stuck


def _block_pairs(rows: DataFrame, percent: int, words: int, bound: int) -> DataFrame:
    """Joins of all pairs of blocks of half a bound: exact whatever the region looks like.

    The blocks are written to the shared folder once; a task reads the two blocks of each of its pairs there, so disk grows
    with the rows, not with the pairs."""
    spark = rows.sparkSession
    blocks = F.ceil(F.col("total") * 2 / bound).cast("int")
    own = rows.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("key", F.lit(9)), F.col("_blocks")).cast("int"))
    path = scratch_path(spark, "jaccard-blocks")
    dealt = own.select("region", "_own", "key", "text").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "region", "_own")
    dealt.write.partitionBy("region", "_own").parquet(path)
    held = materialize(own.select("region", "_own").distinct(), "jaccard-block-names")
    pairs = held.withColumnRenamed("_own", "_a").join(held.withColumnRenamed("_own", "_b"), "region").where("_a <= _b")
    alone = held.groupBy("region").count().where("count = 1").select("region")
    pairs = materialize(pairs.where("_a < _b").union(pairs.join(alone, "region", "left_semi").select("region", "_a", "_b")), "jaccard-block-pairs")
    join = _joiner(percent, words)

    def run(batches):
        for batch in batches:
            for region, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                parts = [x for block in sorted({a, b}) for x in parquet_blocks(f"{path}/region={region}/_own={block}", ["key", "text"], 4096)]
                yield from join(pa.Table.from_batches(parts)).to_batches()

    tasks = max(1, min(pairs.count(), 4096))
    spread = pairs.select("region", "_a", "_b").repartition(tasks, F.xxhash64("region", "_a", "_b"))
    return spread.mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, bound: int = 4 << 20, bucket: int = 500_000, sample: int = 32_768) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every document (``doc_id``, ``text``).

    Documents link when their sets of ``words``-word shingles have a Jaccard similarity of at least ``percent`` per cent;
    the component is the smallest doc_id reachable by links. Documents with the same set are one class, so copies are
    never compared. Sets of classes are compared by 64-bit hashes of shingles. Sets that share too few shingles with any
    other drop out first. Every linked pair of the rest shares a shingle pivot's region; connected candidate regions are
    joined exactly, see ``region_links``.

    Null texts and texts without words have an empty set and link with nothing; documents with null ids link nobody and
    have a null component; rows that repeat an id with another text are documents of that id. Empty tables give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(signatures(texts, words), "jaccard-signatures")
    real = signed.where("key is not null and doc_id is not null")
    classes = materialize(real.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.any_value("n").alias("n")), "jaccard-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    known = texts.where("doc_id is not null")
    sharing = sharing_classes(known, percent, words, max(1, -(-int(total) // (1 << 20))), key_filter(classes, "doc_id"))
    wanted = materialize(classes.join(sharing, "key"), "jaccard-sharing")
    rows = materialize(texts_of(wanted, known, words), "jaccard-texts")
    common = common_shingles(rows, sample, words=words)
    held = wanted.agg(F.sum("n")).first()[0] or 0
    near = stars(candidate_links(prefixed(rows, common, percent, words), percent, max(1, int(held) * (100 - percent) // 100 // bucket + 1)))
    members = near.select(F.col("hi").alias("key"), F.col("lo").alias("region")).union(near.select("lo", "lo").distinct())
    members = F.broadcast(members) if near.count() <= FEW else members
    links, whole = region_links(rows.join(members, "key").select("region", "key", "n", "text"), percent, words, bound)
    found = materialize(links.select(F.col("a").alias("hi"), F.col("b").alias("lo")), "jaccard-links") if whole else stars(links)
    placed = classes.join(found, classes["key"] == found["hi"], "left").select("key", "doc_id", F.coalesce("lo", "key").alias("root"))
    placed = materialize(placed, "jaccard-placed")
    names = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(names, "root").select(F.col("key").alias("_key"), "component_id")
    out = signed.join(named, (signed["key"] == F.col("_key")) & signed["doc_id"].isNotNull(), "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def key_filter(wanted: DataFrame, column: str, per_key: int = 12, most_bytes: int = 32 << 20):
    """A function that tells which keys of an array may be in ``wanted``, by a Bloom filter of ``per_key`` bits a key that
    travels with it; None where that exceeds ``most_bytes``."""
    bits = max(1024, wanted.count() * per_key)
    if bits > most_bytes * 8:
        return None
    segment = 1 << 19

    def places(keys: np.ndarray) -> np.ndarray:
        one = mixed(keys.astype(np.int64).view(np.uint64) + np.uint64(1))
        two = mixed(one ^ MIX) | np.uint64(1)
        return ((one[None] + np.arange(5, dtype=np.uint64)[:, None] * two[None]) % np.uint64(bits)).astype(np.int64)

    def fill(batches):
        held = [b.column(0).to_numpy() for b in batches]
        at = np.unique(places(np.concatenate(held))) if held else np.zeros(0, np.int64)
        cuts = np.searchsorted(at, np.arange(0, bits + segment, segment))
        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if b > a:
                yield pa.RecordBatch.from_pydict({"segment": [i], "at": [(at[a:b] - i * segment).astype(np.uint32).tobytes()]})

    def unite(held: pa.Table) -> pa.Table:
        field = np.zeros(segment, np.uint8)
        for x in held["at"].to_pylist():
            field[np.frombuffer(x, np.uint32)] = 1
        return pa.table({"segment": held["segment"].slice(0, 1), "at": pa.array([np.packbits(field, bitorder="little").tobytes()], pa.binary())})

    kind = "segment long, at binary"
    parts = wanted.select(column).mapInArrow(fill, kind).groupBy("segment").applyInArrow(unite, kind).collect()  # the filter
    table = np.zeros(-(-bits // segment) * segment // 8, np.uint8)
    for r in parts:
        table[r["segment"] * segment // 8 : (r["segment"] + 1) * segment // 8] = np.frombuffer(r["at"], np.uint8)

    def among(keys: np.ndarray) -> np.ndarray:
        at = places(keys)
        return ((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0).astype(bool)

    return among


def texts_of(wanted: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``key``, ``n``, ``text`` of at least one document of every class of ``wanted`` (``key``, ``doc_id``), and of few others.

    Filters of ids and of keys pick the rows, so that texts need no shuffle; what they let pass beside is compared like the
    rest and changes nothing. Where the filters are too large, ids are joined."""
    ids = key_filter(wanted, "doc_id")
    names = None if ids is None else key_filter(wanted, "key")
    if names is None:
        return of_class(wanted.join(texts, "doc_id"), words)

    def keep(batches):
        for batch in slices((b.filter(pa.array(ids(b.column("doc_id").to_numpy()))) for b in batches), "text"):
            sets = [(i, s) for i, s in enumerate(shingle_sets(batch.column("text"), words)) if len(s)]
            keys = np.array([class_key(s) for _, s in sets], np.int64)
            here = np.flatnonzero(names(keys))
            text = batch.column("text").take(pa.array([sets[i][0] for i in here], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys[here]), pa.array([len(sets[i][1]) for i in here], pa.int64()), text], names=["key", "n", "text"])

    return texts.select("doc_id", "text").mapInArrow(keep, "key long, n long, text string")


def of_class(rows: DataFrame, words: int) -> DataFrame:
    """``key``, ``n``, ``text`` of the rows whose text has the set ``key``: a repeated doc_id brings other texts along."""

    def keep(batches):
        for batch in slices(batches, "text"):
            same = [class_key(s) == k if len(s) else False for s, k in zip(shingle_sets(batch.column("text"), words), batch.column("key").to_pylist(), strict=True)]
            yield batch.filter(pa.array(same, pa.bool_()))

    return rows.select("key", "n", "text").mapInArrow(keep, "key long, n long, text string")
