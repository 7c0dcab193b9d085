"""WARC archives: a deterministic sharded writer with temporary names and a manifest, and its reader."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.files import place
from lakeloom.session import materialize

MANIFEST = "shard int, file int, name string, temporary string, records long, bytes long, sha256 string, first_id long, last_id long"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
SMALLEST_REVISITED = 100
DATE = "2000-01-01T00:00:00Z"


def _member(data: bytes, level: int) -> bytes:
    """One gzip member with nothing that changes between runs in its header."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _one_line(text: str) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


def record(page_id, url, payload: bytes, digest: str, first, level: int, revisit: bool) -> bytes:
    """A compressed response or revisit record; headers, lengths and digests follow from the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}:{digest}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{first}:{digest}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return _member("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", level)


def _info(name: str, level: int) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:{name}>\r\nWARC-Date: {DATE}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    return _member(head.encode() + block + b"\r\n\r\n", level)


class _Roller:
    """Files of one shard, each closed once its compressed size passes ``most``."""

    def __init__(self, folder: str, shard: int, attempt: int, most: int, level: int):
        self.store, self.folder = place(folder)
        self.shard, self.attempt, self.most, self.level, self.count, self.out = shard, attempt, most, level, 0, None

    def add(self, page_id, data: bytes):
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.count:05d}.warc.gz"
            temporary = f"_temporary/{self.shard:06d}-{self.attempt}"
            self.store.create_dir(f"{self.folder}/{temporary}", recursive=True)
            self.temporary = f"{temporary}/{self.name}"
            self.out = self.store.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
            self.records, self.bytes, self.sha, self.first = 0, 0, hashlib.sha256(), page_id
            self._put(_info(self.name, self.level))
        self._put(data)
        self.records, self.last = self.records + 1, page_id
        return self.close() if self.bytes >= self.most else None

    def _put(self, data: bytes):
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def close(self):
        if self.out is None:
            return None
        self.out.close()
        self.out, self.count = None, self.count + 1
        return (self.shard, self.count - 1, self.name, self.temporary, self.records, self.bytes, self.sha.hexdigest(), self.first, self.last)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_MANIFEST_ARROW = pa.schema(
    [("shard", pa.int32()), ("file", pa.int32()), ("name", pa.string()), ("temporary", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64())]
)


def _key():
    """Order of the records: null ids first."""
    return F.struct(F.col("page_id").isNotNull().alias("known"), F.coalesce("page_id", F.lit(0).cast("long")).alias("page_id"), F.col("digest").alias("digest"))


def shard_cuts(light: DataFrame, shard_bytes: int) -> list[tuple]:
    """First keys of all shards but the first, by the rows (``page_id``, ``digest``, ``size``) alone: a shard starts where the
    bytes before a key pass a multiple of ``shard_bytes``, whatever ranges the bytes are summed in."""
    total = light.agg(F.sum("size")).first()[0] or 0
    if total <= shard_bytes:
        return []
    sizes = light.groupBy("page_id", "digest").agg(F.sum("size").alias("size")).select(_key().alias("key"), "size")
    ranges = materialize(sizes.repartitionByRange(-(-total // shard_bytes), "key").withColumn("part", F.spark_partition_id()), "warc-ranges")
    sums = ranges.groupBy("part").agg(F.min("key").alias("low"), F.sum("size").alias("size")).orderBy("low").collect()
    below, offsets = 0, []
    for row in sums:
        offsets.append((row["part"], below))
        below += row["size"]
    order = Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    running = ranges.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    offset = light.sparkSession.createDataFrame(offsets, "part int, below long")
    firsts = running.join(offset, "part").groupBy(F.floor((F.col("below") + F.col("before")) / shard_bytes)).agg(F.min("key").alias("key"))
    return sorted(tuple(r["key"]) for r in firsts.collect())[1:]  # one per shard


def shard_of(cuts: list[tuple]):
    """Number of ``cuts`` that are not above a row's key, by bisection."""
    if not cuts:
        return F.lit(0)
    keys = F.array(*[F.struct(F.lit(known).alias("known"), F.lit(i).cast("long").alias("page_id"), F.lit(digest).alias("digest")) for known, i, digest in cuts])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(keys, at + step - 1) <= _key(), at + step).otherwise(at))


def write_warc(pages: DataFrame, folder: str, file_bytes: int = 16 << 20, shard_bytes: int = 32 << 20, level: int = 6) -> DataFrame:
    """Write one record per row of ``pages`` (``page_id``, ``url``, ``html``) below ``folder``; returns the manifest.

    Of records with equal payloads of at least 100 bytes, those with the smallest page_id are responses, others revisits of
    it. Which rows revisit is decided on ids and digests alone; the few decisions then travel with the pages through one
    shuffle by ranges of (page_id, digest), sorted, and meet their page in the writer. Shards hold about ``shard_bytes`` of
    payload, are cut by the rows alone (``shard_cuts``), so that every run writes the same files, and roll files at ``file_bytes`` compressed. Every attempt writes to its own temporary name; the manifest that
    Spark commits lists only attempts that counted, and only those files are renamed. A renamed file is left alone when
    the job is repeated, so a lost executor costs its own shard.

    Null html is an empty payload, null urls have no target header, a null page_id sorts first, cannot be referred to and
    never revisits; rows that repeat the smallest page_id are all responses. An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    light = materialize(rows.select("page_id", "digest", F.length("payload").cast("long").alias("size")), "warc-digests")
    cuts = shard_cuts(light, shard_bytes)
    large = light.where((F.col("size") >= SMALLEST_REVISITED) & F.col("page_id").isNotNull())
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("_last")).where(F.col("_last") > F.col("first")).drop("_last")
    revisits = large.select("page_id", "digest").distinct().join(firsts, "digest").where(F.col("page_id") > F.col("first"))
    decisions = revisits.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "first")
    both = rows.withColumn("first", F.lit(None).cast("long")).unionByName(decisions)
    both = both.withColumn("shard", shard_of(cuts))
    both = both.repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("shard", "page_id", "digest", F.col("first").asc_nulls_last(), "url")

    def write(batches):
        context = TaskContext.get()
        roller = _Roller(folder, 0, context.taskAttemptId(), file_bytes, level)
        decided = None  # (page_id, digest, first) of the last decision row: it comes right before its pages
        for batch in batches:
            for shard, page_id, url, data, digest, first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if shard != roller.shard:
                    done = roller.close()
                    if done:
                        yield _table([done], _MANIFEST_ARROW)
                    roller = _Roller(folder, shard, context.taskAttemptId(), file_bytes, level)
                if first is not None:
                    decided = (page_id, digest, first)
                    continue
                first = decided[2] if decided and decided[:2] == (page_id, digest) else None
                done = roller.add(page_id, record(page_id, url, data, digest, first, level, first is not None))
                if done:
                    yield _table([done], _MANIFEST_ARROW)
        done = roller.close()
        if done:
            yield _table([done], _MANIFEST_ARROW)

    staged = materialize(both.select("shard", "page_id", "url", "payload", "digest", "first").mapInArrow(write, MANIFEST), "warc-staged")

    def commit(batches):
        store, top = place(folder)
        for batch in batches:
            for name, temporary in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if store.get_file_info(f"{top}/{name}").is_file:
                    continue  # an earlier attempt of this task has renamed it
                store.move(f"{top}/{temporary}", f"{top}/{name}")
            yield batch

    staged.mapInArrow(commit, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


class _Members:
    """Decompressed bytes of a file of gzip members, read in pieces."""

    def __init__(self, source, size: int = 1 << 20):
        self.source, self.size, self.raw, self.data, self.unpack = source, size, b"", b"", zlib.decompressobj(31)

    def _more(self) -> bool:
        while True:
            if self.unpack.eof:
                self.raw = self.unpack.unused_data + self.raw
                if not self.raw:
                    self.raw = self.source.read(self.size)
                    if not self.raw:
                        return False
                self.unpack = zlib.decompressobj(31)
            chunk = self.raw or self.source.read(self.size)
            self.raw = b""
            if not chunk:
                return False
            got = self.unpack.decompress(chunk)
            if got:
                self.data += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.data.find(mark)) < 0:
            if not self._more():
                if self.data.strip():
                    raise OSError("a record is cut off")
                return None
        out, self.data = self.data[:at], self.data[at + len(mark) :]
        return out

    def take(self, n: int) -> bytes:
        parts, have = [self.data], len(self.data)
        while have < n:
            self.data = b""
            if not self._more():
                raise OSError("a record is cut off")
            parts.append(self.data)
            have += len(self.data)
        whole = b"".join(parts)
        self.data = whole[n:]
        return whole[:n]


def records(source) -> Iterator[tuple[dict, bytes]]:
    """Headers (lower-case names) and block of every record of an open file."""
    members = _Members(source)
    while (head := members.until(b"\r\n\r\n")) is not None:
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise OSError(f"not a record: {lines[0][:40]!r}")
        names = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = members.take(int(names["content-length"]))
        if members.take(4) != b"\r\n\r\n":
            raise OSError("a record does not end where its length says")
        yield names, block


def _page(uri: str):
    found = uri.strip("<>").split(":")[2]
    return None if found == "None" else int(found)


def read_warc(spark: SparkSession, manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Page records of the files that the manifest lists; digests are checked against blocks and payloads.

    ``payload`` (optional) is null for revisits. Files are dealt one to a task and streamed record by record."""
    kind = RECORDS + (", payload binary" if with_payload else "")
    files = manifest.select("name", "sha256")
    count = max(1, manifest.count())
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())] + ([("payload", pa.binary())] if with_payload else []))

    def read(batches):
        store, top = place(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{top}/{name}", compression=None) as f:
                    for names, block in records(f):
                        if names["warc-type"] == "warcinfo":
                            continue
                        if names["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                            raise OSError(f"{name}: a block does not match its digest")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
                        digest = names["warc-payload-digest"].partition(":")[2]
                        revisit = names["warc-type"] == "revisit"
                        if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise OSError(f"{name}: a payload does not match its digest")
                        row = (_page(names["warc-record-id"]), names.get("warc-target-uri"), names["warc-type"], size, digest, _page(names["warc-refers-to"]) if revisit else None)
                        rows.append(row + ((None if revisit else payload,) if with_payload else ()))
                        held += len(payload) if with_payload else 0
                        if len(rows) >= 10_000 or held >= 8 << 20:
                            yield _table(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield _table(rows, schema)

    return files.repartition(min(count, 100_000)).mapInArrow(read, kind)
