"""Archives round trip."""

import gzip
import hashlib

import pytest

from lakeloom.llm import warc
from lakeloom.llm.files import listed, place
from lakeloom.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, first long"
LONG = "x" * 200


def pages():
    rows = [(i, f"http://h{i % 3}.example.com/{i}", LONG if i % 3 == 0 else f"<p>é {i}</p>" * (i + 1), "d", 5) for i in range(60)]
    rows += [(100, None, None, "", 0), (101, "", "", "", 0), (102, "http://a/\r\nWARC-Type: x", "short", "", 0), (103, "u", "short", "", 0), (104, "u", "\r\n\r\nWARC/1.1\r\n" * 50, "", 0), (None, "u", LONG, "", 0)]
    return rows + [rows[0], rows[3], (7, "other", "second payload of page seven" * 9, "", 0), (105, "big", "0123456789" * 30_000, "", 0)]


def expected(rows):
    firsts = {}
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            firsts[data] = min(page, firsts.get(data, page))
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        first = firsts.get(data)
        revisit = page is not None and first is not None and page > first
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1, 4_000, 1 << 30])
def test_round_trip(spark, size):
    rows = pages()
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(3), folder, file_bytes=size, shard_bytes=20_000)
    back = warc.read_warc(spark, manifest, folder, with_payload=True).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back), key=str)
    assert got == expected(rows)
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in back if r["record_type"] == "response")
    files = manifest.orderBy("name").collect()
    assert len(listed(folder, ".warc.gz")) == len(files) and sum(f["records"] for f in files) == len(rows)
    store, top = place(folder)
    ranges = []
    for f in files:
        with store.open_input_file(f"{top}/{f['name']}") as source:
            data = source.read()
        assert len(data) == f["bytes"] and hashlib.sha256(data).hexdigest() == f["sha256"]
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        ranges.append((f["first_id"] if f["first_id"] is not None else -1, f["last_id"] if f["last_id"] is not None else -1))
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_same_bytes_on_every_run(spark):
    df = spark.createDataFrame(pages(), SCHEMA)
    runs = []
    for parts in (2, 5):
        manifest = warc.write_warc(df.repartition(parts), scratch_path(spark, "warc-test"), file_bytes=4_000, shard_bytes=1 << 30)
        runs.append(sorted((r["name"], r["sha256"]) for r in manifest.collect()))
    assert runs[0] == runs[1]


def test_same_files_of_several_shards(spark):
    rows = [(i if i % 50 else None, f"http://x/{i}", f"{i} " * (i % 97), *[None] * (len(SCHEMA.split(",")) - 3)) for i in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    runs = []
    for parts in (2, 7):
        manifest = warc.write_warc(df.repartition(parts, "url"), scratch_path(spark, "warc-test"), file_bytes=60_000, shard_bytes=2_000_000)
        runs.append(sorted((r["name"], r["records"], r["sha256"], r["shard"]) for r in manifest.collect()))
    sizes = {}
    for i, _, html, *_ in rows:
        key = (i is not None, i or 0, hashlib.sha256(html.encode()).hexdigest())
        sizes[key] = sizes.get(key, 0) + len(html)
    before, last, want = 0, 0, []
    for key in sorted(sizes):
        if before // 2_000_000 > last:
            want.append(key)
        last, before = before // 2_000_000, before + sizes[key]
    light = df.selectExpr("page_id", "sha2(coalesce(html, ''), 256) digest", "cast(length(html) as long) size")
    assert runs[0] == runs[1] and len({r[3] for r in runs[0]}) == len(want) + 1 > 2
    assert warc.shard_cuts(light, 2_000_000) == want


def test_empty(spark):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_warc(spark.createDataFrame([], SCHEMA), folder)
    assert manifest.count() == 0 and warc.read_warc(spark, manifest, folder).collect() == []


def test_damage_is_noticed(spark):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_warc(spark.createDataFrame(pages(), SCHEMA), folder)
    store, top = place(folder)
    name = f"{top}/{manifest.first()['name']}"
    with store.open_input_file(name) as f:
        data = f.read()
    with store.open_output_stream(name, compression=None) as f:
        f.write(data[: len(data) // 2])
    with pytest.raises(Exception, match="cut off|incomplete|digest|Error"):
        warc.read_warc(spark, manifest, folder).collect()
