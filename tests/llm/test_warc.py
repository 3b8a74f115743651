"""WARC: round trips, revisits, and what a damaged archive still gives."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from transitlake.llm import warc
from transitlake.session import scratch_dir

BIG = "<html>" + "a page that is long enough to be revisited " * 4 + "</html>"
PAGES = [(5, "http://a.example/x", BIG), (3, "http://b.example/y", BIG), (9, None, BIG), (3, "http://b.example/y", BIG), (None, "http://n", BIG),
         (1, "http://c d\r\nX: y", "short"), (2, "u", "short"), (4, "u", None), (6, "", ""), (7, "é?ü#\x01", "日本語 ß " * 30), (8, "z", "x" * 3_000_000),
         (None, None, None), (10, "w", "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:666>\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 3)]
SCHEMA = "page_id long, url string, html string"


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) by plain Python."""
    least = {}
    for key, _, html in rows:
        if key is not None:
            least[html or ""] = min(key, least.get(html or "", key))
    for key, _, html in rows:
        data = (html or "").encode()
        first = least.get(html or "") if len(data) >= 100 else None
        again = first is not None and first != key
        yield (key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None)


def found(records):
    rows = records.where("record_type IN ('response', 'revisit')").select(
        F.col("record_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long")).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("size", [1 << 26, 1])
def test_round_trip(spark, size):
    pages = spark.createDataFrame(PAGES, SCHEMA).selectExpr("*", "1 AS key", "2 AS digest", "3 AS first", "4 AS least", "5 AS hot", "6 AS meet", "7 AS payload")
    archives = warc.write_archives(pages, scratch_dir(spark, "warc"), archive_bytes=size)
    records = warc.read_archives(archives)
    assert found(records) == sorted(expected(PAGES), key=repr)
    assert archives.agg(F.sum("records")).first()[0] == len(PAGES) and (size > 1 or archives.count() == len(PAGES))
    assert records.where("reason IS NOT NULL").count() == 0
    texts = {r["record_id"]: bytes(r["payload"]).decode() for r in records.where("record_type = 'response'").collect()}
    assert texts["7"] == PAGES[9][2] and texts["3"] == BIG and texts["4"] == ""
    urls = {r["record_id"]: r["target_uri"] for r in records.collect()}
    assert urls["9"] is None and urls["6"] == "" and urls["1"] == "http://c%20d%0D%0AX:%20y"


def test_empty_table_and_no_archive(spark):
    archives = warc.write_archives(spark.createDataFrame([], SCHEMA), scratch_dir(spark, "warc"))
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0


def test_hot_payload_is_not_joined(spark):
    """A third of all rows share a payload: they get its least id without meeting in one task."""
    rows = spark.range(3000).select(F.col("id").alias("key"), F.lit("u").alias("url"),
                                    F.when(F.col("id") % 3 == 0, BIG).otherwise(F.concat(F.lit(BIG), F.floor(F.col("id") / 2).cast("string"))).cast("binary").alias("payload"))
    got = warc.with_first(rows, 100)
    firsts = {r["key"]: r["first"] for r in got.collect()}
    assert all(firsts[k] == (0 if k else None) for k in range(0, 3000, 3))
    assert all(firsts[k] == (k - 1 if k % 2 and k % 3 == 2 else None) for k in range(3000) if k % 3)
    most = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 1200


def plain_record(key, payload, **extra):
    return warc.page_record(str(key), "http://x", payload, hashlib.sha256(payload).hexdigest(), None, "2024-01-01T00:00:00Z")


def kept(data, compressed=True):
    items = list(warc.salvaged(warc.InMemory(data), compressed))
    records = [i for i in items if isinstance(i, warc.Record)]
    gaps = [i for i in items if isinstance(i, warc.Gap)]
    spans = sorted((i.start, i.end) for i in items)
    assert spans[0][0] == 0 and spans[-1][1] == len(data)
    assert all(b == a for (_, b), (a, _) in zip(spans, spans[1:]))  # every byte is in a record or in a gap
    return [r.fields["warc-record-id"] for r in records], gaps


@pytest.mark.parametrize("compressed", [True, False])
def test_any_damage_costs_only_what_it_hits(compressed):
    rng = random.Random(3)
    payloads = [rng.randbytes(rng.choice([0, 10, 700, 90_000])) for _ in range(12)]
    parts = [plain_record(k, p) for k, p in enumerate(payloads)]
    parts = [warc.member(p) for p in parts] if compressed else parts
    starts = [sum(map(len, parts[:k])) for k in range(13)]
    names = [f"<urn:record:{k}>" for k in range(12)]
    whole = b"".join(parts)
    assert kept(whole, compressed) == (names, [])
    for _ in range(40):
        at, width = rng.randrange(len(whole)), rng.choice([1, 5, 300])
        kind = rng.choice(["flip", "cut", "insert", "truncate"])
        if kind == "flip":
            data = whole[:at] + bytes(b ^ 0x55 for b in whole[at:at + width]) + whole[at + width:]
        elif kind == "cut":
            data = whole[:at] + whole[at + width:]
        elif kind == "insert":
            data = whole[:at] + rng.randbytes(width) + whole[at:]
        else:
            data, width = whole[:at], len(whole)
        hit = {k for k in range(12) if starts[k] < at + width and at < starts[k + 1]}
        found, gaps = kept(data, compressed)
        sound = [n for k, n in enumerate(names) if k not in hit]
        # a plain header has no checksum: a changed letter of a field goes unseen
        assert [n for n in found if n in sound] == sound and len(found) <= 12
        if compressed and kind == "flip":
            assert len(gaps) <= 1


def test_reasons_and_certain_ends():
    inner = plain_record(666, b"an archive within a payload")
    outer = plain_record(1, inner)
    broken = outer.replace(b"within", b"w1thin")
    names, gaps = kept(broken + plain_record(2, b"x"), False)
    assert names == ["<urn:record:2>"] and gaps == [(0, len(broken), "block digest")]  # 666 is no record of this archive
    names, gaps = kept(warc.member(broken) + warc.member(outer))
    assert names == ["<urn:record:1>"] and [g.reason for g in gaps] == ["block digest"]
    both = warc.member(plain_record(1, b"a") + broken + plain_record(3, b"c"))
    names, gaps = warc_names = kept_many(both)
    assert names == ["<urn:record:1>", "<urn:record:3>"] and [g.reason for g in gaps] == ["block digest"], warc_names
    for data, reason in ((b"", None), (b"junk", "member"), (warc.member(b"junk that is no record"), "version"),
                         (warc.member(outer)[:-3], "truncated"), (gzip.compress(b"")[:5], "truncated")):
        gaps = [i for i in warc.salvaged(warc.InMemory(data), True)]
        assert [g.reason for g in gaps] == ([reason] if reason else [])
    for old, new, reason in ((b"Content-Length: ", b"Content-Length: 9", "truncated"), (b"Content-Length: ", b"Content-Length: x", "length"),
                             (b"WARC-Type: response", b"WARC-Tipe: response", "fields"), (b"WARC/1.1", b"WARC/7.1", "version"),
                             (b"WARC-Type: response", b"WARC-Type response!", "header")):
        [gap] = warc.salvaged(warc.InMemory(plain_record(1, b"text").replace(old, new, 1)), False)
        assert gap.reason == reason
    # without a certain end, a record inside the payload is as good as any
    names, gaps = kept(outer.replace(b"Content-Length: ", b"Content-Length: 9", 1), False)
    assert names == ["<urn:record:666>"] and [g.reason for g in gaps] == ["truncated", "version"]


def kept_many(data):
    items = list(warc.salvaged(warc.InMemory(data), True))
    return ([i.fields["warc-record-id"] for i in items if isinstance(i, warc.Record)], [i for i in items if isinstance(i, warc.Gap)])


def test_damaged_archives_in_spark(spark):
    from pyarrow import fs

    folder = scratch_dir(spark, "warc")
    archives = warc.write_archives(spark.createDataFrame(PAGES, SCHEMA).coalesce(1), folder, least=1 << 40)
    store, _ = fs.FileSystem.from_uri(folder)
    [name] = [r["archive"] for r in archives.collect()]
    path = fs.FileSystem.from_uri(name)[1]
    with store.open_input_file(path) as file:
        data = bytearray(file.read())
    before = warc.read_archives(archives).where("record_id = '7'").first()
    data[before["offset"] + 30] ^= 0xFF
    with store.open_output_stream(path, compression=None) as out:
        out.write(bytes(data))
    rows = warc.read_archives(archives).collect()
    [gap] = [r for r in rows if r["reason"]]
    assert (gap["offset"], gap["length"]) == (before["offset"], before["length"]) and gap["payload"] is None
    assert len(rows) == len(PAGES) + 1 and not any(r["record_id"] == "7" for r in rows)


def test_other_digests():
    block = b"abc"
    for stated in ("sha1:VGMT4NSHA2AWVOR6EVYXQUGCNSONBWE5", "sha1:a9993e364706816aba3e25717850c26c9cd0d89d", "md5:900150983cd24fb0d6963f7d28e17f72", "blake9:zz", ""):
        assert warc._agrees(stated, block)
    assert not warc._agrees("sha1:VGMT4NSHA2AWVOR6EVYXQUGCNSONBWE6", block)
