"""Archives against a plain rule, and round trips of their bytes."""

import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from watchfold.llm import warc
from watchfold.sources.files import open_filesystem

PAGES = "page_id long, url string, html string"
BIG = "<p>" + "text é " * 300
ROWS = [
    (1, "http://a.example/", BIG),
    (2, "http://b.example/x y\r\nz", BIG),
    (7, None, BIG),
    (7, None, BIG),
    (3, "http://c.example/", "small"),
    (4, "http://d.example/", "small"),
    (5, None, None),
    (6, "", ""),
    (8, "http://e.example/", "x" * 1000),
    (9, "http://e.example/", "x" * 1000),
    (10, "http://e.example/", "x" * 999),
    (11, "http://e.example/", "x" * 999),
    (12, "http://f.example/", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
    (13, "http://g.example/", "y" * 3_000_000),
    (None, "http://h.example/", BIG),
    (None, "http://h.example/", "z" * 2000),
    (2, "http://b.example/2", "another page of the same id"),
]


def brute(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page is not None:
            first[data] = max(page, first.get(data, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        to = first.get(data)
        to = None if to == page else to
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def read(index):
    rows = warc.read_records(index).collect()
    page = lambda x: int(x.split(":")[2]) if x and x.split(":")[2] else None
    return rows, sorted(
        ((page(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], page(r["refers_to"])) for r in rows), key=str
    )


@pytest.mark.parametrize("sizes", [(1 << 20, 256 << 20), (4000, 1)])
def test_records_agree_with_the_rule_and_payloads_return(spark, sizes):
    index = warc.write_archives(spark.createDataFrame(ROWS, PAGES).repartition(3), frame_bytes=sizes[0], bundle_bytes=sizes[1])
    rows, found = read(index)
    assert found == brute(ROWS)
    payloads = {hashlib.sha1((html or "").encode()).hexdigest(): (html or "").encode() for _, _, html in ROWS}
    for row in rows:
        assert row["payload"] == (payloads[row["payload_digest"]] if row["record_type"] == "response" else None)
    assert {r["target_uri"] for r in rows} >= {None, "", "http://b.example/x%20y%0D%0Az"}


def test_records_are_found_by_their_identifiers(spark):
    index = warc.write_archives(spark.createDataFrame(ROWS, PAGES), frame_bytes=4000)
    ids = index.select("record_id").filter("record_id like 'urn:page:1_:%' or record_id like 'urn:page:7:%'")
    rows = warc.fetch_records(index, ids.unionByName(ids).unionByName(spark.createDataFrame([("none",), (None,)], "record_id string")))
    assert sorted(r["record_id"].split(":")[2] for r in rows.collect()) == ["10", "11", "12", "13", "7", "7"]
    places = index.orderBy("bundle", "frame", "place").collect()
    for a, b in zip(places, places[1:], strict=False):
        if (a["bundle"], a["frame"]) == (b["bundle"], b["frame"]):
            assert a["place"] + a["size"] == b["place"]


def test_bundles_are_plain_zstandard_with_a_seek_table(spark):
    index = warc.write_archives(spark.createDataFrame(ROWS, PAGES).coalesce(1), frame_bytes=4000)
    (bundle,) = {r["bundle"] for r in index.collect()}
    filesystem, name = open_filesystem(bundle)
    data = filesystem.open_input_file(name).read()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    reader = warc.BundleReader(bundle)
    assert whole == b"".join(reader.frame(i) for i in range(len(reader.frames)))
    assert whole.count(b"WARC-Record-ID") == len(ROWS) and whole.startswith(b"WARC/1.1\r\n")
    frames, flags, magic = struct.unpack("<IBI", data[-9:])
    assert (frames, flags, magic) == (len(reader.frames), 0x80, 0x8F92EAB1)
    assert struct.unpack("<II", data[-9 - 12 * frames - 8 : -9 - 12 * frames]) == (0x184D2A5E, 9 + 12 * frames)


def test_damage_is_found(tmp_path):
    path = tmp_path / "x.warc.zst"
    payload = b"p" * 2000
    data = warc.record("urn:page:1:x", None, payload, len(payload), hashlib.sha1(payload).hexdigest(), None, "2020-01-01T00:00:00Z")
    with path.open("wb") as out:
        writer = warc.BundleWriter(out)
        writer.frame(data)
        writer.finish()
    assert warc.parse(warc.BundleReader(str(path)).frame(0)) == (
        {
            "record_id": "urn:page:1:x",
            "record_type": "response",
            "target_uri": None,
            "payload": payload,
            "payload_bytes": 2000,
            "payload_digest": hashlib.sha1(payload).hexdigest(),
            "refers_to": None,
        },
        len(data),
    )
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(data.replace(b"ppp", b"pqp"))
    raw = bytearray(path.read_bytes())
    raw[-12] ^= 1  # the frame's checksum
    path.write_bytes(raw)
    with pytest.raises(ValueError, match="damaged"):
        warc.BundleReader(str(path)).frame(0)
    path.write_bytes(raw[:-3])
    with pytest.raises(ValueError, match="no seek table"):
        warc.BundleReader(str(path))


def test_other_columns_and_no_rows(spark):
    pages = spark.createDataFrame(ROWS[:3], PAGES).withColumns({n: F.lit("x") for n in ("payload", "key", "first", "record_id", "n")})
    assert read(warc.write_archives(pages))[1] == brute(ROWS[:3])
    index = warc.write_archives(spark.createDataFrame([], PAGES))
    assert index.collect() == [] and warc.read_records(index).collect() == []


def test_a_group_of_many_equal_pages(spark):
    rows = [(i, f"http://x.example/{i}", BIG if i % 3 else f"{BIG}{i % 900}") for i in range(3000)]
    assert read(warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(4)))[1] == brute(rows)
