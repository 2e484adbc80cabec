"""WARC archives in seekable Zstandard bundles.

A bundle is one file: records are packed into frames of about a megabyte, each compressed
on its own, and a seek table in a skippable frame ends the file (compressed and full size
and checksum of every frame), so that a reader gets at any frame with two small reads and
any Zstandard tool reads the whole. The index, a table beside the bundles, maps each
record's identifier to its bundle, its frame and its place within the frame.

Every task writes bundles of its own under names that no other attempt uses, and only the
rows of finished tasks get into the index. What a lost task leaves behind is never read.

Of equal payloads from ``least`` bytes on one is stored, as a response; the others become
revisit records, which name it and carry no payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from functools import partial
from typing import BinaryIO

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold.llm.graphs import stored
from watchfold.session import scratch_dir, ship
from watchfold.sources.files import open_filesystem

#: Payloads of fewer bytes are stored however often they occur.
LEAST = 1000
#: Bytes of records that a frame holds; a longer record is a frame of its own.
FRAME_BYTES = 1 << 20
#: Compressed bytes after which a task begins a new bundle.
BUNDLE_BYTES = 256 << 20
LEVEL = 3

# The seekable format (skippable frame of the table, mark at the end, flag
# of a table with checksums) and the record format.
TABLE_MAGIC, SEEK_MAGIC, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ENTRY, _FOOTER = struct.Struct("<III"), struct.Struct("<IBI")
_INDEX = "record_id string, bundle string, frame int, place long, size long"
_READ = "record_id string, record_type string, target_uri string, payload binary, payload_bytes long, payload_digest string, refers_to string"


class BundleWriter:
    """Frames of records and the seek table behind them, on a file open for writing."""

    def __init__(self, out: BinaryIO, level: int = LEVEL):
        self.out, self.written = out, 0
        self.entries: list[tuple[int, int, int]] = []
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)

    def frame(self, data: bytes) -> None:
        packed = self.compressor.compress(data)
        self.out.write(packed)
        self.written += len(packed)
        self.entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def finish(self) -> None:
        table = b"".join(_ENTRY.pack(*e) for e in self.entries)
        table += _FOOTER.pack(len(self.entries), CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)


class BundleReader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, path: str):
        filesystem, name = open_filesystem(path)
        self.path, self.file = path, filesystem.open_input_file(name)
        size = self.file.size()
        count, flags, magic = _FOOTER.unpack(self.file.read_at(_FOOTER.size, max(size - _FOOTER.size, 0)))
        if magic != SEEK_MAGIC:
            raise ValueError(f"no seek table at the end of {path}")
        entry = _ENTRY.size if flags & CHECKSUMS else 8
        table = self.file.read_at(count * entry, size - _FOOTER.size - count * entry)
        self.frames, at = [], 0
        for i in range(count):
            packed, full, *check = struct.unpack_from("<III" if flags & CHECKSUMS else "<II", table, i * entry)
            self.frames.append((at, packed, full, check[0] if check else None))
            at += packed
        self.decompressor = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        at, packed, full, check = self.frames[number]
        data = self.decompressor.decompress(self.file.read_at(packed, at), max_output_size=full)
        if len(data) != full or (check is not None and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check):
            raise ValueError(f"frame {number} of {self.path} is damaged")
        return data


def _base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def _field(text: str) -> str:
    """A header's value: control characters and blanks, which would end it, as escapes."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(
    record_id: str, target: str | None, payload: bytes | None, size: int, digest: str, refers_to: str | None, date: str
) -> bytes:
    """The bytes of a response record, or of a revisit record where ``refers_to`` is given."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{_base32(digest)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if target is not None:
        head.append(f"WARC-Target-URI: {_field(target)}")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, at: int, end: int | None = None) -> tuple[str, dict[str, str], int]:
    """First line and fields of a header from ``at`` on, and where its body begins."""
    stop = data.index(b"\r\n\r\n", at) if end is None else data.index(b"\r\n\r\n", at, end)
    first, *lines = data[at:stop].decode().split("\r\n")
    pairs = (line.split(":", 1) for line in lines)
    return first, {k.strip().lower(): v.strip() for k, v in pairs}, stop + 4


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at an offset of a frame, and where the next one begins.

    A response's payload must have the size and the digest that its headers name.
    """
    version, fields, body = _headers(data, at)
    if version != VERSION:
        raise ValueError(f"no record at byte {at} of the frame")
    end = body + int(fields["content-length"])
    _, inner, start = _headers(data, body, end)
    found = {
        "record_id": fields["warc-record-id"][1:-1],
        "record_type": fields["warc-type"],
        "target_uri": fields.get("warc-target-uri"),
        "payload": None,
        "payload_bytes": int(inner["content-length"]),
        "payload_digest": base64.b32decode(fields["warc-payload-digest"].split(":")[1]).hex(),
        "refers_to": fields["warc-refers-to"][1:-1] if "warc-refers-to" in fields else None,
    }
    if found["record_type"] == "response":
        payload = data[start:end]
        if len(payload) != found["payload_bytes"] or hashlib.sha1(payload).hexdigest() != found["payload_digest"]:
            raise ValueError(f"payload of {found['record_id']} is damaged")
        found["payload"] = payload
    return found, end + 4


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str, frame_bytes: int, bundle_bytes: int) -> Iterator[pa.RecordBatch]:
    """Writes bundles; a row for each record once its bundle is complete."""
    filesystem, root = open_filesystem(folder)
    writer, path, name, held, size, rows = None, "", "", [], 0, []

    def flush() -> None:
        nonlocal held, size
        if held:
            writer.frame(b"".join(held))
            held, size = [], 0

    def finish() -> pa.RecordBatch:
        nonlocal writer, rows
        flush()
        writer.finish()
        writer.out.close()
        writer = None
        names = [x.split()[0] for x in _INDEX.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        out = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)
        rows = []
        return out

    for batch in batches:
        columns = [batch.column(c) for c in ("record_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")]
        for row in zip(*columns, strict=True):
            data = record(*(x.as_py() for x in row), date)
            if writer is None:
                name = f"{uuid.uuid4().hex}.warc.zst"
                path = f"{folder}/{name}"
                writer = BundleWriter(filesystem.open_output_stream(f"{root}/{name}", compression=None))
            if size and size + len(data) > frame_bytes:
                flush()
            rows.append((row[0].as_py(), path, len(writer.entries), size, len(data)))
            held.append(data)
            size += len(data)
            if writer.written >= bundle_bytes:
                yield finish()
    if writer is not None:
        yield finish()


def _records(rows: list[dict]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _READ.split(", ")]
    kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]
    return pa.record_batch([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)


def _read_frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All records of each frame (bundle, frame), or those at its ``places``."""
    reader = None
    for batch in batches:
        chosen = batch.column("places").to_pylist() if "places" in batch.schema.names else [None] * len(batch)
        for bundle, number, places in zip(batch.column("bundle").to_pylist(), batch.column("frame").to_pylist(), chosen, strict=True):
            if reader is None or reader.path != bundle:
                reader = BundleReader(bundle)
            data = reader.frame(number)
            if places is not None:
                rows = [parse(data, at)[0] for at in places]
            else:
                rows, at = [], 0
                while at < len(data):
                    found, at = parse(data, at)
                    rows.append(found)
            yield _records(rows)


def _dealt(frames: DataFrame) -> DataFrame:
    """Frames in as many partitions as tasks run at once at least, those of a bundle together."""
    tasks = frames.sparkSession.sparkContext.defaultParallelism
    wanted = max(tasks, int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return frames.repartition(wanted, "bundle", F.col("frame").bitwiseAND(~63)).sortWithinPartitions("bundle", "frame")


def read_records(index: DataFrame) -> DataFrame:
    """All records of the bundles that ``index`` names, whole frames at a time:
    ``record_id, record_type, target_uri, payload, payload_bytes, payload_digest, refers_to``."""
    ship(index.sparkSession, "watchfold")
    return _dealt(index.groupBy("bundle", "frame").agg(F.count("*").alias("n")).drop("n")).mapInArrow(_read_frames, _READ)


def fetch_records(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records of ``ids`` (record_id), from the frames that hold them and no others.

    Identifiers that no record has give no row, repeated ones one row each record.
    """
    ship(index.sparkSession, "watchfold")
    wanted = index.join(ids.select("record_id").distinct(), "record_id", "left_semi")
    frames = wanted.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list("place")).alias("places"))
    return _dealt(frames).mapInArrow(_read_frames, _READ)


def _record_id(page_id: Column, digest: Column) -> Column:
    """Identifier of a page's record: the page and its payload's digest."""
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), digest)


def page_of(record_id: Column) -> Column:
    """The page_id in a record's identifier (a column), null where the page has none."""
    return F.nullif(F.split_part(record_id, F.lit(":"), F.lit(3)), F.lit("")).cast("long")


def with_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, record_id, refers_to)``: the
    record of each page, without payload where it revisits another one.

    Payloads are equal if their SHA-256 is; their SHA-1 names them. Groups of equal
    payloads are (digest, count, largest page_id) rows, merged within tasks first. A page
    meets its group by the digest; groups that hold a thousandth of all pages, which are
    a thousand at most, are sent to all tasks instead, so that no digest is a hot key.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    )
    sized = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    hashed = sized.select("*", F.sha1("payload").alias("payload_digest"), F.unhex(F.sha2("payload", 256)).alias("key"))
    light = stored(hashed.filter(F.col("payload_bytes") >= least).select("page_id", "payload_digest", "key"), "digests")
    groups = light.groupBy("key", "payload_digest").agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
    groups = stored(groups.filter("n > 1"), "groups")
    total = light.count()
    large = F.broadcast(groups.filter(F.col("n") * 1000 >= total).select("key", "first"))
    small = groups.filter(F.col("n") * 1000 < total).select("key", "first")
    # (page_id, key) of all pages that revisit; the page of the largest page_id is the response
    own = light.select("page_id", "key")
    met = own.join(large, "key").unionByName(own.join(large, "key", "left_anti").join(small, "key"))
    later = met.filter(~F.col("page_id").eqNullSafe(F.col("first"))).distinct()
    marked = hashed.alias("p").join(
        later.alias("r"), F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("p.key") == F.col("r.key")), "left"
    )
    revisits = F.col("r.key").isNotNull()
    return marked.select(
        "p.page_id",
        "p.url",
        F.when(~revisits, F.col("p.payload")).alias("payload"),
        "p.payload_bytes",
        "p.payload_digest",
        _record_id(F.col("p.page_id"), F.col("p.payload_digest")).alias("record_id"),
        F.when(revisits, _record_id(F.col("first"), F.col("p.payload_digest"))).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    least: int = LEAST,
    date: str = "1970-01-01T00:00:00Z",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Writes a record for every row of ``pages`` (page_id, url, html) and returns the index
    ``(record_id, bundle, frame, place, size)``; ``place`` counts within the frame.

    Bundles go into ``folder``, which all machines share (a new one below the session's
    checkpoint folder if none is named). Null html is an empty payload. Rows equal in
    page_id and payload have equal records under one identifier; if theirs is the largest
    page_id, all are responses. A page without page_id has an identifier without it, and
    is a response only where no page with one has its payload. A null url is left out.
    Extra columns are not looked at; an empty table writes no bundle.
    """
    spark = pages.sparkSession
    ship(spark, "watchfold")
    folder = folder or scratch_dir(spark, "bundles")
    filesystem, root = open_filesystem(folder)
    filesystem.create_dir(root, recursive=True)
    rows = with_revisits(pages, least)
    write = partial(_write, folder=folder, date=date, frame_bytes=frame_bytes, bundle_bytes=bundle_bytes)
    return stored(rows.mapInArrow(write, _INDEX), "index")
