"""Files that HTTP messages carry: the bodies of reassembled streams and their hashes.

Where a body begins and ends is found from message heads alone, which are few and small:
a window over the places of a stream's rows sees no payload. Rows then meet in one group
per message, in order, so that a body of any size is hashed piece by piece and a busy
stream's messages spread over tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.operators.packets import HTTP_METHODS
from watchfold.operators.tcp_streams import CARRY, KEY
from watchfold.session import scratch_dir, ship

_FIRST_LINE = rf"^(?:(?:{'|'.join(HTTP_METHODS)}) [^\r\n]+ HTTP/1\.[01]\r\n|HTTP/1\.[01] [0-9]{{3}})"
#: Responses that have no body whatever their headers say.
_BODILESS = r"^HTTP/1\.[01] (?:1[0-9]{2}|204|304)"
_LENGTH = r"(?i)\r\ncontent-length[ \t]*:[ \t]*([0-9]{1,18})[ \t]*(?:\r|$)"
_CHUNKED = r"(?i)\r\ntransfer-encoding[ \t]*:[^\r\n]*chunked"

_CHUNK_SIZE = re.compile(rb"[0-9A-Fa-f]{1,15}")
#: Longest line of a chunked body that is not data.
_LINE = 1 << 16

_OUT = """capture string, src_ip string, src_port int, dst_ip string, dst_port int, stream bigint, place bigint,
  packet_id bigint, ts timestamp_ntz, framing string, body_bytes bigint, complete boolean, md5 string, sha256 string"""
_KINDS = [
    pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(),
    pa.int64(), pa.timestamp("us"), pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string(),
]


class _Body:
    """Hashes of a body whose bytes come in pieces."""

    def __init__(self, place: int, skip: int, framing: str, length: int | None):
        self.framing, self.skip = framing, skip
        self.left = length if framing == "length" else 0
        self.next = place
        self.size, self.line = 0, bytearray()
        self.after = self.last = self.broken = False
        self.done = self.framing == "length" and self.left == 0
        self.hashes = (hashlib.md5(usedforsecurity=False), hashlib.sha256())

    def add(self, place: int, data: bytes) -> None:
        if self.broken or (self.done and not self.skip):
            return
        if place != self.next:  # a hole
            self.broken = True
            return
        self.next += len(data)
        skipped = min(self.skip, len(data))
        self.skip -= skipped
        data = data[skipped:]
        if self.framing == "length":
            data = data[: self.left]
            self.left -= len(data)
            self.done = self.left == 0
            self._hash(data)
        elif self.framing == "chunked":
            self._chunks(data)
        else:
            self._hash(data)

    def _hash(self, data: bytes) -> None:
        self.size += len(data)
        for x in self.hashes:
            x.update(data)

    def _chunks(self, data: bytes) -> None:
        at = 0
        while at < len(data) and not self.done and not self.broken:
            if self.left:
                part = data[at : at + self.left]
                self._hash(part)
                at += len(part)
                self.left -= len(part)
                self.after = self.left == 0
                continue
            end = data.find(b"\n", at)
            part = data[at : len(data) if end < 0 else end + 1]
            self.line += part
            at += len(part)
            if end >= 0:
                self._line(bytes(self.line).strip())
                self.line = bytearray()
            self.broken |= len(self.line) > _LINE

    def _line(self, line: bytes) -> None:
        if self.after:  # the line break behind a chunk
            self.after, self.broken = False, bool(line)
        elif self.last:
            self.done = not line
        else:
            size = line.split(b";")[0].strip()
            if not _CHUNK_SIZE.fullmatch(size):
                self.broken = True
            elif int(size, 16):
                self.left = int(size, 16)
            else:
                self.last = True

    def result(self) -> tuple:
        whole = not self.broken and not self.skip and (self.done or self.framing == "close")
        return self.framing, self.size, whole, *(x.hexdigest() if whole else None for x in self.hashes)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per message of rows in order of message and place."""
    names = [x.split()[0] for x in _OUT.split(",")]
    key, body, head, out = None, None, None, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS, strict=True)], names=names)

    def finish() -> None:
        found = body.result()
        if found[1] or not found[2]:  # nothing is no file
            out.append((*key, *head, *found))

    for batch in batches:
        # bytes one by one: pieces may be large
        data = batch.column("bytes")
        keys = zip(*(batch.column(k).to_pylist() for k in (*KEY, "stream", "message")), strict=True)
        heads = zip(*(batch.column(k).to_pylist() for k in ("skip", "framing", "length")), strict=True)
        places, ids = (batch.column(k).to_pylist() for k in ("place", "packet_id"))
        stamps = batch.column("ts").cast(pa.int64()).to_pylist()
        for i, (here, framed) in enumerate(zip(keys, heads, strict=True)):
            if here != key:
                if body is not None:
                    finish()
                key, body, head = here, _Body(here[-1], *framed), (ids[i], stamps[i])
            body.add(places[i], data[i].as_py())
        if len(out) >= 10_000:
            yield batch_of(out)
            out = []
    if body is not None:
        finish()
    if out:
        yield batch_of(out)


def carried_files(streams: DataFrame, carry: int = CARRY) -> DataFrame:
    """Bodies of the HTTP messages of :func:`tcp_streams.reassemble`, with md5 and sha256.

    Columns: ``capture``, addresses and ports, ``stream``, the ``place``, ``packet_id`` and
    ``ts`` of the message, ``framing``, ``body_bytes``, ``complete``, ``md5``, ``sha256``.
    A body is ``chunked`` (hashed without the chunks' sizes), as long as its ``length`` header
    says, or, in responses that say neither, all up to the next message or the end of what the
    stream has (``close``). Requests that say neither have no body, and empty bodies give no row.
    Bodies with a hole, cut short or with damaged chunks are not ``complete`` and have no hashes;
    ``body_bytes`` then tells what came before.

    What looks like a message inside a body of known length is part of it; inside a chunked
    body it would be taken for the next message. ``carry`` is that of ``reassemble``: heads
    are at most so long. A compressed body is hashed as it was sent.
    """
    ship(streams.sparkSession, "watchfold")
    text = F.decode(F.substring("payload", 1, carry), "ISO-8859-1")
    # only rows that do not go on with another one can begin a message
    text = F.when(~F.col("continued") & text.rlike(_FIRST_LINE), text)
    own = F.substring(F.col("payload"), F.lit(1), F.col("own").cast("int"))
    # Heads and bodies go separate ways: the streams are put together once, not for each.
    streams = streams.select(*KEY, "stream", "place", "packet_id", "ts", text.alias("_text"), own.alias("bytes"))
    folder = scratch_dir(streams.sparkSession, "streams")
    streams.write.parquet(folder)
    streams = streams.sparkSession.read.schema(streams.schema).parquet(folder)
    light = streams.drop("bytes")
    ended = F.instr("_text", "\r\n\r\n") > 0
    header = F.when(ended, F.substring_index("_text", "\r\n\r\n", 1))
    length = F.nullif(F.regexp_extract(header, _LENGTH, 1), F.lit("")).cast("bigint")
    framing = (
        F.when(header.rlike(_BODILESS), None)
        .when(header.rlike(_CHUNKED), "chunked")
        .when(length.isNotNull(), "length")
        .when(header.rlike("^HTTP/"), "close")
    )
    light = light.select(
        *KEY, "stream", "place", "packet_id", "ts", F.col("_text").isNotNull().alias("_head"),
        (F.length(header) + 4).cast("bigint").alias("skip"), framing.alias("framing"), length.alias("length"),
    )
    by_place = Window.partitionBy(*KEY, "stream").orderBy("place")
    end = F.when(F.col("framing") == "length", F.col("place") + F.col("skip") + F.col("length"))
    light = light.withColumn("_reach", F.max(end).over(by_place.rowsBetween(Window.unboundedPreceding, -1)))
    real = F.col("_head") & (F.col("_reach").isNull() | (F.col("place") >= F.col("_reach")))
    of = F.struct(F.col("place").alias("message"), "skip", "framing", "length", "packet_id", "ts")
    light = light.withColumn("_of", F.last(F.when(real, of), ignorenulls=True).over(by_place))
    light = light.select(*KEY, "stream", "place", "_of.*").filter("framing is not null")
    light = light.filter("framing <> 'length' or place <= message or place < message + skip + length")
    same = F.lit(True)
    for k in [*KEY, "stream", "place"]:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    pieces = streams.select(*KEY, "stream", "place", "bytes")
    met = light.alias("a").join(pieces.alias("b"), same).select("a.*", "b.bytes")
    order = [*KEY, "stream", "message"]
    return met.repartition(*order).sortWithinPartitions(*order, "place").mapInArrow(_hashed, _OUT)
