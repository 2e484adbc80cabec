"""TCP byte streams put together from their segments.

Every direction of a connection is a stream of bytes numbered modulo 2**32 from a start
that its SYN announces. Segments get their place in the stream without sorting a
connection's packets: each second of a connection is one row (its first number, its
SYNs), and a window over seconds adds up how far the numbers have moved, so that streams
beyond 4 GB and later connections between the same ports are told apart. A stream is then
cut into blocks of places; a block is filled by one task, in order of arrival, so that
repeats and overlaps change nothing and a busy stream spreads over many tasks. Blocks read
on a little beyond their end, so that what begins in one is found whole there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.functions.rules import KEYWORDS, SYN
from watchfold.operators.detect import keyword_alert
from watchfold.operators.packets import HTTP_METHODS, parse_http
from watchfold.session import ship

#: Bytes of a stream that one task fills, and how far beyond them it reads.
BLOCK, CARRY = 1 << 20, 1 << 16

KEY = ["capture", "src_ip", "src_port", "dst_ip", "dst_port"]
_OUT = """capture string, packet_id bigint, ts timestamp_ntz, src_ip string, dst_ip string, src_port int, dst_port int,
  protocol string, length int, payload binary, flag_bits int, stream bigint, place bigint, own bigint, gap_after bigint,
  continued boolean"""
_KINDS = [
    pa.string(), pa.int64(), pa.timestamp("us"), pa.string(), pa.string(), pa.int32(), pa.int32(),
    pa.string(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
    pa.bool_(),
]

_HEAD = re.compile(
    rb"(?:%b) [^\r\n]+ HTTP/1\.[01]\r\n|HTTP/1\.[01] [0-9]{3}|(?<=\r\n\r\n)(?:%b) "
    % (("|".join(HTTP_METHODS).encode(),) * 2)
)


def _signed(difference: Column) -> Column:
    """A difference of sequence numbers as the shorter way round."""
    return F.pmod(difference + (1 << 31), F.lit(1 << 32)) - (1 << 31)


def placed(segments: DataFrame) -> DataFrame:
    """Segments that carry bytes, with their ``stream`` and ``place``.

    ``stream`` is the number of the SYN that opened it (NULL if the capture has none), and
    place 0 the byte behind it, or else the first byte seen; earlier bytes then have
    negative places. Segments without ts count as of one second.
    """
    second = F.coalesce(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000), F.lit(0))
    arrival = F.struct("ts", "packet_id")
    rows = segments.withColumn("_second", second)
    opening = F.col("flag_bits").bitwiseAND(SYN) != 0
    # one row per second and number first: a SYN sent again and again is one
    syns = rows.filter(opening).groupBy(*KEY, "_second", "sequence").agg(F.min(arrival).alias("at"))
    syns = syns.groupBy(*KEY, "_second").agg(F.array_sort(F.collect_list(F.struct("at", "sequence"))).alias("_syns"))
    seconds = rows.groupBy(*KEY, "_second").agg(F.min_by("sequence", arrival).alias("_first"))
    seconds = seconds.join(syns, [*KEY, "_second"], "left")
    by_time = Window.partitionBy(*KEY).orderBy("_second")
    last = F.try_element_at("_syns", F.lit(-1))["sequence"]
    # from where the second before counts: its last SYN, or its first number
    before = F.coalesce(F.lag(last + 1).over(by_time), F.lag("_first").over(by_time))
    earlier = by_time.rowsBetween(Window.unboundedPreceding, -1)
    moved = seconds.select(
        *KEY,
        "_second",
        "_first",
        "_syns",
        F.coalesce(_signed(F.col("_first") - before), F.lit(0)).alias("_step"),
        F.count("_syns").over(earlier).alias("_opened"),
        F.last(last, ignorenulls=True).over(earlier).alias("_stream"),
    )
    since = Window.partitionBy(*KEY, "_opened").orderBy("_second")
    moved = moved.withColumn("_base", F.sum("_step").over(since)).drop("_step", "_opened")
    met = rows.filter((F.length("payload") > 0)).join(moved, [*KEY, "_second"])
    own = F.try_element_at(F.filter("_syns", lambda x: x["at"] <= arrival), F.lit(-1))["sequence"]
    number = F.col("sequence") + F.when(opening, 1).otherwise(0)
    place = F.when(own.isNotNull(), _signed(number - own - 1)).otherwise(F.col("_base") + _signed(number - F.col("_first")))
    return met.select(
        *KEY, "ts", "packet_id", "payload", F.coalesce(own, F.col("_stream")).alias("stream"), place.alias("place")
    )


class _Block:
    """Bytes of one block as far as they have come; what came first stays."""

    def __init__(self, base: int, size: int):
        self.base, self.size = base, size
        self.data, self.filled = bytearray(), bytearray()
        self.marks: list[tuple[int, int, object]] = []

    def add(self, place: int, data: bytes, packet_id: int, ts: int | None) -> None:
        at = place - self.base
        low, high = max(at, 0), min(at + len(data), self.size)
        if len(self.data) <= low < high:  # beyond all that has come
            gap = bytes(low - len(self.data))
            self.data += gap
            self.filled += gap
            self.data += data[low - at : high - at]
            self.filled += b"\1" * (high - low)
            self.marks.append((low, packet_id, ts))
            return
        if high > len(self.data):
            self.filled.extend(bytes(high - len(self.data)))
            self.data.extend(bytes(high - len(self.data)))
        while low < high:
            low = self.filled.find(0, low, high)
            if low < 0:
                return
            end = self.filled.find(1, low, high)
            end = high if end < 0 else end
            self.data[low:end] = data[low - at : end - at]
            self.filled[low:end] = b"\1" * (end - low)
            self.marks.append((low, packet_id, ts))
            low = end

    def runs(self, own: int) -> Iterator[tuple[int, int]]:
        """Begin and end of the runs of bytes that begin among the first ``own``."""
        low = self.filled.find(1)
        while 0 <= low < own:
            high = self.filled.find(0, low)
            high = len(self.filled) if high < 0 else high
            yield low, high
            low = self.filled.find(1, high)


def _pieces(block: _Block, key: tuple, own: int) -> Iterator[tuple]:
    """The block's runs cut where messages begin; the last piece of a run reads on.

    The first byte of the buffer is the last one of the block before.
    """
    capture, src_ip, src_port, dst_ip, dst_port, stream, _ = key
    own += 1
    mark, runs = 0, list(block.runs(own))
    if not runs or runs == [(0, 1)]:  # nothing but the bytes of its neighbours
        return
    marks = sorted(block.marks, key=lambda m: m[0])
    for i, (low, high) in enumerate(runs):
        continued = low == 0
        low = max(low, 1)
        if low == high:
            continue
        data = bytes(block.data[low:high])
        end = min(high, own)
        heads = {low + m.start() for m in _HEAD.finditer(data)}
        starts = sorted({low, *(h for h in heads if h < end)})
        beyond = min((h for h in heads if h >= end), default=high)
        for start, stop in zip(starts, [*starts[1:], end], strict=True):
            while mark + 1 < len(marks) and marks[mark + 1][0] <= start:
                mark += 1
            payload = data[start - low : (stop if stop < end else beyond) - low]
            gap = runs[i + 1][0] - high if stop == end and i + 1 < len(runs) else None
            yield (
                capture, marks[mark][1], marks[mark][2], src_ip, dst_ip, src_port, dst_port,
                "TCP", len(payload), payload, None, stream, block.base + start, stop - start, gap,
                continued and start == low and start not in heads,
            )


def _filled(batches: Iterator[pa.RecordBatch], size: int, carry: int) -> Iterator[pa.RecordBatch]:
    """Pieces of rows in order of stream, block and arrival."""
    names = [x.split()[0] for x in _OUT.split(",")]
    key, block, out, held = None, None, [], 0

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS, strict=True)], names=names)

    for batch in batches:
        keys = zip(*(batch.column(k).to_pylist() for k in (*KEY, "stream", "block")), strict=True)
        places, payloads, ids = (batch.column(k).to_pylist() for k in ("place", "payload", "packet_id"))
        stamps = batch.column("ts").cast(pa.int64()).to_pylist()
        for here, place, payload, packet_id, ts in zip(keys, places, payloads, ids, stamps, strict=True):
            if here != key:
                if block is not None:
                    found = list(_pieces(block, key, size))
                    out += found
                    held += sum(r[8] for r in found)
                key, block = here, _Block(here[-1] * size - 1, 1 + size + carry)
            block.add(place, payload, packet_id, ts)
            if held > (8 << 20):
                yield batch_of(out)
                out, held = [], 0
    if block is not None:
        out += _pieces(block, key, size)
    if out:
        yield batch_of(out)


def reassemble(segments: DataFrame, block_bytes: int = BLOCK, carry: int = CARRY) -> DataFrame:
    """Streams as rows shaped like packets, for ``parse_http`` and the detectors.

    A row is a run of bytes without a hole: an HTTP message where one begins, else all up to
    the next message, hole or border of a block. ``packet_id`` and ``ts`` are those of the
    packet that brought its first byte, ``place`` counts in the stream (see
    :func:`placed`), ``own`` is the row's number of bytes. At a border the payload reads on
    to the next message for up to ``carry`` bytes, which are the next row's own; so long may
    a header be.
    A row that neither begins a message nor follows a hole is ``continued``: only others can
    hold a header. ``gap_after`` bytes are missing behind the row; NULL if none are, the stream ends or
    the next byte lies in a later block (:func:`gaps` has all). Of bytes that come twice the
    first ones stay.
    """
    ship(segments.sparkSession, "watchfold")
    rows = placed(segments)
    end = F.col("place") + F.length("payload")
    # a block reads one byte before it and ``carry`` behind it
    first, last = F.floor((F.col("place") - carry) / block_bytes), F.floor(end / block_bytes)
    dealt = rows.withColumn("block", F.explode(F.sequence(first, last)))
    order = [*KEY, "stream", "block"]
    dealt = dealt.repartition(*order).sortWithinPartitions(*order, "ts", "packet_id")
    return dealt.mapInArrow(partial(_filled, size=block_bytes, carry=carry), _OUT)


def stream_messages(streams: DataFrame) -> DataFrame:
    """The HTTP messages of :func:`reassemble`, with the columns of ``parse_http``."""
    parsed = parse_http(streams.filter(~F.col("continued")))
    return parsed.filter("http_method is not null or http_status is not null")


def gaps(streams: DataFrame, block_bytes: int = BLOCK) -> DataFrame:
    """Missing bytes of streams: ``capture, addresses and ports, stream, place, missing``.

    Holes across borders are found by one row per block: where it begins and ends.
    """
    key = [*KEY, "stream"]
    inside = streams.filter("gap_after is not null").select(
        *key, (F.col("place") + F.col("own")).alias("place"), F.col("gap_after").alias("missing")
    )
    blocks = streams.groupBy(*key, F.floor(F.col("place") / block_bytes).alias("block")).agg(
        F.min("place").alias("low"), F.max(F.col("place") + F.col("own")).alias("place")
    )
    behind = F.lead("low").over(Window.partitionBy(*key).orderBy("block"))
    across = blocks.withColumn("missing", behind - F.col("place")).filter("missing > 0")
    return inside.unionByName(across.select(*key, "place", "missing"))


def stream_keyword(streams: DataFrame) -> DataFrame:
    """One alert per row whose own part a sensitive keyword begins in.

    Bytes are read as characters one by one, so that positions are those of bytes.
    """
    text = F.lower(F.decode("payload", "ISO-8859-1"))
    hits = [F.when(F.locate(k, text).between(F.lit(1), F.col("own")), k) for k in KEYWORDS]
    hit, alert = keyword_alert(F.coalesce(*hits))
    return streams.filter(hit.isNotNull()).select(*alert)
