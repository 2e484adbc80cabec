"""IP datagrams put together from their fragments.

Fragments of a datagram share addresses, identification and (IPv4) protocol. Identifications
come round again, so fragments belong together only while no pause between them is longer
than a timeout. Pauses are found without sorting a key's fragments: they are counted into
slots as long as the timeout, and a window over slots, of which there are few, numbers the
runs. Within a run a plain walk in order of arrival fills one datagram after the other, so
that memory is bounded by a datagram and not by how often a key comes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.operators.packets import ETHERNET, IPV4_TYPE, IPV6_TYPE, _behind_extensions, _links, _uint
from watchfold.session import ship

#: Seconds without a fragment after which a datagram counts as given up.
TIMEOUT = 30

_KEY = ["capture", "key"]
_OUT = "capture string, packet_id bigint, ts timestamp_ntz, orig_len bigint, frame binary, link int, whole boolean, fragments int"
_KINDS = [pa.string(), pa.int64(), pa.timestamp("us"), pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.int32()]


def _cut(frames: DataFrame) -> DataFrame:
    """Frames with ``_piece`` (NULL if the frame is no fragment): key, place and bytes."""
    f, ip, kind = F.col("frame"), F.col("_ip"), F.col("_kind")
    size = F.length(f)

    def part(at: Column, length: Column) -> Column:
        return F.substring(f, at + 1, length)

    header = (_uint(f, ip, 1).bitwiseAND(15) * 4).cast("int")
    total, bits = _uint(f, ip + 2, 2).cast("int"), _uint(f, ip + 6, 2).cast("int")
    end = F.when((total >= header) & (ip + total <= size), ip + total).otherwise(size)
    four = F.struct(
        F.concat(part(ip + 12, F.lit(8)), part(ip + 9, F.lit(1)), part(ip + 4, F.lit(2))).alias("key"),
        (bits.bitwiseAND(8191) * 8).alias("place"),
        (bits.bitwiseAND(8192) > 0).alias("more"),
        part(F.lit(0), ip + header).alias("head"),
        part(ip + header, F.greatest(end - ip - header, F.lit(0))).alias("data"),
        F.lit(None).cast("int").alias("named"),
        F.lit(None).cast("int").alias("number"),
    )
    walked = F.col("_walked")
    cut, rest = walked["cut"], _uint(f, ip + 4, 2).cast("int")
    end6 = F.when((rest > 0) & (ip + 40 + rest <= size), ip + 40 + rest).otherwise(size)
    bits6 = _uint(f, cut + 2, 2).cast("int")
    six = F.struct(
        F.concat(part(ip + 8, F.lit(32)), part(cut + 4, F.lit(4))).alias("key"),
        bits6.bitwiseAND(65528).alias("place"),
        (bits6.bitwiseAND(1) > 0).alias("more"),
        part(F.lit(0), cut).alias("head"),
        part(cut + 8, F.greatest(end6 - cut - 8, F.lit(0))).alias("data"),
        walked["cut_named"].alias("named"),
        _uint(f, cut, 1).cast("int").alias("number"),
    )
    v4 = (kind == IPV4_TYPE) & (size >= ip + 20) & (bits.bitwiseAND(16383) > 0)
    v6 = (kind == IPV6_TYPE) & cut.isNotNull() & (bits6.bitwiseAND(65529) > 0)
    number = _uint(f, ip + 6, 1).cast("int")
    behind = F.when((kind == IPV6_TYPE) & (size >= ip + 48), _behind_extensions(f, number, ip + 6, ip + 40))
    walked_frames = _links(frames, frames.columns).withColumn("_walked", behind)
    return walked_frames.withColumn("_piece", F.when(v4, four).when(v6, six))


def _checksum(header: bytes) -> int:
    total = sum(struct.unpack(f">{len(header) // 2}H", header))
    while total >> 16:
        total = (total & 0xFFFF) + (total >> 16)
    return ~total & 0xFFFF


class _Datagram:
    """Bytes of one datagram as far as they have come; what came first stays."""

    def __init__(self):
        self.data = bytearray()
        self.filled = bytearray()  # a one for every byte that is there
        self.end: int | None = None
        self.first: dict | None = None
        self.count = 0

    def same(self, row: dict) -> bool:
        """Whether a fragment repeats what is there."""
        place, data = row["place"], row["data"]
        known = self.filled[place : place + len(data)]
        return len(known) == len(data) and all(known) and bytes(self.data[place : place + len(data)]) == data

    def clashes(self, row: dict) -> bool:
        """Whether a fragment is another one's at the same place, or lies behind the end."""
        place, last = row["place"], row["place"] + len(row["data"])
        known = self.filled[place:last]
        if self.end is not None and (last > self.end or (not row["more"] and last != self.end)):
            return True
        if not row["more"] and len(self.filled) > last:
            return True
        return len(known) == len(row["data"]) and len(known) > 0 and all(known)

    def add(self, row: dict) -> None:
        place, data = row["place"], row["data"]
        last = place + len(data)
        if last > len(self.data):
            self.filled.extend(bytes(last - len(self.data)))
            self.data.extend(bytes(last - len(self.data)))
        known = self.filled[place:last]
        if any(known):
            for i, there in enumerate(known):
                if not there:
                    self.data[place + i] = data[i]
        else:
            self.data[place:last] = data
        self.filled[place:last] = b"\1" * len(data)
        if not row["more"]:
            self.end = last
        if self.first is None or (place == 0 and self.first["place"]):
            self.first = row
        self.count += 1

    @property
    def whole(self) -> bool:
        return self.end is not None and self.end == len(self.filled) and all(self.filled)

    def row(self) -> tuple:
        """The datagram as a frame; one with holes is its first fragment."""
        first, whole = self.first, self.whole
        frame = first["frame"]
        if whole:
            head, ip = bytearray(first["head"]), first["ip"]
            if first["named"] is None:
                size = len(head) - ip + len(self.data)
                head[ip + 2 : ip + 4] = (size if size < 65536 else 0).to_bytes(2, "big")
                head[ip + 6] &= 0x40
                head[ip + 7] = 0
                head[ip + 10 : ip + 12] = b"\0\0"
                head[ip + 10 : ip + 12] = _checksum(bytes(head[ip:])).to_bytes(2, "big")
            else:
                size = len(head) - ip - 40 + len(self.data)
                head[ip + 4 : ip + 6] = (size if size < 65536 else 0).to_bytes(2, "big")
                head[first["named"]] = first["number"]
            frame = bytes(head + self.data)
        return first["capture"], first["packet_id"], first["ts"], len(frame), frame, first["link"], whole, self.count


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each datagram of rows in order of key, run and arrival."""
    names = [x.split()[0] for x in _OUT.split(", ")]
    key, open_, done, out = None, _Datagram(), None, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS, strict=True)], names=names)

    for batch in batches:
        for row in batch.to_pylist():
            if (row["capture"], row["key"], row["run"]) != key:
                if open_.count:
                    out.append(open_.row())
                key, open_, done = (row["capture"], row["key"], row["run"]), _Datagram(), None
            if open_.same(row) or (done is not None and not open_.count and done.same(row)):
                continue
            if open_.clashes(row):
                out.append(open_.row())
                open_ = _Datagram()
            open_.add(row)
            if open_.whole:
                out.append(open_.row())
                done, open_ = open_, _Datagram()
        if out:
            yield batch_of(out)
            out = []
    if open_.count:
        yield batch_of([open_.row()])


def defragment(frames: DataFrame, timeout: int = TIMEOUT) -> DataFrame:
    """Frames with every datagram as one frame: the columns of frames, ``whole`` and
    ``fragments``, both NULL for frames that are no fragments and stay as they are.

    A datagram stands for its fragment at place 0 (packet_id, ts), or the first to come. If
    it is ``whole`` its frame has all bytes, else it is that fragment's, which decodes
    to its ports but to no payload. A fragment that repeats known bytes is passed over, one
    that overlaps fills what is missing, and one that has other bytes for a place that is
    full begins the next datagram. Packets without ts count as of the year 1970.
    """
    ship(frames.sparkSession, "watchfold")
    if "link" not in frames.columns:
        frames = frames.withColumn("link", F.lit(ETHERNET))
    columns = ["capture", "packet_id", "ts", "orig_len", "frame", "link"]
    cut = _cut(frames.select(columns))
    plain = cut.filter("_piece is null").select(
        *columns, F.lit(None).cast("boolean").alias("whole"), F.lit(None).cast("int").alias("fragments")
    )
    seconds = F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(0)) / 1_000_000
    pieces = cut.filter("_piece is not null").select(
        *columns, F.col("_ip").alias("ip"), "_piece.*", seconds.alias("_at"), F.floor(seconds / timeout).alias("_slot")
    )
    # slots that lie close enough are one run, named by its first slot
    by_time = Window.partitionBy(*_KEY).orderBy("_slot")
    slots = pieces.groupBy(*_KEY, "_slot").agg(F.min("_at").alias("_low"), F.max("_at").alias("_high"))
    apart = F.coalesce(F.col("_low") - F.lag("_high").over(by_time) > timeout, F.lit(True))
    slots = slots.withColumn("_begins", F.when(apart, F.col("_slot")))
    slots = slots.select(*_KEY, "_slot", F.last("_begins", ignorenulls=True).over(by_time).alias("run"))
    runs = pieces.join(slots, [*_KEY, "_slot"]).drop("_slot", "_at", "orig_len")
    ordered = runs.repartition(*_KEY, "run").sortWithinPartitions(*_KEY, "run", "ts", "packet_id", "place")
    return plain.unionByName(ordered.mapInArrow(_assembled, _OUT))
