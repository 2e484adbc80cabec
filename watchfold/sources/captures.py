"""Packet capture files (pcap and pcapng) as frames.

Spark lists the files and cuts them into byte ranges; each range is read by one
task, straight from the shared file system, so that a capture of any size spreads
over the cluster. The Python part only frames records: headers are decoded by
column expressions (``watchfold.operators.packets``).

A pcapng file is a chain of typed blocks, in sections with a byte order of their own.
Packets refer to interfaces, each with its link type and its clock, that blocks
anywhere earlier in the section describe. Files of several ranges are therefore surveyed
first: every range tells which descriptions it adds, and a window carries them on to
the ranges behind it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold import schemas
from watchfold.session import ship
from watchfold.sources.files import open_filesystem

# Layout of the file format.
GLOBAL_HEADER, RECORD_HEADER = 24, 16
MAGICS = {
    b"\xd4\xc3\xb2\xa1": ("<", 1_000_000),
    b"\xa1\xb2\xc3\xd4": (">", 1_000_000),
    b"\x4d\x3c\xb2\xa1": ("<", 1_000_000_000),
    b"\xa1\xb2\x3c\x4d": (">", 1_000_000_000),
}
# Types, options and byte-order mark of pcapng blocks.
SECTION, INTERFACE, OLD_PACKET, SIMPLE_PACKET, PACKET = 0x0A0D0D0A, 1, 2, 3, 6
SECTION_MAGIC, BYTE_ORDERS = b"\x0a\x0d\x0d\x0a", {b"\x4d\x3c\x2b\x1a": "<", b"\x1a\x2b\x3c\x4d": ">"}
ORDER_MARK, KNOWN = 0x1A2B3C4D, (SECTION, *range(1, 11), 0x0BAD, 0x40000BAD)
END_OPTION, RESOLUTION_OPTION, OFFSET_OPTION = 0, 9, 14
# What a header's record limit of 0, or one beyond a file's size, stands for at least.
MAX_RECORD = 262_144
#: Blocks of a pcapng file that show where one begins, at least.
LEAST_BLOCKS = 8

CHUNK_BYTES = 64 << 20
_BATCH_BYTES = 8 << 20
#: Seconds by which records of one capture may lie apart where their order is in doubt.
_NEAR = 10 * 366 * 86_400
_RANGES = "path string, length bigint, start bigint, end bigint, carried array<binary>"
_ARROW_FRAMES = pa.schema(
    [
        ("capture", pa.string()),
        ("packet_id", pa.int64()),
        ("ts", pa.timestamp("us")),
        ("orig_len", pa.int64()),
        ("frame", pa.binary()),
        ("link", pa.int32()),
    ]
)


class _Record(NamedTuple):
    at: int
    end: int
    micros: int | None
    original: int
    frame: bytes
    link: int


def _fields(raw: np.ndarray, at: int, places: int, order: str) -> np.ndarray:
    """The 32-bit numbers that begin at each of ``places`` bytes from ``at`` on."""
    shifts = (0, 8, 16, 24) if order == "<" else (24, 16, 8, 0)
    parts = [raw[at + i : at + i + places] << s for i, s in enumerate(shifts)]
    return parts[0] | parts[1] | parts[2] | parts[3]


class _File:
    """One open file, and reading it in large blocks."""

    def __init__(self, path: str, length: int):
        filesystem, name = open_filesystem(path)
        self.path, self.length, self.file = path, length, filesystem.open_input_file(name)
        self.base, self.block = 0, b""

    def bytes_at(self, at: int, size: int) -> bytes:
        """``size`` bytes, fewer at the file's end."""
        if at < self.base or at + size > self.base + len(self.block):
            self.base, self.block = at, self.file.read_at(max(_BATCH_BYTES, size), at)
        return self.block[at - self.base : at - self.base + size]

    def first_record(self, start: int) -> int:
        """Offset of a record boundary at or after ``start``, the file's end if none.

        A boundary is an offset from which plausible headers chain on for longer
        than a usual record, so that no payload can fake the whole chain; the walk over
        the range before has to hit it. If longer records leave no boundary near
        ``start``, more of the file is searched.
        """
        if start <= self.first:
            return self.first
        reach = MAX_RECORD + RECORD_HEADER
        size = 4 * reach
        while start < self.length:
            found = self._boundary(start, size, reach)
            if found is not None:
                return found
            size *= 4
        return self.length

    def _chained(self, start: int, window: bytes, steps: np.ndarray, tail: int, reach: int) -> int | None:
        """The first place from which steps (0: none) lead on beyond ``reach`` or to the file's end."""
        at_end = start + len(window) == self.length
        for candidate in np.flatnonzero(steps):
            at = int(candidate)
            while at < len(steps) and steps[at] and at - candidate <= reach:
                at += int(steps[at])
            if at - candidate > reach or (at_end and at >= len(window) - tail):
                return start + int(candidate)
        return None

    def _damaged(self, at: int) -> ValueError:
        return ValueError(f"damaged record at byte {at} of {self.path}, see on_damage")

    def _missed(self, stop: int) -> ValueError:
        return ValueError(f"byte {stop} of {self.path} is no record boundary, see on_damage")


class _Classic(_File):
    """A pcap file: one byte order, one clock, one link type."""

    first = GLOBAL_HEADER

    def __init__(self, path: str, length: int):
        super().__init__(path, length)
        head = self.file.read_at(min(GLOBAL_HEADER + RECORD_HEADER, length), 0)
        if len(head) < GLOBAL_HEADER or head[:4] not in MAGICS:
            raise ValueError(f"not a classic capture file: {path}")
        self.order, self.ticks = MAGICS[head[:4]]
        # records are at most as long as the header says, and as the file
        self.named, link = struct.unpack(self.order + "II", head[16:24])
        self.link = link & 0xFFFF
        self.limit = min(max(self.named, MAX_RECORD), max(length, MAX_RECORD))
        self.header = struct.Struct(self.order + "IIII")
        self.seconds = struct.unpack(self.order + "I", head[24:28])[0] if len(head) >= 28 else 0

    def _boundary(self, start: int, size: int, reach: int) -> int | None:
        """The first boundary within ``size`` bytes, None if that is not enough to tell.

        A header read a few bytes late can look plausible, and so can all that follow it.
        What tells them apart is the format's law: as many bytes are kept as the
        packet had, or as the capture's limit allows, and records lie near the first
        one in time. Captures that break the first half are judged by the second.
        """
        window = self.file.read_at(min(size, self.length - start), start)
        at_end = start + len(window) == self.length
        raw = np.frombuffer(window, dtype=np.uint8).astype(np.uint32)
        places = len(window) - RECORD_HEADER + 1
        if places <= 0:
            return self.length
        seconds, ticks, kept, original = (_fields(raw, at, places, self.order) for at in (0, 4, 8, 12))
        near = np.abs(seconds.astype(np.int64) - self.seconds) <= _NEAR
        plausible = near & (ticks < self.ticks) & (kept <= self.limit) & (original >= kept)
        lawful = plausible & (kept == np.minimum(original, self.named or MAX_RECORD))
        for accepted in (lawful, plausible):
            steps = np.where(accepted, kept.astype(np.int64) + RECORD_HEADER, 0)
            found = self._chained(start, window, steps, RECORD_HEADER, reach)
            if found is not None:
                return found
        return self.length if at_end else None

    def records(self, first: int, stop: int, on_damage: str = "fail", carried: list[bytes] = ()) -> Iterator[_Record]:
        """Records from offset ``first`` on.

        Ends at ``stop``, which must be a boundary. A record cut off by the end of
        the file gives the bytes that are there. A length beyond the file's limit is
        damage and fails, or ends the walk if ``on_damage`` is stop.
        """
        at = first
        while at < stop and at + RECORD_HEADER <= self.length:
            seconds, ticks, kept, original = self.header.unpack(self.bytes_at(at, RECORD_HEADER))
            if kept > self.limit:
                if on_damage == "stop":
                    return
                raise self._damaged(at)
            end = at + RECORD_HEADER + kept
            micros = seconds * 1_000_000 + ticks * 1_000_000 // self.ticks
            yield _Record(at, min(end, self.length), micros, original, self.bytes_at(at + RECORD_HEADER, kept), self.link)
            at = end
        if at > stop and stop < self.length:
            raise self._missed(stop)

    def descriptions(self, first: int, stop: int) -> list[bytes]:
        return []


class _Interface(NamedTuple):
    link: int
    limit: int
    per_second: int
    offset: int

    def micros(self, units: int) -> int:
        return self.offset * 1_000_000 + units * 1_000_000 // self.per_second


class _Section:
    """Byte order and interfaces in force at some place of a pcapng file."""

    def __init__(self, order: str = "<"):
        self.order = order
        self.interfaces: list[_Interface] = []

    def describe(self, block: bytes) -> None:
        """Takes in a block that opens a section or describes an interface."""
        if block[:4] == SECTION_MAGIC:
            self.order, self.interfaces = BYTE_ORDERS[block[8:12]], []
            return
        link, _, limit = struct.unpack_from(self.order + "HHI", block, 8)
        per_second, offset, at = 1_000_000, 0, 16
        while at + 4 <= len(block) - 4:
            code, size = struct.unpack_from(self.order + "HH", block, at)
            value = block[at + 4 : at + 4 + size]
            if code == END_OPTION:
                break
            if code == RESOLUTION_OPTION and size:  # a power of two if the highest bit is set, else of ten
                per_second = 1 << (value[0] & 127) if value[0] & 128 else 10 ** value[0]
            elif code == OFFSET_OPTION and size == 8:
                (offset,) = struct.unpack(self.order + "q", value)
            at += 4 + -(-size // 4) * 4
        self.interfaces.append(_Interface(link, limit, per_second, offset))


class _Blocks(_File):
    """A pcapng file."""

    first = 0

    def _steps(self, words: np.ndarray, order: str) -> tuple[np.ndarray, np.ndarray]:
        """Words from each place on to the end of the block that begins there, 0 if none does.

        First for blocks that keep the format's law, then for all whose length stands at
        both ends.
        """
        numbers = words if order == "<" else words.byteswap()
        sizes = numbers[1:-1]
        good = np.flatnonzero((sizes >= 12) & (sizes & 3 == 0) & (sizes <= 4 * len(words)))
        good = good[good + sizes[good] // 4 <= len(words)]
        good = good[sizes[good] == numbers[good + sizes[good] // 4 - 1]]
        # a section tells its order itself
        good = good[(numbers[good] != SECTION) | (numbers[good + 2] == ORDER_MARK)]
        kinds, length = numbers[good], sizes[good]
        kept = numbers[np.minimum(good + 5, len(words) - 1)]
        lawful = np.isin(kinds, KNOWN)
        lawful &= ~np.isin(kinds, (OLD_PACKET, PACKET)) | ((length >= 32) & (kept <= np.maximum(length, 32) - 32))
        steps = np.zeros((2, len(words)), np.int32)
        steps[0][good[lawful]] = length[lawful] // 4
        steps[1][good] = length // 4
        return steps[0], steps[1]

    def _boundary(self, start: int, size: int, reach: int) -> int | None:
        """The first boundary within ``size`` bytes, None if that is not enough to tell.

        Blocks begin at multiples of four and have their length at both ends. So do any
        two equal words of packets that lie as far apart as they say: one long step
        proves nothing, and a chain has several blocks. It keeps to one byte order until
        a section tells another, as only in the other order a false block can end where
        a true one does. Chains of blocks that the format knows come before others.
        """
        start += -start % 4
        window = self.file.read_at(max(min(size, self.length - start), 0), start)
        at_end = start + len(window) >= self.length
        words = np.frombuffer(window, "<u4", len(window) // 4)
        if len(words) < 3:
            return self.length
        sections = words == SECTION
        for steps in zip(self._steps(words, "<"), self._steps(words, ">")):
            tried: set[tuple[int, int]] = set()
            for candidate in np.flatnonzero(steps[0] + steps[1]).tolist():
                for order in (0, 1):
                    at, blocks = candidate, 0
                    while at < len(words) and (4 * (at - candidate) <= reach or blocks < LEAST_BLOCKS):
                        if sections[at] and not steps[order][at]:
                            order = 1 - order
                        # what a chain that broke has been through leads nowhere
                        if not steps[order][at] or (at, order) in tried:
                            break
                        tried.add((at, order))
                        at, blocks = at + int(steps[order][at]), blocks + 1
                    far = 4 * (at - candidate) > reach and blocks >= LEAST_BLOCKS
                    if far or (at_end and 4 * at == len(window)):
                        return start + 4 * candidate
        return self.length if at_end else None

    def _walk(self, first: int, stop: int, section: _Section, on_damage: str) -> Iterator[tuple[int, int, int, int]]:
        """Type, offset, length and end of each block; sections are opened on the way."""
        at = first
        while at < stop and at + 12 <= self.length:
            head = self.bytes_at(at, 12)
            if head[:4] == SECTION_MAGIC and head[8:12] in BYTE_ORDERS:
                section.order = BYTE_ORDERS[head[8:12]]
            kind, size = struct.unpack(section.order + "II", head[:8])
            end = at + size
            whole = size >= 12 and size % 4 == 0
            if whole and end <= self.length:
                whole = self.bytes_at(at, size)[-4:] == head[4:8]
            if not whole or size > max(self.length, MAX_RECORD):
                if on_damage == "stop":
                    return
                raise self._damaged(at)
            yield kind, at, size, min(end, self.length)
            at = end
        if at > stop and stop < self.length:
            raise self._missed(stop)

    def records(self, first: int, stop: int, on_damage: str = "fail", carried: list[bytes] = ()) -> Iterator[_Record]:
        """Packets of the blocks from offset ``first`` on; see :meth:`_Classic.records`.

        ``carried`` are the descriptions that hold there. Simple packets have no time.
        """
        section = _Section()
        for block in carried:
            section.describe(block)
        for kind, at, size, end in self._walk(first, stop, section, on_damage):
            if kind in (SECTION, INTERFACE):
                if end == at + size:
                    section.describe(self.bytes_at(at, size))
                continue
            if kind not in (PACKET, OLD_PACKET, SIMPLE_PACKET):
                continue
            fixed = 12 if kind == SIMPLE_PACKET else 28
            if end - at < fixed:
                continue
            head = self.bytes_at(at, fixed)
            number, micros = 0, None
            if kind == SIMPLE_PACKET:
                (original,) = struct.unpack_from(section.order + "I", head, 8)
                kept = min(original, size - 16)
            elif kind == PACKET:
                number, high, low, kept, original = struct.unpack_from(section.order + "IIIII", head, 8)
            else:
                number, _, high, low, kept, original = struct.unpack_from(section.order + "HHIIII", head, 8)
            if number >= len(section.interfaces) or kept > size - fixed - 4:
                if on_damage == "stop":
                    return
                raise self._damaged(at)
            interface = section.interfaces[number]
            if kind == SIMPLE_PACKET:
                kept = min(kept, interface.limit or kept)
            else:
                micros = interface.micros(high << 32 | low)
            frame = self.bytes_at(at + fixed, min(kept, end - at - fixed))
            yield _Record(at, end, micros, original, frame, interface.link)

    def descriptions(self, first: int, stop: int) -> list[bytes]:
        """The blocks that open the last section of a range or describe interfaces in it.

        A range may begin within a section whose byte order only an earlier one tells: it
        is the one in which the blocks chain on.
        """
        failed: list[tuple[int, ValueError]] = []
        for order in "<>":
            out: list[bytes] = []
            blocks = 0
            try:
                for kind, at, size, end in self._walk(first, stop, _Section(order), "fail"):
                    blocks += 1
                    if kind in (SECTION, INTERFACE) and end == at + size:
                        block = self.bytes_at(at, size)
                        out = [block] if kind == SECTION else [*out, block]
                return out
            except ValueError as damage:
                failed.append((blocks, damage))
        raise max(failed, key=lambda f: f[0])[1]


def _open(path: str, length: int) -> _Classic | _Blocks:
    filesystem, name = open_filesystem(path)
    with filesystem.open_input_file(name) as file:
        magic = file.read_at(min(4, length), 0)
    return _Blocks(path, length) if magic == SECTION_MAGIC else _Classic(path, length)


def _frames(batches: Iterator[pa.RecordBatch], on_damage: str = "fail") -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            capture = _open(row["path"], row["length"])
            start, end = row["start"], row["end"]
            if isinstance(capture, _Blocks) and row["carried"] is None:
                # nobody has looked for descriptions before this range: one task reads the file
                if start:
                    continue
                end = row["length"]
            # Neighbouring ranges find the boundary between them by the same probe,
            # and the walk over the earlier one has to hit it exactly.
            first, stop = capture.first_record(start), capture.first_record(end)
            records: list[_Record] = []
            held = 0
            for record in capture.records(first, stop, on_damage, row["carried"] or ()):
                records.append(record)
                held += len(record.frame) + RECORD_HEADER
                if held >= _BATCH_BYTES:
                    yield _batch(row["path"], records)
                    records, held = [], 0
            if records:
                yield _batch(row["path"], records)


def _batch(path: str, records: list[_Record]) -> pa.RecordBatch:
    arrays = [
        pa.array([path] * len(records), pa.string()),
        pa.array([r.at for r in records], pa.int64()),
        pa.array([r.micros for r in records], pa.int64()).cast(pa.timestamp("us")),
        pa.array([r.original for r in records], pa.int64()),
        pa.array([r.frame for r in records], pa.binary()),
        pa.array([r.link for r in records], pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW_FRAMES)


def _skipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where the walk over each file ends for damage, and the bytes behind that."""
    for batch in batches:
        for row in batch.to_pylist():
            capture = _open(row["path"], row["length"])
            at, least = capture.first, RECORD_HEADER
            if isinstance(capture, _Blocks):
                least = 12
                for _, _, _, at in capture._walk(0, capture.length, _Section(), "stop"):
                    pass
            else:
                for record in capture.records(at, capture.length, "stop"):
                    at = record.end
            if at + least <= capture.length:
                yield pa.RecordBatch.from_pydict(
                    {"capture": [row["path"]], "damaged_at": [at], "skipped_bytes": [capture.length - at]}
                )


def _surveyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each range with the descriptions it adds, and whether it opens a section."""
    for batch in batches:
        added, opens = [], []
        for row in batch.to_pylist():
            capture = _open(row["path"], row["length"])
            found = []
            if isinstance(capture, _Blocks):
                found = capture.descriptions(capture.first_record(row["start"]), capture.first_record(row["end"]))
            added.append(found or None)
            opens.append(bool(found) and found[0][:4] == SECTION_MAGIC)
        batch = batch.append_column("added", pa.array(added, pa.list_(pa.binary())))
        yield batch.append_column("opens", pa.array(opens, pa.bool_()))


def _carried(ranges: DataFrame, tasks: int) -> DataFrame:
    """Ranges of files with the descriptions in force where each begins (``carried``).

    Ranges that share the same last opened section collect what it and they have added;
    a range gets what the one before it ends with.
    """
    added = ranges.repartition(tasks).mapInArrow(
        _surveyed, "path string, length bigint, start bigint, end bigint, added array<binary>, opens boolean"
    )
    places = Window.partitionBy("path").orderBy("start")
    numbered = added.withColumn("_section", F.sum(F.col("opens").cast("int")).over(places))
    within = Window.partitionBy("path", "_section").orderBy("start")
    ending = numbered.withColumn("_ending", F.flatten(F.collect_list("added").over(within)))
    carried = F.coalesce(F.lag("_ending").over(places), F.array().cast("array<binary>"))
    return ending.select("path", "length", "start", "end", carried.alias("carried"))


def _ranges(files: DataFrame, size: Column) -> DataFrame:
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), size)
    return files.select("path", "length", F.explode(starts).alias("start")).select(
        "*", F.least(F.col("start") + size, F.col("length")).alias("end"), F.lit(None).cast("array<binary>").alias("carried")
    )


def read_frames(
    spark: SparkSession,
    paths: str | list[str],
    chunk_bytes: int = CHUNK_BYTES,
    on_damage: str = "fail",
) -> DataFrame:
    """Frames of capture files: ``capture, packet_id, ts, orig_len, frame, link``.

    Both formats may lie side by side. ``packet_id`` is the record's byte offset: unique
    within a capture, rising, and known without counting. ``link`` and the clock behind
    ``ts`` are the interface's; packets of simple blocks have no time. Ranges of a file
    are read in parallel (of a pcapng file twice, as its descriptions are looked for
    first); a job either reads every record exactly once or fails. Damaged files, which
    only a walk from the start can judge, can be read up to the damage with
    ``on_damage='stop'``, in one task per file; ``skipped_bytes`` tells what that leaves
    out.
    """
    if on_damage not in ("fail", "stop"):
        raise ValueError(f"on_damage must be 'fail' or 'stop', not {on_damage!r}")
    if chunk_bytes < 4 * MAX_RECORD:
        raise ValueError(f"chunk_bytes must be at least {4 * MAX_RECORD}")
    ship(spark, "watchfold")
    files = spark.read.format("binaryFile").load(paths)
    size = F.lit(chunk_bytes) if on_damage == "fail" else F.greatest(F.col("length"), F.lit(1))
    # Rows are tiny but stand for much work: a number of partitions from the files' size,
    # known from their listing, keeps adaptive execution from merging them. Small files
    # spread over the tasks that run at once.
    total = int(str(files._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    spread = min(len(files.inputFiles()), spark.sparkContext.defaultParallelism)
    tasks = max(1, -(-total // chunk_bytes), spread)
    ranges = _ranges(files, size)
    if on_damage == "fail" and total > chunk_bytes:
        several = F.col("length") > chunk_bytes
        ranges = ranges.filter(~several).unionByName(_carried(ranges.filter(several).drop("carried"), tasks))
    return ranges.repartition(tasks).mapInArrow(partial(_frames, on_damage=on_damage), schemas.FRAMES)


def skipped_bytes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``capture, damaged_at, skipped_bytes`` of files that ``on_damage='stop'`` cuts off."""
    ship(spark, "watchfold")
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    return files.mapInArrow(_skipped, "capture string, damaged_at bigint, skipped_bytes bigint")


def read_frame_stream(
    spark: SparkSession,
    folder: str,
    max_files_per_trigger: int | None = None,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Frames of capture files that appear in a folder, by the same ranges.

    A pcapng file is read by one task, as ranges of a stream cannot wait for others.
    """
    ship(spark, "watchfold")
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary"
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    ranges = _ranges(reader.load(folder), F.lit(chunk_bytes))
    return ranges.repartition("path", "start").mapInArrow(_frames, schemas.FRAMES)
