"""Log files that grow, as a stream: a Python data source whose offsets are byte positions.

An offset holds, for every file of the folder, where its last complete line ends and what
its first bytes are. A batch is the ranges between two offsets, cut into pieces that
tasks read in parallel. First bytes tell a file that goes on from one that was put in
its place, and find a file again that was renamed, so that rotated logs are read once.
Since offsets lie in the stream's checkpoint, this holds over restarts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from watchfold.functions.text import clean_utf8
from watchfold.session import ship
from watchfold.sources.files import open_filesystem

#: First bytes that tell files apart, at most.
HEAD_BYTES = 1024
#: Bytes of a file that one task reads.
RANGE_BYTES = 64 << 20
_READ = 1 << 20
_BATCH_LINES = 20_000


@dataclass
class _Range(InputPartition):
    path: str
    start: int
    end: int
    first: bool


class _Reader(DataSourceStreamReader):
    def __init__(self, folder: str, range_bytes: int):
        self.folder, self.range_bytes = folder.rstrip("/"), range_bytes
        self.filesystem, self.root = open_filesystem(self.folder)

    def _digest(self, path: str, size: int) -> str:
        with self.filesystem.open_input_file(path) as file:
            return hashlib.sha256(file.read_at(size, 0)).hexdigest()

    def _last_line_end(self, path: str, size: int) -> int:
        """Where the last complete line ends; the file is searched from its end."""
        with self.filesystem.open_input_file(path) as file:
            high = size
            while high > 0:
                low = max(0, high - _READ)
                at = file.read_at(high - low, low).rfind(b"\n")
                if at >= 0:
                    return low + at + 1
                high = low
        return 0

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out = {}
        for info in self.filesystem.get_file_info(pafs.FileSelector(self.root, allow_not_found=True)):
            if info.type == pafs.FileType.File and not info.base_name.startswith((".", "_")):
                end = self._last_line_end(info.path, info.size)
                if end:
                    size = min(end, HEAD_BYTES)
                    out[info.path] = {"end": end, "size": size, "head": self._digest(info.path, size)}
        return out

    def _goes_on(self, path: str, now: dict, before: dict) -> bool:
        """Whether a file begins with the bytes that were there before."""
        if now["end"] < before["end"]:
            return False
        if now["size"] == before["size"]:
            return now["head"] == before["head"]
        return now["size"] > before["size"] and self._digest(path, before["size"]) == before["head"]

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        moved = [
            before for path, before in start.items() if path not in end or not self._goes_on(path, end[path], before)
        ]
        out = []
        for path, now in sorted(end.items()):
            known = start.get(path)
            if known is None or not self._goes_on(path, now, known):
                known = next((before for before in moved if self._goes_on(path, now, before)), None)
                if known is not None:
                    moved.remove(known)
            at = known["end"] if known else 0
            first = at
            while at < now["end"]:
                stop = min(at + self.range_bytes, now["end"])
                out.append(_Range(path, at, stop, at == first))
                at = stop
        return out

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        """Lines that begin in a range; the last one may go on beyond it."""
        with self.filesystem.open_input_file(partition.path) as file:
            at = partition.start if partition.first else partition.start - 1
            rest, places, lines = b"", [], []
            skipping = not partition.first
            while at < partition.end or rest or skipping:
                block = file.read_at(_READ, at + len(rest))
                data = rest + block
                pieces = data.split(b"\n")
                rest = pieces.pop()
                for piece in pieces:
                    if skipping:
                        skipping = False
                    elif at < partition.end:
                        places.append(at)
                        lines.append(piece[:-1] if piece.endswith(b"\r") else piece)
                    at += len(piece) + 1
                if at >= partition.end or not block:
                    break
                if len(lines) >= _BATCH_LINES:
                    yield _batch(self.folder, self.root, partition.path, places, lines)
                    places, lines = [], []
        if lines:
            yield _batch(self.folder, self.root, partition.path, places, lines)

    def commit(self, end: dict) -> None:
        pass


def _batch(folder: str, root: str, path: str, places: list[int], lines: list[bytes]) -> pa.RecordBatch:
    name = folder + path[len(root.rstrip("/")) :]
    return pa.record_batch(
        {
            "file_path": pa.array([name] * len(lines), pa.string()),
            "place": pa.array(places, pa.int64()),
            "line": pa.array(lines, pa.binary()),
        }
    )


class GrowingFiles(DataSource):
    """``spark.readStream.format("growing_files").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "growing_files"

    def schema(self) -> str:
        return "file_path string, place bigint, line binary"

    def streamReader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("rangeBytes", RANGE_BYTES)))


def read_growing_lines(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines of a folder's files as they are written: ``file_path, line_number, raw, place``.

    Files may come, grow, be renamed or be replaced between batches; each complete line
    comes through once, over restarts as well. A line without its end waits. ``place`` is
    the line's byte position. A file replaced by a longer one with the same first
    ``HEAD_BYTES`` bytes cannot be told from one that has grown.
    """
    ship(spark, "watchfold")
    spark.dataSource.register(GrowingFiles)
    rows = spark.readStream.format("growing_files").option("rangeBytes", range_bytes).load(folder)
    return rows.select(
        "file_path",
        F.lit(None).cast("bigint").alias("line_number"),
        clean_utf8(F.col("line").cast("string")).alias("raw"),
        "place",
    )
