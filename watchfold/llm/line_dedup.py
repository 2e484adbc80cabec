"""Repeated passages by overlapping windows of three lines.

Lines are compared without the white space around them, and lines without a word are
passed over. Each run of three consecutive lines is a window, known by a hash. Of a
window that stands in several places, the first one (by doc_id, then position) stays;
the lines of all others, which may overlap, are merged and removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchfold.llm.graphs import stored
from watchfold.session import ship

WINDOW = 3


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def line_windows(text: bytes, size: int = WINDOW) -> tuple[list[int], list[int]]:
    """Numbers of the lines with a word, and a hash of each run of ``size`` of them."""
    kept, hashes = [], []
    for number, line in enumerate(text.split(b"\n")):
        line = line.strip()
        if line:
            kept.append(number)
            hashes.append(xxhash.xxh3_64_digest(line))
    runs = range(len(kept) - size + 1)
    return kept, [_signed(xxhash.xxh3_64_intdigest(b"".join(hashes[i : i + size]))) for i in runs]


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in pc.fill_null(batch.column("text").cast(pa.large_binary()), b""):
        yield text.as_py()


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of each document."""
    names = ["window", "doc_id", "row_hash", "place"]
    for batch in batches:
        columns: list[list[int]] = [[], [], [], []]
        for doc_id, row_hash, text in zip(
            batch.column("doc_id").to_pylist(), batch.column("row_hash").to_pylist(), _texts(batch), strict=True
        ):
            _, found = line_windows(text)
            for column, values in zip(
                columns, (found, [doc_id] * len(found), [row_hash] * len(found), range(len(found))), strict=True
            ):
                column.extend(values)
            if len(columns[0]) > 100_000:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)
                columns = [[], [], [], []]
        if columns[0]:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines from the first to the last of each listed window."""
    for batch in batches:
        texts, lines, gone = [], [], []
        for text, places in zip(batch.column("text").to_pylist(), batch.column("places"), strict=True):
            each = [] if text is None else text.split("\n")
            covered: set[int] = set()
            if places.is_valid:
                kept, _ = line_windows(text.encode())
                for place in places.as_py():
                    covered.update(range(kept[place], kept[place + WINDOW - 1] + 1))
            texts.append("\n".join(x for i, x in enumerate(each) if i not in covered) if covered else text)
            lines.append(len(each))
            gone.append(len(covered))
        out = batch.drop_columns(["text", "places"])
        for name, column in (
            ("n_lines", pa.array(lines, pa.int64())),
            ("n_removed", pa.array(gone, pa.int64())),
            ("text", pa.array(texts, pa.string())),
        ):
            out = out.append_column(name, column)
        yield out


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_removed, text)`` for every row of ``docs`` (doc_id, text):
    the text without passages that stood earlier, and how many lines it had and lost.

    Null stays null and has no lines. Texts of fewer than three lines with a word have no
    window and stay as they are. Earlier means a smaller doc_id (null first), then, among
    rows of one doc_id, a smaller hash of the text, then a place nearer to the beginning.
    Equal rows are one document and get equal results. Extra columns are not looked at.
    """
    ship(docs.sparkSession, "watchfold")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("row_hash", F.xxhash64("text"))
    places = stored(docs.mapInArrow(_places, "window long, doc_id long, row_hash long, place long"), "windows")
    first = places.groupBy("window").agg(
        F.min(F.struct("doc_id", "row_hash", "place")).alias("first"), F.count("*").alias("n")
    )
    first = first.filter("n > 1").select("window", "first")
    later = places.join(first, "window").filter("not struct(doc_id, row_hash, place) <=> first")
    later = later.groupBy("doc_id", "row_hash").agg(F.collect_set("place").alias("places"))
    marked = docs.alias("d").join(
        later.alias("l"),
        F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & F.col("d.row_hash").eqNullSafe(F.col("l.row_hash")),
        "left",
    )
    marked = marked.select("d.doc_id", "d.text", F.array_sort("l.places").alias("places"))
    return marked.mapInArrow(_without, "doc_id long, n_lines long, n_removed long, text string")
