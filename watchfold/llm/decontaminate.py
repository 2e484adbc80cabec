"""Benchmark passages in documents, by one Aho-Corasick automaton over words.

Texts are normalised to words: A-Z lower-cased, everything but ASCII letters, digits and
non-ASCII characters separates. Each word of the benchmark is one symbol, any other word
a symbol of no pattern, so that the automaton reads a document once, a step per word, and
matches end at word borders by themselves. Its patterns are the items' windows of ten
words; an item of fewer words is one window. Word numbers map back to characters of the
original text.

The benchmark is cut into blocks of a bounded number of words by a hash of its items; an
automaton is built per block, and rows pass the blocks one after the other. A benchmark
of one block, the usual case, is scanned in one pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold.llm import words
from watchfold.session import ship

WINDOW = 10
#: Words of benchmark text in one automaton; its vocabulary then fits the symbols.
BLOCK_WORDS = 1 << 19

_FOLD = bytes(0x20 if words.NOT_ALNUM[words.LOWER[b]] else int(words.LOWER[b]) for b in range(256))
_OTHER = "\0"
_FOUND = "spans array<struct<word: int, words: int, start: int, end: int>>, items array<string>"


def word_list(text: str | None) -> list[bytes]:
    """The normalised words of a text."""
    return (text or "").encode().translate(_FOLD).split()


class Automaton:
    """The windows of benchmark items as patterns over word symbols."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        vocabulary: dict[bytes, str] = {}
        owners: dict[str, set[str | None]] = {}
        for item_id, text in items:
            found = word_list(text)
            for word in found:
                if word not in vocabulary:
                    number = len(vocabulary) + 1
                    vocabulary[word] = chr(number if number < 0xD800 else number + 0x800)
            symbols = "".join(map(vocabulary.__getitem__, found))
            size = min(window, len(symbols))
            for i in range(len(symbols) - size + 1 if size else 0):
                owners.setdefault(symbols[i : i + size], set()).add(item_id)
        self.symbol = vocabulary.get
        self.machine = None
        if owners:
            self.machine = ahocorasick.Automaton()
            for pattern, ids in owners.items():
                self.machine.add_word(pattern, (len(pattern), tuple(ids)))
            self.machine.make_automaton()

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Merged word ranges covered by matches, and the items they belong to."""
        if self.machine is None or not found:
            return [], set()
        ranges: list[list[int]] = []
        items: set[str | None] = set()
        for last, (size, ids) in self.machine.iter("".join(map(self.symbol, found, repeat(_OTHER)))):
            low, high = last + 1 - size, last + 1
            while ranges and ranges[-1][1] >= low:
                low = min(low, ranges.pop()[0])
            ranges.append([low, high])
            items.update(ids)
        return [(low, high) for low, high in ranges], items


_built: dict[str, Automaton] = {}


def _automaton(items: Broadcast, window: int) -> Automaton:
    """The block's automaton, built once per worker process."""
    name, rows = items.value
    if name not in _built:
        _built.clear()
        _built[name] = Automaton(rows, window)
    return _built[name]


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _spans(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges with the characters that they cover in the original text."""
    if not ranges:
        return []
    data = np.frombuffer(text.encode(), np.uint8)
    found = words.split(words.LOWER[data], np.array([0, len(data)]), words.NOT_ALNUM)
    character = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [
        {
            "word": low,
            "words": high - low,
            "start": int(character[found.start[low]]),
            "end": int(character[found.end[high - 1]]),
        }
        for low, high in ranges
    ]


def _scan(batches: Iterator[pa.RecordBatch], items: Broadcast, window: int, first: bool) -> Iterator[pa.RecordBatch]:
    automaton = _automaton(items, window)
    spans_type = pa.list_(
        pa.struct([("word", pa.int32()), ("words", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    )
    for batch in batches:
        size, all_spans, all_items = [], [], []
        for i, text in enumerate(batch.column("text")):
            text = text.as_py() or ""
            found = word_list(text)
            ranges, ids = automaton.scan(found)
            names = {x for x in ids if x is not None}
            if not first:
                before = batch.column("spans")[i].as_py()
                ranges = _merged([*ranges, *((s["word"], s["word"] + s["words"]) for s in before)])
                names.update(batch.column("items")[i].as_py())
            size.append(len(found))
            all_spans.append(_spans(text, ranges))
            all_items.append(sorted(names))
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "text": batch.column("text"),
                "n_words": pa.array(size, pa.int64()),
                "spans": pa.array(all_spans, spans_type),
                "items": pa.array(all_items, pa.list_(pa.string())),
            }
        )


def _clean(batches: Iterator[pa.RecordBatch], items: Broadcast, window: int) -> Iterator[pa.RecordBatch]:
    automaton = _automaton(items, window)
    for batch in batches:
        keep = [not automaton.scan(word_list(text.as_py()))[0] for text in batch.column("text")]
        yield batch.filter(pa.array(keep, pa.bool_()))


def _blocks(benchmark: DataFrame) -> Iterator[Broadcast]:
    """The items in blocks of a bounded number of words, one at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    ).filter("text is not null").distinct()
    size = F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    total = items.agg(F.sum(size)).first()[0] or 0
    count = max(1, -(-total * 2 // BLOCK_WORDS))  # half full on average, so that chance does not overfill one
    for k in range(count):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        rows = [(r[0], r[1]) for r in block.collect()]
        yield spark.sparkContext.broadcast((uuid.uuid4().hex, rows))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, spans, items)`` for every row of ``docs`` (doc_id, text).

    ``spans`` are the merged ranges of words inside occurrences of windows of
    ``benchmark`` (item_id, text), each with its first word, number of words and the
    characters it covers in the original text; ``items`` are the item_ids, as sorted
    strings, that have an occurring window. Null texts have no words; items without
    words have no window. An item without item_id counts for the spans but is not
    listed; equal item_ids count as one. Extra columns are not looked at.
    """
    ship(docs.sparkSession, "watchfold")
    found = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = found.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text string, n_words long, {_FOUND}"
    for k, items in enumerate(_blocks(benchmark)):
        found = found.mapInArrow(partial(_scan, items=items, window=window, first=k == 0), schema)
    return found.drop("text")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` whose text has no occurrence of a benchmark window."""
    ship(docs.sparkSession, "watchfold")
    for items in _blocks(benchmark):
        docs = docs.mapInArrow(partial(_clean, items=items, window=window), docs.schema)
    return docs


def hit_words(spans: Column) -> Column:
    """Number of words in the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["words"])
