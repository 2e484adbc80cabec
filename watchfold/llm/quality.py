"""Quality by distance from a language's usual text.

Two histograms describe a document: its characters by class, and its words by the
language's commonest words and one bin for all others. Each is compared with that of all
documents of the same language by the Jensen-Shannon distance (base 2, 0 to 1). A
document is kept if neither distance is above its limit, which is wider for short texts
as these scatter: a limit plus a slack over the root of the number of characters or words.
A histogram of fewer characters or words than its minimum says nothing and is not compared.

Every language has a reference of its own, however few documents it has, so that what a
document is judged by does not depend on other languages. A reference is 79 numbers; more than
``MOST_LANGUAGES`` languages are refused. Documents in a language without a reference are judged
by the base rules alone.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.llm import words
from watchfold.llm.graphs import stored
from watchfold.session import ship

#: Languages that may have a reference (5 MB of references and 8 MB of common words).
MOST_LANGUAGES = 8192
COMMON_WORDS = 64
#: Fewer characters or words make no histogram.
LEAST_CHARACTERS = 200
LEAST_WORDS = 40
#: Largest distances of a long document that is kept, and what shortness adds.
CHARACTER_LIMIT, CHARACTER_SLACK = 0.25, 1.5
WORD_LIMIT, WORD_SLACK = 0.30, 1.2
#: Base rules: fewest words, and largest percentage of words in repeated windows.
FEWEST_WORDS = 20
REPEATED_PERCENT = 30
REPEAT_WINDOW = 8

_SYMBOLS = b"#*$%&|<>"
_HELD = 1 << 19
_NEWLINE = np.arange(256) == 10


def _classes() -> np.ndarray:
    """Class of each byte that begins a character; 0 for those that continue one."""
    table = np.zeros(256, np.int64)
    table[:0x80] = 1  # other ASCII
    for number, some in enumerate(
        (
            b"abcdefghijklmnopqrstuvwxyz",
            b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
            b"0123456789",
            b" \t",
            b"\n\r",
            b".,;:",
            b"!?",
            b"'\"()-",
            _SYMBOLS,
        ),
        start=2,
    ):
        table[list(some)] = number
    table[0xC0:0xE0], table[0xE0:0xF0], table[0xF0:] = 11, 12, 13  # two, three and four bytes
    return table


_CLASS = _classes()
CLASSES = 14


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance (base 2) of each row of ``p`` from the same row of ``q``; rows sum to 1."""
    middle = (p + q) / 2

    def part(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / middle), 0.0).sum(1)

    return np.sqrt(np.clip((part(p) + part(q)) / 2, 0.0, 1.0))


@dataclass
class References:
    """Histograms of the languages; the last one is empty and stands for unknown languages."""

    languages: dict[str | None, int]
    characters: np.ndarray
    words: np.ndarray
    #: (language, word) as a sorted hash, and the word's bin
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    bins: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def number(self, language: str | None) -> int:
        return self.languages.get(language, len(self.languages))


def _word_key(language: np.ndarray, word: np.ndarray) -> np.ndarray:
    return words.mix(word + language.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _counts(batches: Iterator[pa.RecordBatch], languages: dict[str | None, int]) -> Iterator[pa.RecordBatch]:
    """Words (lower-cased) and character classes of each language, summed per task."""
    counts: dict[int, Counter[bytes]] = defaultdict(Counter)
    classes = np.zeros((len(languages) + 1, CLASSES), np.int64)

    def flush() -> pa.RecordBatch:
        rows = [(k, w, n) for k, c in counts.items() for w, n in c.items()]
        counts.clear()
        return pa.record_batch(
            {
                "language": pa.array([r[0] for r in rows], pa.int32()),
                "class": pa.array([None] * len(rows), pa.int32()),
                "word": pa.array([r[1] for r in rows], pa.binary()),
                "n": pa.array([r[2] for r in rows], pa.int64()),
            }
        )

    for batch in batches:
        names = batch.column("lang").to_pylist()
        texts = pc.fill_null(batch.column("text").cast(pa.large_binary()), b"")
        for name, text in zip(names, texts, strict=True):
            k = languages.get(name, len(languages))
            data = text.as_py()
            counts[k].update(data.lower().split())
            classes[k] += np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=CLASSES)
        if sum(map(len, counts.values())) > _HELD:
            yield flush()
    yield flush()
    language, number = np.nonzero(classes)
    yield pa.record_batch(
        {
            "language": pa.array(language, pa.int32()),
            "class": pa.array(number, pa.int32()),
            "word": pa.array([None] * len(language), pa.binary()),
            "n": pa.array(classes[language, number]),
        }
    )


def references(docs: DataFrame) -> References:
    """References of the languages of ``docs`` (text, lang) from all its documents.

    A null language is one like any other. More than ``MOST_LANGUAGES`` are an error.
    """
    ship(docs.sparkSession, "watchfold")
    docs = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    names = docs.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = {name: k for k, name in enumerate(sorted((r[0] for r in names), key=lambda x: (x is None, x or "")))}
    counted = docs.mapInArrow(
        partial(_counts, languages=languages), "language int, class int, word binary, n long"
    ).groupBy("language", "class", "word").agg(F.sum("n").alias("n"))
    counted = stored(counted, "counts")
    ranked = Window.partitionBy("language").orderBy(F.desc("n"), "word")
    spoken = counted.filter("word is not null")
    top = spoken.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= COMMON_WORDS)
    top = top.select("language", "word", "n", "rank").toArrow()
    all_words = {r[0]: r[1] for r in spoken.groupBy("language").agg(F.sum("n")).collect()}
    rows = len(languages) + 1
    characters, spread = np.zeros((rows, CLASSES)), np.zeros((rows, COMMON_WORDS + 1))
    plain = counted.filter("word is null").select("language", "class", "n").toArrow()
    characters[plain.column("language").to_numpy(), plain.column("class").to_numpy()] = plain.column("n").to_numpy()
    characters[:, 0] = 0  # bytes that continue a character
    keys, bins = [], []
    for r in (r for batch in top.to_batches() for r in batch.to_pylist()):
        k, word = r["language"], r["word"]
        spread[k, r["rank"] - 1] = r["n"]
        data = np.frombuffer(word, np.uint8)
        value = words.hash_words(data, words.split(data, np.array([0, len(data)])))
        keys.append(_word_key(np.array([k]), value)[0])
        bins.append(r["rank"] - 1)
    for k, n in all_words.items():
        spread[k, COMMON_WORDS] = n - spread[k].sum()
    characters /= np.maximum(characters.sum(1, keepdims=True), 1)
    spread /= np.maximum(spread.sum(1, keepdims=True), 1)
    order = np.argsort(np.array(keys, np.uint64))
    return References(
        languages, characters, spread, np.array(keys, np.uint64)[order], np.array(bins, np.int64)[order]
    )


def _repeated(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which entries have an equal one in the same row."""
    key = words.mix(hashes + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    return (count > 1)[place]


def measures(data: np.ndarray, offsets: np.ndarray, language: np.ndarray, known: References) -> dict[str, np.ndarray]:
    """Counts and distances of each row of a piece."""
    rows = len(offsets) - 1
    found = words.split(data, offsets)
    n_words, word_row = found.counts, found.row
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    word_chars = np.bincount(word_row, begins[found.end] - begins[found.start], rows).astype(np.int64)

    size = np.diff(offsets)
    byte_row = np.repeat(np.arange(rows), size)
    classes = np.bincount(byte_row * CLASSES + _CLASS[data], minlength=rows * CLASSES).reshape(rows, CLASSES)
    symbols = np.isin(np.arange(256), list(_SYMBOLS))

    # lines with a word that equal an earlier one
    lines = words.split(data, offsets, _NEWLINE)
    line_hash, line_row = words.hash_words(data, lines), lines.row
    spoken = np.searchsorted(found.start, lines.end) > np.searchsorted(found.start, lines.start)
    line_key = words.mix(line_hash + line_row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))[spoken]
    _, kept = np.unique(line_key, return_index=True)
    n_dup = np.bincount(line_row[spoken], minlength=rows) - np.bincount(line_row[spoken][kept], minlength=rows)

    # words in windows that occur again in the same text
    hashes = words.hash_words(data, found)
    runs, first = words.windows(hashes, found.first, REPEAT_WINDOW)
    run_row = np.repeat(np.arange(rows), np.diff(first))
    again = _repeated(runs, run_row)
    start = (np.arange(len(runs)) - first[run_row] + found.first[run_row])[again]
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + REPEAT_WINDOW, -1)
    n_repeat = np.bincount(word_row, np.cumsum(change)[:-1] > 0, rows).astype(np.int64)

    # histograms; common words are compared in lower case
    lowered = words.LOWER[data]
    key = _word_key(language[word_row], words.hash_words(lowered, found))
    bins = np.full(len(key), COMMON_WORDS)
    if len(known.keys):
        at = np.minimum(np.searchsorted(known.keys, key), len(known.keys) - 1)
        bins = np.where(known.keys[at] == key, known.bins[at], COMMON_WORDS)
    width = COMMON_WORDS + 1
    spread = np.bincount(word_row * width + bins, minlength=rows * width).reshape(rows, width)
    plain = classes.astype(np.float64)
    plain[:, 0] = 0
    n_chars = plain.sum(1)
    character = jensen_shannon(plain / np.maximum(n_chars, 1)[:, None], known.characters[language])
    word = jensen_shannon(spread / np.maximum(n_words, 1)[:, None], known.words[language])
    compared = known.characters.sum(1)[language] > 0
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": np.bincount(byte_row, symbols[data], rows).astype(np.int64),
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
        "n_characters": n_chars.astype(np.int64),
        "character_distance": np.where(compared & (n_chars >= LEAST_CHARACTERS), character, np.nan),
        "word_distance": np.where(compared & (n_words >= LEAST_WORDS), word, np.nan),
    }


def _measured(batches: Iterator[pa.RecordBatch], known: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        language = np.array([known.value.number(x) for x in batch.column("lang").to_pylist()], np.int64)
        for piece in words.pieces(batch.column("text")):
            rows = piece.last - piece.first
            found = measures(piece.data, piece.offsets, language[piece.first : piece.last], known.value)
            columns = {"doc_id": batch.column("doc_id").slice(piece.first, rows)}
            yield pa.record_batch(columns | {k: pa.array(v, from_pandas=True) for k, v in found.items()})


def quality(
    docs: DataFrame,
    known: References,
    character_limit: float = CHARACTER_LIMIT,
    word_limit: float = WORD_LIMIT,
) -> DataFrame:
    """Counts, distances and verdicts for every row of ``docs`` (doc_id, text, lang).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_characters,
    character_distance and word_distance; a distance is null where
    the text is too short. Null texts count as empty: no words, base_failed. A null
    language is one like any other; one that ``known`` lacks has no distances. Equal rows get equal results;
    extra columns are not looked at.
    """
    ship(docs.sparkSession, "watchfold")
    rows = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(known)
    schema = (
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "n_characters long, character_distance double, word_distance double"
    )
    found = rows.mapInArrow(partial(_measured, known=sent), schema)
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    near = F.lit(True)
    for distance, size, limit, slack in (
        ("character_distance", "n_characters", character_limit, CHARACTER_SLACK),
        ("word_distance", "n_words", word_limit, WORD_SLACK),
    ):
        near &= F.coalesce(F.col(distance) <= limit + slack / F.sqrt(size), F.lit(True))
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(
        *counts,
        failed.alias("base_failed"),
        (~failed & near).alias("kept"),
        "n_characters",
        "character_distance",
        "word_distance",
    )
