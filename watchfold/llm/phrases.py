"""Phrases of words that keep together, counted in quotient filters.

Only words that occur often enough can be part of a phrase that does, so words are
counted first. The most frequent of them, at most ``HEAD``, get small numbers and are sent
to all tasks; a phrase of such words is one packed 64-bit key. Other frequent words, which a
bitmap of fixed size lets through, keep their 64-bit hashes, and phrases with such a word
have a key of three. Tasks count keys in filters (:mod:`watchfold.llm.quotient`), one for
each shard of the permuted keys, and filters of a shard merge as sorted runs. The
permutation spreads keys evenly, and a frequent phrase is one entry per filter, so that no
shard is large. Nothing is lost: keys come back from the filters as they went in.

Words are told apart by a hash of language and word. That no two words of the corpus share
one is checked; if two do, all is counted again under another seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.llm import quotient, words
from watchfold.llm.graphs import most_frequent, stored
from watchfold.session import ship

#: Most words that get numbers and are sent to all tasks; below 2**21 - 1.
HEAD = 1 << 20
#: Marks of the bitmap that lets the other frequent words through (16 MB).
MARKS = 1 << 27
#: Entries that a shard has to hold at most if all phrases were different.
SHARD_ENTRIES = 1 << 20
#: Keys that a task holds before it sorts them, and distinct ones before it writes them out.
_HELD, _DISTINCT = 1 << 18, 1 << 19
#: Distinct words, and bytes of them, that a task holds before it writes them out.
_WORDS, _WORD_BYTES = 1 << 18, 16 << 20
#: Bytes of text that are worked on at once.
_PIECE = 1 << 18
#: Longer words are hashed one by one.
_LONG_WORD = 1024
#: Parts of a language whose best phrases are found side by side.
_PARTS = 64

BREAKS = words._table((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
BLANKS = words._table((0x20, 0x20), (0x09, 0x09))
_SEPARATORS = BREAKS | BLANKS

_WORD_ROWS = "key long, lang string, word string, n long"
_FILTER_ROWS = "wide boolean, shard int, filter binary"
_PHRASE_ROWS = "w1 long, w2 long, w3 long, a long, f1 long, f2 long, f3 long"


def segments(data: np.ndarray, low: int, high: int, size: int = _PIECE) -> Iterator[tuple[int, int, int]]:
    """Cuts a text at breaks, or at blanks: begin, end, and how many words are there again.

    A cut at a blank repeats the two words before it, so that each run of three words lies
    in one segment; what ends in a repeated word has been counted.
    """
    again, reach = 0, size
    while high - low > reach:
        window = data[low : low + reach]
        breaks = np.flatnonzero(BREAKS[window[1:]])
        if len(breaks):
            yield low, low + int(breaks[-1]) + 1, again
            low, again, reach = low + int(breaks[-1]) + 1, 0, size
            continue
        gap = BLANKS[window]
        starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        if gap[-1] and len(starts) > 3:
            yield low, low + reach, again
            low, again, reach = low + int(starts[-2]), 2, size
        elif len(starts) > 4:  # the last word may go on
            yield low, low + int(starts[-1]), again
            low, again, reach = low + int(starts[-3]), 2, size
        else:
            reach *= 2
    if high > low:
        yield low, high, again


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Folded bytes, borders, row numbers and repeated words of texts and parts of texts."""
    for piece in words.pieces(batch.column("text"), _PIECE):
        if len(piece.data) <= 2 * _PIECE:
            rows = np.arange(piece.first, piece.last)
            yield words.LOWER[piece.data], piece.offsets, rows, np.zeros(len(rows), np.int64)
        else:  # one long text
            for low, high, again in segments(piece.data, 0, len(piece.data)):
                part = words.LOWER[piece.data[low:high]]
                yield part, np.array([0, high - low]), np.array([piece.first]), np.array([again])


def _hashes(data: np.ndarray, found: words.Words) -> np.ndarray:
    long = np.flatnonzero(found.end - found.start > _LONG_WORD)
    if not len(long):
        return words.hash_words(data, found)
    out = np.empty(len(found.start), np.uint64)
    short = np.flatnonzero(found.end - found.start <= _LONG_WORD)
    parts = [data[found.start[i] : found.end[i]] for i in short]
    if parts:
        ends = np.cumsum([len(p) for p in parts])
        joined = words.Words(np.concatenate([[0], ends[:-1]]), ends, np.array([0, len(parts)]))
        out[short] = words.hash_words(np.concatenate(parts), joined)
    for i in long:
        out[i] = xxhash.xxh3_64_intdigest(data[found.start[i] : found.end[i]].tobytes())
    return out


def _keys(data: np.ndarray, found: words.Words, salts: np.ndarray) -> np.ndarray:
    """Key of each word: its hash with its row's language; never 0."""
    keys = quotient.scramble(_hashes(data, found) ^ np.repeat(salts, found.counts))
    return np.where(keys == 0, np.uint64(1), keys)


def _languages(batch: pa.RecordBatch, seed: int) -> tuple[list[str], np.ndarray]:
    """Language of each row, and what it adds to the keys."""
    langs = batch.column("lang").to_pylist()
    known = {x: xxhash.xxh3_64_intdigest(x.encode(), seed) for x in set(langs)}
    return langs, np.array([known[x] for x in langs], np.uint64)


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes between borders as binary values."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[at]))]
    return pa.Array.from_buffers(pa.binary(), len(size), buffers)


class _Vocabulary:
    """Counts of distinct words as columns: key, lang, word, n."""

    def __init__(self):
        self.fresh: list[pa.Table] = []
        self.held = 0
        self.whole: pa.Table | None = None

    def add(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        self.fresh.append(table)
        self.held += len(table)
        if self.held >= _WORDS // 2 or sum(x.nbytes for x in self.fresh) >= 2 * _WORD_BYTES:
            self._merge()
            if len(self.whole) >= _WORDS or self.whole.column("word").nbytes >= _WORD_BYTES:
                yield from self.flush()

    def _merge(self) -> None:
        table = pa.concat_tables([*([] if self.whole is None else [self.whole]), *self.fresh])
        self.fresh, self.held = [], 0
        keys = table.column("key").to_numpy()
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sums = np.add.reduceat(table.column("n").to_numpy()[order], first)
        table = table.take(pa.array(order[first]))
        self.whole = table.set_column(3, "n", pa.array(sums)).combine_chunks()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.fresh:
            self._merge()
        if self.whole is not None:
            word = self.whole.column("word").cast(pa.string())
            yield from self.whole.set_column(2, "word", word).to_batches()
        self.whole = None


def _word_counts(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Counts of the words of each language; a word may come several times."""
    known = _Vocabulary()
    for batch in batches:
        _, salts = _languages(batch, seed)
        for data, offsets, rows, again in _pieces(batch):
            found = words.split(data, offsets, _SEPARATORS)
            keys = _keys(data, found, salts[rows])
            row = found.row
            new = np.arange(len(keys)) - found.first[row] >= again[row]
            at = np.flatnonzero(new)
            if not len(at):
                continue
            distinct, first, number = np.unique(keys[at], return_index=True, return_counts=True)
            at = at[first]
            columns = [
                pa.array(words.signed(distinct)),
                batch.column("lang").take(pa.array(rows[row[at]])),
                _strings(data, found.start[at], found.end[at]),
                pa.array(number.astype(np.int64)),
            ]
            yield from known.add(pa.Table.from_arrays(columns, names=["key", "lang", "word", "n"]))
    yield from known.flush()


class _Head:
    """What all tasks know of the most frequent words, ordered by key."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, marks: np.ndarray | None):
        order = np.argsort(keys)
        self.keys, self.counts, self.marks = keys[order], counts[order], marks

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Numbers from 1 of the words among them, 0 for other words."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at + 1, 0)

    def others(self, keys: np.ndarray) -> np.ndarray:
        """Which words may be frequent though they have no number."""
        if self.marks is None:
            return np.zeros(len(keys), bool)
        place = (keys & np.uint64(MARKS - 1)).astype(np.int64)
        return (self.marks[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _phrase_keys(data: np.ndarray, offsets: np.ndarray, salts: np.ndarray, again: np.ndarray, head: _Head) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all runs of two and three words that may be frequent: packed, and wide ones."""
    found = words.split(data, offsets, _SEPARATORS)
    keys = _keys(data, found, salts)
    number = head.numbers(keys)
    may = (number > 0) | head.others(keys)
    row = found.row
    breaks = np.flatnonzero(BREAKS[data])
    region = np.searchsorted(breaks, found.start)
    last = np.arange(len(keys)) - found.first[row] >= again[row]
    joined = may[1:] & may[:-1] & (region[1:] == region[:-1]) & (row[1:] == row[:-1])
    packed, wide = [], []
    for size in (2, 3):
        runs = joined if size == 2 else joined[1:] & joined[:-1]
        at = np.flatnonzero(runs & last[size - 1 :]) if len(keys) >= size else np.empty(0, np.int64)
        each = [number[at + i] for i in range(size)] + [np.zeros(len(at), np.int64)] * (3 - size)
        small = np.logical_and.reduce([x > 0 for x in each[:size]])
        first, second, third = (x[small].astype(np.uint64) for x in each)
        packed.append(first << np.uint64(42) | second << np.uint64(21) | third)
        rest = at[~small]
        columns = [keys[rest + i] for i in range(size)] + [np.zeros(len(rest), np.uint64)] * (3 - size)
        wide.append(np.stack(columns, axis=1))
    return np.concatenate(packed)[:, None], np.concatenate(wide)


class _Counter:
    """Counts permuted keys; what it gives out are filters by shard."""

    def __init__(self, width: int, shard_bits: int):
        self.width, self.shard_bits = width, shard_bits
        self.fresh: list[np.ndarray] = []
        self.held = 0
        self.keys, self.counts = np.empty((0, width), np.uint64), np.empty(0, np.int64)

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys):
            self.fresh.append(quotient.permute(keys))
            self.held += len(keys)
        if self.held >= _HELD // self.width:
            self._merge()
            if len(self.keys) >= _DISTINCT // self.width:
                yield self.flush()

    def _merge(self) -> None:
        found = quotient.distinct(np.concatenate(self.fresh))
        self.fresh, self.held = [], 0
        self.keys, self.counts = quotient.counted(
            np.concatenate([self.keys, found[0]]), np.concatenate([self.counts, found[1]])
        )

    def flush(self) -> pa.RecordBatch:
        if self.fresh:
            self._merge()
        made = quotient.filters(self.keys, self.counts, self.shard_bits)
        self.keys, self.counts = self.keys[:0], self.counts[:0]
        return pa.record_batch(
            {
                "wide": pa.array([self.width > 1] * len(made), pa.bool_()),
                "shard": pa.array([s for s, _ in made], pa.int32()),
                "filter": pa.array([x for _, x in made], pa.binary()),
            }
        )


def _filters(batches: Iterator[pa.RecordBatch], seed: int, head: Broadcast, shard_bits: int) -> Iterator[pa.RecordBatch]:
    known = head.value
    counters = (_Counter(1, shard_bits), _Counter(3, shard_bits))
    for batch in batches:
        _, salts = _languages(batch, seed)
        for data, offsets, rows, again in _pieces(batch):
            for counter, keys in zip(counters, _phrase_keys(data, offsets, salts[rows], again, known), strict=True):
                yield from counter.add(keys)
    for counter in counters:
        yield counter.flush()


def _merged(table: pa.Table, head: Broadcast, least: int) -> pa.Table:
    """Phrases of a shard's filters that are frequent, and counts of their numbered words."""
    known = head.value
    wide, shard = table.column("wide")[0].as_py(), table.column("shard")[0].as_py()
    keys, counts = quotient.merge(table.column("filter").to_pylist(), shard)
    often = counts >= least
    keys, counts = quotient.unpermute(keys[often]), counts[often]
    if wide:
        each = [known.numbers(keys[:, i]) for i in range(3)]
        whole = [keys[:, i] for i in range(3)]
    else:
        each = [(keys[:, 0] >> np.uint64(s) & np.uint64((1 << 21) - 1)).astype(np.int64) for s in (42, 21, 0)]
        whole = [np.where(x > 0, known.keys[x - 1], np.uint64(0)) if len(known.keys) else x.astype(np.uint64) for x in each]
    columns = [pa.array(words.signed(x), mask=x == 0) for x in whole]
    columns.append(pa.array(counts))
    for x in each:
        n = known.counts[x - 1] if len(known.counts) else x
        columns.append(pa.array(n, pa.int64(), mask=x == 0))
    return pa.Table.from_arrays(columns, names=[x.split()[0] for x in _PHRASE_ROWS.split(", ")])


def _words(docs: DataFrame) -> tuple[DataFrame, int]:
    """Counts of all words, ``(key, lang, word, n)``, and the seed of their keys."""
    for seed in range(16):
        rows = docs.mapInArrow(partial(_word_counts, seed=seed), _WORD_ROWS)
        found = stored(rows.groupBy("key", "lang", "word").agg(F.sum("n").alias("n")), "words")
        if found.groupBy("key").count().filter("count > 1").isEmpty():
            return found, seed
    raise RuntimeError("words of this corpus share hashes under every seed")


def _marks(keys: DataFrame) -> np.ndarray:
    """A bitmap of the lowest bits of the keys."""
    place = F.col("key").bitwiseAND(MARKS - 1) + 1  # buckets hold 32,768 bits and count from 1
    rows = keys.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
    marks = np.zeros(MARKS // 8, np.uint8)
    for bucket, bits in rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).toLocalIterator():
        some = np.frombuffer(bits, np.uint8)
        marks[(bucket - 1) * 4096 : (bucket - 1) * 4096 + len(some)] = some
    return marks


def phrase_counts(docs: DataFrame, least: int, head: int = HEAD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of the phrases of two and three words that occur ``least`` times, of the words
    that do, and of all words by language.

    Phrases are ``(w1, w2, w3, a, f1, f2, f3)`` with keys of words and their counts, w3 and f3
    null for two words; words are ``(key, lang, word, n)``, languages ``(lang, n)``.
    """
    spark = docs.sparkSession
    ship(spark, "watchfold")
    docs = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    every, seed = _words(docs)
    languages = stored(every.groupBy("lang").agg(F.sum("n").alias("n")), "languages")
    often = stored(every.filter(F.col("n") >= least), "frequent")
    top = stored(most_frequent(often, head).select("key", "n"), "head")
    table = top.toArrow()
    rest = often.join(top.select("key"), "key", "left_anti")
    more = often.count() > len(table)
    keys = table.column("key").to_numpy().astype(np.int64).view(np.uint64)
    known = _Head(keys, table.column("n").to_numpy().astype(np.int64), _marks(rest) if more else None)
    sent = spark.sparkContext.broadcast(known)
    total = languages.agg(F.sum("n")).first()[0] or 0
    shard_bits = max(2 * total // SHARD_ENTRIES, 0).bit_length()
    filters = stored(docs.mapInArrow(partial(_filters, seed=seed, head=sent, shard_bits=shard_bits), _FILTER_ROWS), "filters")

    def merged(table: pa.Table) -> pa.Table:
        return _merged(table, sent, least)

    phrases = filters.groupBy("wide", "shard").applyInArrow(merged, _PHRASE_ROWS)
    phrases = stored(phrases, "phrases")
    if more:
        # words without a number meet their counts; they are none of the most frequent
        for i in (1, 2, 3):
            open_ = F.col(f"f{i}").isNull() & F.col(f"w{i}").isNotNull()
            met = phrases.filter(open_).drop(f"f{i}").join(rest.select(F.col("key").alias(f"w{i}"), F.col("n").alias(f"f{i}")), f"w{i}")
            phrases = phrases.filter(~open_).unionByName(met)
        phrases = stored(phrases, "phrases")
    return phrases, often, languages


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact up to counts of 14 digits."""
    a, left, right = (x.cast("decimal(14,0)") for x in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def collocations(docs: DataFrame, least: int = 10, inside: int = 50, most: int = 2000, head: int = HEAD) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: of each language of ``docs`` (text, lang)
    the ``most`` phrases of two or three words with the highest score.

    A phrase occurs ``a`` times, at least ``least``, within pieces between breaks; the cut
    that scores lowest (the first of several) gives the counts ``l`` and ``r`` of its parts.
    A phrase is left out if a longer one around it, itself left out or not, has ``inside``
    percent of its occurrences. Null text is empty, null lang is ``und``; an empty table or
    one without frequent phrases gives no rows. Equal rows count each. Ties of score and
    count are ordered by the phrase's bytes. Extra columns are not looked at.
    """
    phrases, often, languages = phrase_counts(docs, least, head)
    two, three = phrases.filter("w3 is null"), phrases.filter("w3 is not null")
    front = two.select("w1", "w2", F.col("a").alias("front"))
    back = two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("back"))
    both = three.join(front, ["w1", "w2"]).join(back, ["w2", "w3"])
    both = both.withColumn("_early", _score(F.col("a"), F.col("f1"), F.col("back")))
    both = both.withColumn("_late", _score(F.col("a"), F.col("front"), F.col("f3")))
    early = F.col("_early") <= F.col("_late")
    threes = both.select(
        "w1",
        "w2",
        "w3",
        "a",
        F.when(early, F.col("f1")).otherwise(F.col("front")).alias("l"),
        F.when(early, F.col("back")).otherwise(F.col("f3")).alias("r"),
        F.least("_early", "_late").alias("score"),
    )
    around = three.select("w1", "w2", "a").unionAll(three.select("w2", "w3", "a")).groupBy("w1", "w2").agg(F.max("a").alias("around"))
    alone = two.join(around, ["w1", "w2"], "left").filter(F.coalesce(100 * F.col("around") < inside * F.col("a"), F.lit(True)))
    twos = alone.select(
        "w1", "w2", "w3", "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score(F.col("a"), F.col("f1"), F.col("f2")).alias("score")
    )
    scored = twos.unionByName(threes)
    # a phrase's language is that of its words
    scored = scored.join(often.select(F.col("key").alias("w1"), "lang", F.col("word").alias("t1")), "w1")
    # the best of each part of a language, then of the language
    scored = scored.withColumn("_part", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(_PARTS)))
    for keys in (["lang", "_part"], ["lang"]):
        best = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"))
        scored = scored.withColumn("_rank", F.rank().over(best)).filter(F.col("_rank") <= most).drop("_rank")
    chosen = stored(scored.drop("_part"), "chosen")
    texts = often.select("key", "word")
    named = chosen.join(texts.select(F.col("key").alias("w2"), F.col("word").alias("t2")), "w2")
    named = named.join(texts.select(F.col("key").alias("w3"), F.col("word").alias("t3")), "w3", "left")
    named = named.withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3")).join(languages, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
