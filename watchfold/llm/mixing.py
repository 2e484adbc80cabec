"""Mixing sources to target weights by a low-discrepancy schedule.

Each source is a stream of its documents in a shuffled order, cut into blocks of equally
many words. Slot i of the schedule belongs to the source into whose share of the unit
interval the i-th van der Corput point falls, and takes that source's next block; the
stream starts anew when it ends. A slot's rank among those of its source follows from
the digits of i, so that every slot is made by itself. Targets are met to the word: the
last block is cut, slots beyond a target are empty, and what the points leave open is
added at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from watchfold.llm.graphs import fresh, marked, stored
from watchfold.session import ship

BLOCK_WORDS = 1024
#: A document is taken at most so many times.
MOST_REPEATS = 3
#: Sources beyond this number are refused: their table goes to the driver and all tasks.
MOST_SOURCES = 1_000_000
_BITS = 52
#: Places of a bitmap that tells a document's copies, at most (16 MB), and for each document.
MARKS = 1 << 27
_PLACES = 16
#: Documents of a bucket of the shuffled order, on average.
_BUCKET_ROWS = 1 << 14


def n_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float]) -> list[float]:
    """Shares of the sum of ``sizes`` by weight, none above ``MOST_REPEATS`` times its
    source's size; the excess is shared by weight among the others."""
    size, weight = np.array(sizes, np.float64), np.array(weights, np.float64)
    target, capped = np.zeros(len(size)), np.zeros(len(size), bool)
    while not capped.all():
        rest = size.sum() - MOST_REPEATS * size[capped].sum()
        target = np.where(capped, MOST_REPEATS * size, weight * (rest / weight[~capped].sum()))
        above = ~capped & (target > MOST_REPEATS * size)
        if not above.any():
            break
        capped |= above
    return np.minimum(target, MOST_REPEATS * size).tolist()


def van_der_corput(i: np.ndarray) -> np.ndarray:
    """The points of base 2 as multiples of 2**-52: the bits of i in reverse."""
    point = np.zeros(len(i), np.int64)
    for k in range(_BITS):
        point |= ((i >> k) & 1) << (_BITS - 1 - k)
    return point


def points_below(n: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many of the first ``n`` points lie below ``x`` (a multiple of 2**-52).

    Even numbers fill the lower half of the interval and odd ones the upper half, each
    as the whole sequence fills the whole.
    """
    n, x = n.copy(), x.copy()
    count = np.zeros(len(n), np.int64)
    one = np.int64(1) << _BITS
    for _ in range(_BITS + 1):
        full = x >= one
        count[full] += n[full]
        n[full] = 0
        even, odd = (n + 1) >> 1, n >> 1
        upper = x >= one >> 1
        count += np.where(upper & ~full, even, 0)
        n = np.where(upper, odd, even)
        x = np.where(upper, 2 * x - one, 2 * x)
        n[full] = 0
    return count


@dataclass
class Schedule:
    """The sources' sizes and targets in whole words, and the slots that meet them."""

    size: np.ndarray
    target: np.ndarray
    block_words: int = BLOCK_WORDS

    def __post_init__(self):
        total = int(self.target.sum())
        share = np.concatenate([[0], np.cumsum(self.target)]) / max(total, 1)
        self.border = np.round(share * 2.0**_BITS).astype(np.int64)
        self.border[-1] = np.int64(1) << _BITS
        self.regular = -(-total // self.block_words)
        self.blocks = -(-self.size // self.block_words)
        whole = self.target // np.maximum(self.size, 1)
        rest = self.target - whole * self.size
        self.needed = whole * self.blocks + -(-rest // self.block_words)
        every = np.full(len(self.size), self.regular, np.int64)
        given = points_below(every, self.border[1:]) - points_below(every, self.border[:-1])
        self.given = given
        self.missing = np.concatenate([[0], np.cumsum(np.maximum(self.needed - given, 0))])
        self.slots = self.regular + int(self.missing[-1])

    def at(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Source, block and words taken of each slot."""
        source, rank = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        regular = slot < self.regular
        i = slot[regular]
        s = np.searchsorted(self.border, van_der_corput(i), side="right") - 1
        source[regular], rank[regular] = s, points_below(i, self.border[s + 1]) - points_below(i, self.border[s])
        extra = slot[~regular] - self.regular
        s = np.searchsorted(self.missing, extra, side="right") - 1
        source[~regular], rank[~regular] = s, self.given[s] + extra - self.missing[s]
        blocks, size = np.maximum(self.blocks[source], 1), self.size[source]
        epoch, block = rank // blocks, rank % blocks
        before = epoch * size + block * self.block_words
        length = np.minimum(self.block_words, size - block * self.block_words)
        return source, block, np.clip(self.target[source] - before, 0, length)


def _slots(batches: Iterator[pa.RecordBatch], schedule: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        source, block, take = schedule.value.at(batch.column("id").to_numpy())
        out = pa.record_batch({"number": pa.array(source), "block": pa.array(block), "take": pa.array(take)})
        yield out.filter(pa.array(take > 0))


def mix(docs: DataFrame) -> DataFrame:
    """``(doc_id, row_hash, source, size, source_size, target, taken)`` for every row of
    ``docs`` (doc_id, text, source).

    Sources stand in the order of their code points, null last, and weigh 1, 2, 3 and so
    on in turn. ``target`` is the source's share in words, ``taken`` the words that the
    mix takes of the row, repeats counted, at most three times its size. Texts without
    words have size 0 and are not taken. Equal rows are taken each for itself. The
    result depends on the rows alone, not on files or partitions.
    """
    spark = docs.sparkSession
    ship(spark, "watchfold")
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_hash(F.col("doc_id"), text).alias("row_hash"),
        F.col("source").cast("string").alias("source"),
        n_words(text).alias("size"),
    )
    rows = stored(rows, "sizes")
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    found = found.limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    size = [r["size"] for r in found]
    target = targets(size, [1 + k % 3 for k in range(len(found))])
    whole = np.minimum(np.floor(np.array(target) + 0.5).astype(np.int64), MOST_REPEATS * np.array(size, np.int64))
    schedule = Schedule(np.array(size, np.int64), whole, BLOCK_WORDS)

    known = T.StructType.fromDDL("number long, source string, source_size long, target double")
    sources = spark.createDataFrame(
        [(k, r["source"], r["size"], t) for k, (r, t) in enumerate(zip(found, target, strict=True))], known
    )
    named = rows.alias("r").join(sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
    named = named.select("r.*", "s.number", "s.source_size", "s.target")

    # where each document starts in its source's shuffled stream
    buckets = -(-sum(r["n"] for r in found) // _BUCKET_ROWS) or 1
    named = named.withColumn("bucket", F.pmod("row_hash", F.lit(buckets)))
    sums = named.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("number", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("begin"))
    within = Window.partitionBy("number", "bucket").orderBy("row_hash", "doc_id", "size")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    streamed = named.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    streamed = streamed.join(sums, ["number", "bucket"]).withColumn("begin", F.col("begin") + F.col("before"))
    streamed = stored(streamed.drop("bucket", "before"), "streams")

    sent = spark.sparkContext.broadcast(schedule)
    taken = spark.range(schedule.slots).mapInArrow(partial(_slots, schedule=sent), "number long, block long, take long")
    lengths = F.least(F.lit(BLOCK_WORDS), F.col("source_size") - F.col("block") * BLOCK_WORDS)
    uses = taken.groupBy("number", "block").agg(
        F.sum("take").alias("words"), F.count("*").alias("slots"), F.min("take").alias("least")
    )
    one = F.lit(1).cast("long")
    pieces = streamed.filter("size > 0").withColumn(
        "block",
        F.explode(F.sequence(F.expr(f"begin div {BLOCK_WORDS}"), F.expr(f"(begin + size - 1) div {BLOCK_WORDS}"))),
    )
    pieces = pieces.join(uses, ["number", "block"]).withColumn("length", lengths)
    # of a block's slots all but a cut one take it whole
    cut = F.when(F.col("least") < F.col("length"), F.col("least")).otherwise(F.lit(0).cast("long"))
    low = F.greatest(F.col("begin") - F.col("block") * BLOCK_WORDS, F.lit(0).cast("long"))
    high = F.least(F.col("begin") + F.col("size") - F.col("block") * BLOCK_WORDS, F.col("length"))
    words = (F.col("slots") - F.when(cut > 0, one).otherwise(0)) * (high - low)
    words = words + F.greatest(F.least(high, cut) - low, F.lit(0).cast("long"))
    sums = pieces.groupBy("number", "begin").agg(F.sum(words).alias("taken"))
    whole = streamed.filter("size > 0").join(sums, ["number", "begin"], "left")
    empty = streamed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    columns = ["doc_id", "row_hash", "source", "size", "source_size", "target", "taken"]
    whole = whole.withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
    return whole.select(columns).unionByName(empty.select(columns))


def row_hash(doc_id: Column, text: Column) -> Column:
    """The hash by which documents are shuffled."""
    return F.xxhash64(doc_id.cast("long"), text)


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix` takes it, to the nearest whole.

    Only the document that a target cuts off is rounded, one or two per source.
    """
    number = fresh(docs.columns, "copy")
    sure, held = _with_copies(docs, number)
    every = sure.unionByName(held).filter(F.col(number) > 0)
    return every.withColumn(number, F.explode(F.sequence(F.lit(1), F.col(number)))).drop(number)


def _with_copies(docs: DataFrame, number: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with the copies that the mix takes of each row as column ``number``, in two parts.

    There is a bitmap for each number of copies. Rows whose place is marked in one of them
    only have that number and are not shuffled; the others, few, meet the table of copies.
    """
    names = docs.columns
    copies = F.coalesce(F.round(F.sum("taken") / F.nullif(F.sum("size"), F.lit(0))), F.lit(0.0)).cast("int")
    taken = mix(docs).groupBy("doc_id", "row_hash").agg(copies.alias("copies"), F.count("*").alias("n"))
    taken = stored(taken, "taken")
    total = taken.agg(F.sum("n")).first()[0] or 0
    places = min(MARKS, 1 << max(15, (total * _PLACES).bit_length()))
    bucket, key = fresh([*names, number], "bucket"), fresh([*names, number], "key")
    bits = [fresh([*names, number], f"bits_{k}") for k in range(MOST_REPEATS + 1)]

    def place(of: str) -> Column:
        return F.pmod(F.col(of), F.lit(places)) + 1

    at = F.bitmap_bit_position(place("row_hash"))
    marks = taken.groupBy(F.bitmap_bucket_number(place("row_hash")).alias(bucket)).agg(
        *(F.bitmap_construct_agg(F.when(F.col("copies") == k, at)).alias(b) for k, b in enumerate(bits))
    )
    keyed = docs.withColumn(key, row_hash(F.col("doc_id"), F.col("text").cast("string")))
    dealt = keyed.withColumn(bucket, F.bitmap_bucket_number(place(key))).join(F.broadcast(marks), bucket, "left")
    at = F.bitmap_bit_position(place(key))
    found = F.array_compact(F.array(*(F.when(marked(F.col(b), at), k) for k, b in enumerate(bits))))
    dealt = dealt.withColumn(number, found).drop(bucket, *bits)
    sure = dealt.filter(F.size(number) == 1).withColumn(number, F.col(number)[0]).drop(key)
    held = dealt.filter(F.size(number) != 1).drop(number).alias("d").join(
        taken.alias("t"),
        F.col("d.doc_id").cast("long").eqNullSafe(F.col("t.doc_id")) & (F.col(f"d.{key}") == F.col("t.row_hash")),
    )
    return sure, held.select(*[F.col(f"d.`{n}`") for n in names], F.col("t.copies").alias(number))
