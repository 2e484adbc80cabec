"""Near-duplicate documents by HyperMinHash.

A document's set holds its distinct five-word shingles. Its sketch has 128 registers of
16 bits: shingles are dealt to registers by seven bits of their hash, and a register
keeps the smallest rest as number of leading zeros (6 bits) and the ten bits after the
first one. Four registers at a time form a band of 64 bits; documents with an equal band
are candidates.

1. Documents of equal sets become one class; its smallest doc_id stands for it.
2. Every class is compared with the smallest class of each of its buckets: first by the
   sketches (Jaccard estimate less the expected chance matches), then on full sets.
3. The other members of buckets that are not all connected by then are compared in
   blocks, pairs of blocks that belong to one component left out, and each pair only in
   the first band that it shares. What passes the sketch test is compared on full sets
   within the task, which returns a spanning forest of the true links.

So no group's pairs are written out, and no bucket is capped. Two documents at the
threshold itself share no band with a chance of 5e-6, and fail the sketch test with one
of 3e-5; closer ones hardly ever.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.llm import words
from watchfold.llm.graphs import components, fresh, marked, stored
from watchfold.session import ship

REGISTERS = 128
PER_BAND = 4
MANTISSA = 10
SHINGLE = 5
#: Sketch estimates may fall short of the threshold by so many standard deviations.
SLACK = 4.0
#: Marks of the bitmap that picks documents for the comparison of full sets (16 MB).
MARKS = 1 << 27
#: Members of a block in step 3.
BLOCK = 512

_REST = 64 - 7
_SKETCHED = "doc_id long, n_shingles long, set_a long, set_b long, sketch binary"


def registers(shingles: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Compressed registers of each row, 0 for an empty one."""
    least = np.full(rows * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, row * REGISTERS + (shingles & np.uint64(REGISTERS - 1)).astype(np.int64), shingles >> np.uint64(7))
    empty = least == np.iinfo(np.uint64).max
    rest = np.where(empty, 0, least) >> np.uint64(_REST - 53)  # 53 bits: exact as a float
    length = np.frexp(rest.astype(np.float64))[1]
    zeros = 53 - length
    after = (rest << np.minimum(zeros, 52).astype(np.uint64)) >> np.uint64(53 - 1 - MANTISSA)
    code = 1 + (zeros << MANTISSA) + (after & np.uint64((1 << MANTISSA) - 1)).astype(np.int64)
    return np.where(empty, 0, code).astype(np.uint16).reshape(rows, REGISTERS)


def sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each row (with repetitions) and the row borders among them."""
    found = words.split(data, offsets)
    return words.windows(words.hash_words(data, found), found.first, SHINGLE)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in words.pieces(batch.column("text")):
            rows = piece.last - piece.first
            shingles, first = sets(words.LOWER[piece.data], piece.offsets)
            distinct = [np.unique(shingles[first[i] : first[i + 1]]) for i in range(rows)]
            sizes = np.array([len(x) for x in distinct])
            flat = np.concatenate(distinct)
            row = np.repeat(np.arange(rows), sizes)
            set_a, set_b = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            np.add.at(set_a, row, words.mix(flat ^ np.uint64(0x243F6A8885A308D3)))
            np.add.at(set_b, row, words.mix(flat ^ np.uint64(0x13198A2E03707344)))
            sketch = registers(flat, row, rows)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").slice(piece.first, rows),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "set_a": pa.array(words.signed(set_a)),
                    "set_b": pa.array(words.signed(set_b)),
                    "sketch": pa.array([x.tobytes() for x in sketch], pa.binary()),
                }
            )


def _matrix(sketches: pa.Array) -> np.ndarray:
    """Registers of each row, from the column's bytes as they lie."""
    if isinstance(sketches, pa.ChunkedArray):
        sketches = sketches.combine_chunks()
    if not len(sketches):
        return np.empty((0, REGISTERS), np.uint16)
    borders = np.frombuffer(sketches.buffers()[1], np.int32)[sketches.offset : sketches.offset + len(sketches) + 1]
    data = np.frombuffer(sketches.buffers()[2], np.uint8)[borders[0] : borders[-1]]
    return data.view(np.uint16).reshape(len(sketches), REGISTERS)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and band that has a shingle: the bucket's key."""
    number = np.arange(REGISTERS // PER_BAND, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        band = _matrix(batch.column("sketch")).view(np.uint64)
        row, column = np.nonzero(band)
        node = batch.column("node").to_numpy()
        key = words.mix(band[row, column] + number[column])
        yield pa.record_batch(
            {
                "key": pa.array(words.signed(key)),
                "band": pa.array(column.astype(np.int32)),
                "node": pa.array(node[row]),
            }
        )


def chance_matches(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Expected number of registers in which two disjoint sets agree by chance."""
    a, b = np.maximum(size_a, 1) / REGISTERS, np.maximum(size_b, 1) / REGISTERS
    both, chance = a + b, 0.0
    for level in range(40):
        high, low = 2.0**-level, 2.0 ** -(level + 1)
        chance = chance + low * 2.0**-MANTISSA * a * b / both * (np.exp(-both * low) - np.exp(-both * high))
    return REGISTERS * chance


def estimate(equal: np.ndarray, used: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard estimate: equal registers over used ones, less the chance matches."""
    chance = np.minimum(chance_matches(size_a, size_b), np.maximum(used - 1, 0))
    return np.clip((equal - chance) / np.maximum(used - chance, 1e-9), 0.0, 1.0)


def _likely(equal, used, size_a, size_b, threshold: float) -> np.ndarray:
    """Whether a true similarity of ``threshold`` can explain the sketches."""
    spread = SLACK * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
    return estimate(equal, used, size_a, size_b) >= threshold - spread


def _likely_pairs(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = _matrix(batch.column("sketch_a")), _matrix(batch.column("sketch_b"))
        equal, used = ((a == b) & (a > 0)).sum(1), ((a > 0) | (b > 0)).sum(1)
        fits = _likely(equal, used, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), threshold)
        yield batch.select(["a", "b"]).filter(pa.array(fits))


def _full_sets(batches: Iterator[pa.RecordBatch], wanted: Broadcast) -> Iterator[pa.RecordBatch]:
    """Sets of the documents whose place is marked."""
    marks = wanted.value
    for batch in batches:
        place = batch.column("place").to_numpy()
        batch = batch.filter(pa.array((marks[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)))
        for piece in words.pieces(batch.column("text")):
            rows = piece.last - piece.first
            shingles, first = sets(words.LOWER[piece.data], piece.offsets)
            distinct = [np.unique(shingles[first[i] : first[i + 1]]) for i in range(rows)]
            sizes = np.array([len(x) for x in distinct])
            yield pa.record_batch(
                {
                    "node": batch.column("doc_id").slice(piece.first, rows),
                    "n": pa.array(sizes, pa.int64()),
                    "shingles": pa.array([x.tobytes() for x in distinct], pa.large_binary()),
                }
            )


def _linked(a: bytes, b: bytes, threshold: float) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if min(len(x), len(y)) < threshold * max(len(x), len(y)):
        return False
    at = np.searchsorted(y, x)
    shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * shared >= round(100 * threshold) * (len(x) + len(y) - shared)


def _true_pairs(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("shingles_a"), batch.column("shingles_b")
        keep = [_linked(a[i].as_buffer(), b[i].as_buffer(), threshold) for i in range(len(batch))]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


_BLOCK_KEY = ("key", "i", "j")
#: Block pairs of up to so many rows are compared together, row pair by row pair.
_SMALL = 24


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole block pairs, and the borders between these; rows come sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        keys = [batch.column(c).to_numpy() for c in _BLOCK_KEY]
        cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        before = held[-2] if len(held) > 1 else None
        if not len(cuts) and before is not None and all(before.column(c)[-1] == batch.column(c)[0] for c in _BLOCK_KEY):
            continue  # one block pair goes on: it has two blocks at most
        if len(cuts):
            last = int(cuts[-1])
            done = pa.Table.from_batches([*held[:-1], batch.slice(0, last)]).combine_chunks()
            held = [batch.slice(last)]
            yield done, _borders(done)
        elif before is not None:
            done = pa.Table.from_batches(held[:-1]).combine_chunks()
            held = [batch]
            yield done, _borders(done)
    if held:
        done = pa.Table.from_batches(held).combine_chunks()
        yield done, _borders(done)


def _borders(rows: pa.Table) -> np.ndarray:
    keys = [rows.column(c).to_numpy() for c in _BLOCK_KEY]
    cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
    return np.concatenate([[0], cuts, [len(rows)]])


def _candidates(rows: pa.Table, borders: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows in one block pair that may be linked, in the order of block pairs.

    The two lie in different components, their sketches fit, and this bucket's band is
    the first in which they agree, so that no pair is looked at in two buckets.
    """
    regs = _matrix(rows.column("sketch"))
    bands = regs.view(np.uint64)
    i, j, block, band, component, size = (
        rows.column(c).to_numpy() for c in ("i", "j", "block", "band", "component", "n_shingles")
    )

    def kept(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        fits = component[a] != component[b]
        same = (bands[a] == bands[b]) & (bands[a] != 0)
        fits &= same.argmax(1) == band[a]
        a, b = a[fits], b[fits]
        x, y = regs[a], regs[b]
        equal, used = ((x == y) & (x > 0)).sum(1), ((x | y) > 0).sum(1)
        fits[fits] = _likely(equal, used, size[a], size[b], threshold)
        return fits

    found: list[np.ndarray] = []
    sizes = np.diff(borders)
    for n in range(2, _SMALL + 1):
        start = borders[:-1][sizes == n]
        a, b = np.triu_indices(n, 1)
        for low in range(0, len(start), max(1, 20_000 // len(a))):
            some = start[low : low + max(1, 20_000 // len(a)), None]
            x, y = (some + a).ravel(), (some + b).ravel()
            # of two blocks, only rows of different ones are compared
            across = (i[x] == j[x]) | (block[x] != block[y])
            x, y = x[across], y[across]
            fits = kept(x, y)
            found.append(np.stack([x[fits], y[fits]]))
    for k in np.flatnonzero(sizes > _SMALL):
        each = np.arange(borders[k], borders[k + 1])
        one = i[each[0]] == j[each[0]]
        left = each if one else each[block[each] == i[each[0]]]
        right = each if one else each[block[each] != i[each[0]]]
        for a in left:
            b = right[right > a] if one else right
            b = b[component[b] != component[a]]
            if len(b):
                b = b[kept(np.full(len(b), a), b)]
                found.append(np.stack([np.full(len(b), a), b]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.concatenate(found, axis=1)
    pairs = pairs[:, np.lexsort((pairs[1], pairs[0]))]
    return pairs[0], pairs[1]


def _block_members(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """The rows of each block pair that have a candidate in it."""
    for rows, borders in _blocks(batches):
        a, b = _candidates(rows, borders, threshold)
        if len(a):
            yield from rows.take(pa.array(np.unique(np.concatenate([a, b])))).combine_chunks().to_batches()


def _block_links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the true links between components in each block pair."""
    for rows, borders in _blocks(batches):
        node, component = (rows.column(c).to_numpy() for c in ("node", "component"))
        full = rows.column("shingles").combine_chunks()
        linked_a, linked_b = [], []
        parent: dict[int, int] = {}
        now = -1

        def root(x: int, parent=parent) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        a, b = _candidates(rows, borders, threshold)
        for x, y, pair in zip(a, b, np.searchsorted(borders, a, side="right"), strict=True):
            if pair != now:
                parent.clear()
                now = pair
            rx, ry = root(component[x]), root(component[y])
            if rx != ry and _linked(full[x].as_buffer(), full[y].as_buffer(), threshold):
                parent[rx] = ry
                linked_a.append(node[x])
                linked_b.append(node[y])
        if linked_a:
            yield pa.record_batch({"a": pa.array(linked_a, pa.int64()), "b": pa.array(linked_b, pa.int64())})


def _sets_of(docs: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """``(node, n, shingles)`` of the nodes: their full sets, from the texts once more.

    Texts are not shuffled. A bitmap of fixed size marks the hashes of the nodes; what
    shares a mark by chance comes along and finds no partner later.
    """
    place = F.pmod(F.xxhash64(F.col("node")), F.lit(MARKS))
    marked = nodes.select((place + 1).alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
    marked = marked.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    marks = np.zeros(MARKS // 8, np.uint8)
    for bucket, bits in marked.toLocalIterator():  # buckets hold 32,768 marks and count from 1
        some = np.frombuffer(bits, np.uint8)
        marks[(bucket - 1) * 4096 : (bucket - 1) * 4096 + len(some)] = some
    wanted = docs.sparkSession.sparkContext.broadcast(marks)
    place = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(MARKS)).alias("place")
    texts = docs.filter("doc_id is not null").select("doc_id", "text", place)
    found = texts.mapInArrow(partial(_full_sets, wanted=wanted), "node long, n long, shingles binary")
    # of documents that share a doc_id, the one whose class it stands for
    return found.join(classes.select("node", F.col("n_shingles").alias("n")), ["node", "n"], "left_semi").dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, threshold: float = 0.75) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable over links, itself included, and
    ``kept`` holds where it is the document's own. Null and empty texts and texts without
    words have an empty set and link to nothing. A row without doc_id takes part in
    nothing, has no component_id and is kept. Equal rows get equal results; texts for
    which the same doc_id stands count as linked. Other columns are not looked at.
    """
    ship(docs.sparkSession, "watchfold")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = stored(docs.mapInArrow(_sketches, _SKETCHED), "sketches")
    equal = ["set_a", "set_b", "n_shingles"]
    classes = sketched.filter("n_shingles > 0 and doc_id is not null").groupBy(*equal).agg(
        F.min("doc_id").alias("node"), F.first("sketch").alias("sketch")
    )
    classes = stored(classes, "classes")

    rows = classes.select("node", "sketch").mapInArrow(_bands, "key long, band int, node long")
    shared = rows.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("last")).filter("center < last")
    buckets = stored(rows.join(shared.select("key", "center"), "key").filter("node <> center"), "buckets")

    # step 2: every class and the centres of its buckets
    pairs = buckets.select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    for side in "ab":
        own = classes.select(
            F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")
        )
        pairs = pairs.join(own, side)
    likely = stored(pairs.mapInArrow(partial(_likely_pairs, threshold=threshold), "a long, b long"), "pairs")
    ends = likely.select(F.col("a").alias("node")).union(likely.select("b"))
    full = stored(_sets_of(docs, ends, classes), "sets")
    pairs = likely
    for side in "ab":
        pairs = pairs.join(full.select(F.col("node").alias(side), F.col("shingles").alias(f"shingles_{side}")), side)
    links = stored(pairs.mapInArrow(partial(_true_pairs, threshold=threshold), "a long, b long"), "links")
    labels = components(links)

    # step 3: the others of a bucket, where they are of more than one component
    placed = buckets.join(labels, "node", "left").select(
        "key", "band", "node", F.coalesce("component", "node").alias("component")
    )
    whole = Window.partitionBy("key")
    placed = placed.withColumn("low", F.min("component").over(whole)).withColumn("high", F.max("component").over(whole))
    place = F.row_number().over(whole.orderBy("component", "node")) - 1
    placed = placed.filter("low < high").withColumn("block", F.floor(place / F.lit(BLOCK)).cast("int"))
    placed = stored(placed.drop("low", "high"), "blocks")
    span = placed.groupBy("key", "block").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    left = span.select("key", F.col("block").alias("i"), F.col("low").alias("low_i"), F.col("high").alias("high_i"))
    right = span.select("key", F.col("block").alias("j"), F.col("low").alias("low_j"), F.col("high").alias("high_j"))
    block_pairs = left.join(right, "key").filter(
        "i <= j and not (low_i = high_i and low_j = high_j and low_i = low_j)"
    ).select("key", "i", "j")
    sides = block_pairs.select("key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    laid = sides.join(placed, ["key", "block"]).join(classes, "node")
    laid = laid.select(*_BLOCK_KEY, "block", "band", "node", "component", "n_shingles", "sketch")
    order = [*_BLOCK_KEY, "node"]
    chosen = laid.repartition(*_BLOCK_KEY).sortWithinPartitions(*order)
    chosen = stored(chosen.mapInArrow(partial(_block_members, threshold=threshold), laid.schema), "blocks")
    if not chosen.isEmpty():
        full = _sets_of(docs, chosen.select("node"), classes)
        checked = chosen.join(full.select("node", "shingles"), "node").repartition(*_BLOCK_KEY).sortWithinPartitions(*order)
        more = checked.mapInArrow(partial(_block_links, threshold=threshold), "a long, b long")
        labels = components(links.unionByName(stored(more, "links")))

    found = sketched.drop("sketch").join(classes.drop("sketch"), equal, "left").join(labels, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"),
    )
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_near_duplicates(docs: DataFrame, threshold: float = 0.75) -> DataFrame:
    """``docs`` with one document of each component of :func:`near_duplicates`.

    That is the one whose doc_id names the component; of rows that share this doc_id one
    stays. Rows without doc_id and documents without words stay, too.
    """
    found = near_duplicates(docs, threshold).filter("doc_id is not null")
    ids = stored(found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "kept")
    # few rows go: those whose id has no mark stay without being shuffled
    id_, bucket, bits = F.col("doc_id"), fresh(docs.columns, "bucket"), fresh(docs.columns, "bits")
    place = F.pmod(F.xxhash64(id_.cast("long")), F.lit(MARKS)) + 1
    marks = ids.filter("not kept or n > 1").groupBy(F.bitmap_bucket_number(place).alias(bucket))
    marks = marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(bits))
    # MARKS / 32768 rows of 4096 bytes at most
    dealt = docs.withColumn(bucket, F.bitmap_bucket_number(place)).join(F.broadcast(marks), bucket, "left")
    mark = marked(F.col(bits), F.bitmap_bit_position(place))
    free = dealt.filter(id_.isNull() | ~mark)
    # the join puts equal ids together, so that dropping repeated ones moves nothing
    held = dealt.filter(id_.isNotNull() & mark).join(ids.filter("kept").select("doc_id"), "doc_id", "left_semi")
    return free.select(docs.columns).unionByName(held.dropDuplicates(["doc_id"]).select(docs.columns))
