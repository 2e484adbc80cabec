"""Language-model scores by a hashed maximum-entropy model.

The probability of a word is that of its class in its context times that of the word in
its class. The class is predicted by a softmax over hashed features of the context: the
word before, the two words before, the word before the last (a skip), and the classes of
the last three words. The most frequent words and the end of a text are classes of their
own; all others fall into clusters by their last two bytes, and clusters are endings that
follow similar endings. Within a cluster words have their smoothed frequency.

The table of hashed features has a fixed size and is only where evidence starts from. The
classes that follow each single word and each pair of words in the training texts are
counted exactly, however many there are, and draw the probabilities of the table towards
what has followed the word before, and then the two words before. How much so many
occurrences weigh is chosen by all training tokens, each with its own occurrence left out.

Everything is gathered from all texts that may be learned from:

1. a survey: frequent words, and which endings follow which;
2. training: each task takes gradient steps over its texts in small batches, and the
   weights of a row are averaged over the tasks by how often each has used it; two rounds
   see one half of the texts each. The same pass counts the frequent words exactly, and
   what follows frequent words and pairs, which all tasks get;
3. base scores in sparse numpy batches. Words among the ``HEAD`` most frequent have their
   counts at hand. Occurrences of all others, which are none too frequent each, meet in
   one shuffle by word, where their counts arise, and come back as sums per document;
4. classes. All tokens go to one shuffle by the word or pair before them, as arrays per
   part of the contexts and chunk of documents. It is read three times: for what counts
   after single words weigh, for what those after pairs weigh, and for the sums per document
   that both then give. It is one of Python's pairs, which come back as they were packed: rows
   of a DataFrame would be packed anew by the JVM, byte by byte, each time. Tokens after
   frequent pairs have their counts at hand and are spread.

Words are known by 64-bit hashes, and contexts in that shuffle by parts of them.
"""

from __future__ import annotations

import contextlib
import gc
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, SparkContext, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchfold.llm import words
from watchfold.llm.graphs import most_frequent, stored
from watchfold.session import ship

#: Most words whose counts are sent to all tasks.
HEAD = 1 << 19
#: Rows of the weight table that features are hashed to: 16 bits.
CONTEXTS = 1 << 16
#: The end, the most frequent words, and clusters of endings.
SINGLES = 24
CLUSTERS = 40
CLASSES = SINGLES + CLUSTERS
ROUNDS = 2
#: Most words and pairs of words whose followers' classes are sent to all tasks.
HEAD_ONE = 1 << 13
HEAD_TWO = 1 << 15
#: Tokens that a task of the shuffle by contexts gets, on average.
PART_TOKENS = 1 << 20
#: Tokens of the documents that go to the shuffle together.
CHUNK_TOKENS = 1 << 20

_FEATURES = 4
_MINIBATCH = 4096
#: Rows of floats that are worked on at once, so that they stay in a core's cache.
_CACHED = 1024
_RATE = 1.0
_ENDINGS = 1 << 16
_SIGNS = 64
_HELD = 1 << 20
_HELD_PAIRS = 1 << 18
#: Least tokens of a training task: each sends the rows of the table that it has used.
_TASK_TOKENS = 1 << 23
_LEAST_TOKENS = 100
_STRENGTHS = np.append(2.0 ** np.arange(-3, 25), np.inf)
_SIZES = 40
_BLOCK_ROWS = 1024
_COUNT_BLOCK = 1 << 14
#: Logarithms of probabilities travel in steps of 1/2048, down to -32.
_LOG_STEPS = 2048
#: Tokens after frequent pairs that travel as one row.
_SPREAD = 1 << 16
#: Sums of logarithms are added up as whole numbers, in whatever order.
_GAIN_STEPS = 2.0**20
_END = np.uint64(0x5851F42D4C957F2D)
_BEGIN = np.uint64(0x14057B7EF767814F)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text is 1 modulo 5.

    So is a row without id.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(True))


class Index:
    """Positions of 64-bit keys in an array of distinct ones, by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.keys = keys
        left, at = np.arange(len(keys), dtype=np.int32), self._start(keys)
        self.probes = 1
        while len(left):
            free = self.slot[at] < 0
            self.slot[at[free]] = left[free]  # of several keys the last one stays
            lost = self.slot[at] != left
            left, at = left[lost], (at[lost] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _start(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 if it is not there."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys) or not len(keys):
            return out
        open_, at = np.arange(len(keys)), self._start(keys)
        for _ in range(self.probes):
            slot = self.slot[at]
            hit = (slot >= 0) & (self.keys[slot] == keys[open_])
            out[open_[hit]] = slot[hit]
            go = (slot >= 0) & ~hit
            if not go.any():
                break
            open_, at = open_[go], (at[go] + 1) & ((1 << self.bits) - 1)
        return out


@dataclass
class Vocabulary:
    """Frequent words with their classes, the cluster of each ending, and frequent pairs."""

    head: np.ndarray
    head_class: np.ndarray
    ending_class: np.ndarray
    pairs: np.ndarray

    def __post_init__(self):
        self.index = Index(self.head)
        self.pair_index = Index(self.pairs)

    def __reduce__(self) -> tuple:
        # every machine holds a copy on disk: indexes are built where they are needed
        classes = (x.astype(np.uint8) for x in (self.head_class, self.ending_class))
        return _vocabulary, (self.head, *classes, self.pairs)


def _vocabulary(head: np.ndarray, head_class: np.ndarray, ending_class: np.ndarray, pairs: np.ndarray) -> Vocabulary:
    return Vocabulary(head, head_class.astype(np.int64), ending_class.astype(np.int64), pairs)


@dataclass
class Tokens:
    """The tokens of a piece's rows, each row's words followed by the end."""

    key: np.ndarray
    head: np.ndarray  # place among the frequent words, -1 for others, -2 for the end
    cls: np.ndarray
    row: np.ndarray
    at: np.ndarray  # place in the row


def _endings(data: np.ndarray, found: words.Words) -> np.ndarray:
    """Code of the last two bytes of each word."""
    last = data[found.end - 1].astype(np.int64)
    before = np.where(found.end - found.start > 1, data[np.maximum(found.end - 2, 0)], 0).astype(np.int64)
    return before * 256 + last


def _with_ends(found: words.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the words among the tokens, and each token's key, row and place in the row."""
    rows, n = len(found.first) - 1, len(found.start)
    place = np.arange(n) + found.row  # one end per row before
    key = np.full(n + rows, _END)
    key[place] = hashes
    counts = found.counts + 1
    row = np.repeat(np.arange(rows), counts)
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    return place, key, row, np.arange(n + rows) - begin[row]


def tokens(data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> Tokens:
    found = words.split(data, offsets)
    hashes = words.hash_words(data, found)
    place, key, row, at = _with_ends(found, hashes)
    head, cls = np.full(len(key), -2, np.int32), np.zeros(len(key), np.int64)
    head[place] = known = vocabulary.index.find(hashes)
    cls[place] = np.where(
        known >= 0, vocabulary.head_class[known] if len(vocabulary.head) else 0, vocabulary.ending_class[_endings(data, found)]
    )
    return Tokens(key, head, cls, row, at)


def _before(values: np.ndarray, at: np.ndarray, back: int, begin) -> np.ndarray:
    out = np.full(len(values), begin, values.dtype)
    out[back:] = values[:-back] if back < len(values) else values[:0]
    return np.where(at >= back, out, begin)


def _pair_keys(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the word before each token and of the two words before it."""
    one = _before(key, at, 1, _BEGIN)
    return one, words.mix(words.mix(one) + _before(key, at, 2, _BEGIN))


@dataclass
class Contexts:
    """Keys of the word and of the two words before each token, and their places among the
    frequent ones, -1 for others. No pair is frequent whose second word is not."""

    one: np.ndarray
    two: np.ndarray
    one_place: np.ndarray
    two_place: np.ndarray


def contexts(t: Tokens, vocabulary: Vocabulary) -> Contexts:
    one, two = _pair_keys(t.key, t.at)
    place = _before(t.head, t.at, 1, -3)  # -3 where a text begins
    place = np.where(place == -3, 0, np.where((place >= 0) & (place < HEAD_ONE), place + 1, -1))
    return Contexts(one, two, place, np.where(place >= 0, vocabulary.pair_index.find(two), -1))


def _size(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), _SIZES - 1)


def blended(p: np.ndarray, n: np.ndarray, total: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """Probabilities ``p`` of classes after contexts that ``n`` of ``total`` times had the
    class: ``p`` weighs as many occurrences as the strength for such a total says."""
    weight = strength[_size(total)]
    some = (total > 0) & np.isfinite(weight)
    weight = np.where(some, weight, 1.0)
    return np.where(some, (n + weight * p) / (total + weight), p)


def gains(p: np.ndarray, n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """For each size of total and each strength the log likelihood of the tokens, and their
    number at the end: they are among their own counts and are left out of them."""
    n, total = n - 1, total - 1
    out = np.zeros((_SIZES, len(_STRENGTHS) + 1), np.int64)
    some = np.flatnonzero(total > 0)
    size = _size(total[some])
    for k in np.flatnonzero(np.bincount(size, minlength=_SIZES)):
        at = some[size == k]
        own, seen = p[at].astype(np.float32), n[at].astype(np.float32)
        totals, times = np.unique(total[at], return_counts=True)
        for j, a in enumerate(_STRENGTHS):
            if np.isfinite(a):
                gain = np.log(seen + np.float32(a) * own).sum(dtype=np.float64) - times @ np.log(totals + a)
            else:
                gain = np.log(own).sum(dtype=np.float64)
            out[k, j] = np.rint(gain * _GAIN_STEPS)
        out[k, -1] = len(at)
    return out


def strengths(gain: np.ndarray) -> np.ndarray:
    """The best strength for each size of total. Sizes that few tokens have take that of the
    next smaller."""
    out, last = np.full(_SIZES, np.inf), None
    for k in range(_SIZES):
        if gain[k, -1] >= _LEAST_TOKENS:
            best = _STRENGTHS[int(np.argmax(gain[k, :-1]))]
            if last is None:
                out[:k] = best
            last = best
        if last is not None:
            out[k] = last
    return out


def features(t: Tokens) -> np.ndarray:
    """Rows of the weight table for each token's context."""
    if not len(t.key):
        return np.empty((_FEATURES, 0), np.uint16)
    one, two = _before(t.key, t.at, 1, _BEGIN), _before(t.key, t.at, 2, _BEGIN)
    classes = np.zeros(len(t.key), np.uint64)
    for back in (1, 2, 3):
        classes = classes * np.uint64(CLASSES + 1) + _before(t.cls + 1, t.at, back, 0).astype(np.uint64)
    salts = words.mix(np.arange(1, _FEATURES + 1, dtype=np.uint64))
    values = (one, words.mix(one) + two, two, classes)
    return np.stack([(words.mix(v + s) >> np.uint64(48)).astype(np.uint16) for v, s in zip(values, salts, strict=True)])


_ONES = np.ones((CLASSES, 1), np.float32)


def _logits(weight: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Unscaled log probabilities of the classes, the largest of each token 0."""
    z = weight.take(rows[0], axis=0)
    for some in rows[1:]:
        z += weight.take(some, axis=0)
    z += bias
    # the maximum by its place, which numpy finds faster than the maximum
    z -= z.reshape(-1).take(z.argmax(1) + np.arange(len(z)) * CLASSES)[:, None]
    return z


def class_log_probabilities(weight: np.ndarray, bias: np.ndarray, rows: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Log (base e) of the probability of each token's class, given its feature rows."""
    out = np.empty(len(cls), np.float64)
    for low in range(0, len(cls), _CACHED):
        some = slice(low, low + _CACHED)
        z = _logits(weight, bias, rows[:, some])
        chosen = z.reshape(-1).take(cls[some] + np.arange(len(z)) * CLASSES)
        out[some] = chosen.astype(np.float64) - np.log((np.exp(z, out=z) @ _ONES)[:, 0].astype(np.float64))
    return out


def _row_sums(values: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, how often they occur, and the sums of their rows of ``values``.

    Most keys of a batch occur once. Those that occur more often are lined up by how often,
    and their first eight rows are added place by place; only keys beyond that are summed
    one by one.
    """
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    times = np.diff(np.concatenate([first, [len(ordered)]]))
    sums = values.take(order[first], axis=0)
    many = np.flatnonzero(times > 1)
    many = many[np.argsort(-times[many], kind="stable")]
    begin, n = first[many], times[many]
    more = sums.take(many, axis=0)
    for place in range(1, min(8, int(times.max()))):
        some = np.count_nonzero(n > place)
        more[:some] += values.take(order[begin[:some] + place], axis=0)
    for k in range(np.count_nonzero(n > 8)):
        more[k] += np.add.reduce(values.take(order[begin[k] + 8 : begin[k] + n[k]], axis=0), axis=0)
    sums[many] = more
    return ordered[first].astype(np.int64), times, sums


class Learner:
    """Gradient steps over one task's texts; a row's steps shrink with its use."""

    def __init__(self, weight: np.ndarray, bias: np.ndarray):
        self.weight, self.bias = weight.copy(), bias.copy()
        self.used = np.zeros(CONTEXTS, np.float32)
        self.steps = 0

    def step(self, rows: np.ndarray, cls: np.ndarray) -> None:
        p = np.empty((len(cls), CLASSES), np.float32)
        for low in range(0, len(cls), _CACHED):
            some = slice(low, low + _CACHED)
            z = _logits(self.weight, self.bias, rows[:, some])
            np.exp(z, out=z)
            np.divide(z, z @ _ONES, out=p[some])
        p.reshape(-1)[cls + np.arange(len(cls)) * CLASSES] -= 1  # the gradient per token
        self.steps += 1
        self.bias -= 0.1 * _RATE * p.mean(0) / np.float32(np.sqrt(self.steps))
        for some in rows:
            used, times, slope = _row_sums(p, some)
            self.used[used] += times
            rate = (_RATE / np.sqrt(self.used[used] * times)).astype(np.float32)[:, None]
            for low in range(0, len(used), _CACHED):
                own = slice(low, low + _CACHED)
                slope[own] *= rate[own]
                moved = self.weight.take(used[own], axis=0)
                moved -= slope[own]
                self.weight[used[own]] = moved


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[words.Piece, np.ndarray]]:
    for piece in words.pieces(batch.column("text")):
        yield piece, words.LOWER[piece.data]


_SURVEY = "kind string, key long, code int, n long, signs binary"


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequent words and pairs, and for each ending how often endings (hashed) stand before it."""
    keys, codes, counts = (np.empty(0, t) for t in (np.uint64, np.int64, np.int64))
    pairs, pair_counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    signs = np.zeros(_ENDINGS * _SIGNS, np.int64)
    total = documents = 0
    for batch in batches:
        documents += len(batch)
        for piece, data in _pieces(batch):
            found = words.split(data, piece.offsets)
            hashes, code = words.hash_words(data, found), _endings(data, found)
            total += len(hashes)
            if len(hashes) > 1:
                same = found.row[1:] == found.row[:-1]
                sign = (words.mix(code[:-1].astype(np.uint64)) & np.uint64(_SIGNS - 1)).astype(np.int64)
                np.add.at(signs, (code[1:] * _SIGNS + sign)[same], 1)
            some, at, n = _distinct(hashes)
            keys, codes = np.concatenate([keys, some]), np.concatenate([codes, code[at]])
            counts = np.concatenate([counts, n])
            if len(keys) > 2 * _HELD:
                keys, codes, counts = _trimmed(keys, codes, counts)
            _, key, _, at = _with_ends(found, hashes)
            some, n = np.unique(_pair_keys(key, at)[1], return_counts=True) if len(key) else (pairs[:0], counts[:0])
            pairs, pair_counts = np.concatenate([pairs, some]), np.concatenate([pair_counts, n])
            if len(pairs) > 2 * _HELD_PAIRS:
                pairs, _, pair_counts = _trimmed(pairs, pair_counts, pair_counts, _HELD_PAIRS)
    keys, codes, counts = _summed(keys, codes, counts)
    pairs, _, pair_counts = _summed(pairs, pair_counts, pair_counts)
    # what is rarer in every task is not among the frequent ones, or just so
    often = counts >= max(2, total // (4 * HEAD))
    often_pair = pair_counts >= max(2, total // (4 * HEAD_TWO))
    pairs, pair_counts = pairs[often_pair], pair_counts[often_pair]
    yield pa.record_batch(
        {
            "kind": pa.array(["pair"] * len(pairs), pa.string()),
            "key": pa.array(words.signed(pairs)),
            "code": pa.nulls(len(pairs), pa.int32()),
            "n": pa.array(pair_counts),
            "signs": pa.nulls(len(pairs), pa.binary()),
        }
    )
    signs = signs.reshape(_ENDINGS, _SIGNS)
    seen = np.flatnonzero(signs.any(1))
    n, m = int(often.sum()), len(seen)
    yield pa.record_batch(
        {
            "kind": pa.array(["words", "documents"] + ["word"] * n + ["ending"] * m),
            "key": pa.array(np.concatenate([[0, 0], words.signed(keys[often]), np.zeros(m, np.int64)]).astype(np.int64)),
            "code": pa.array(np.concatenate([[0, 0], codes[often], seen]).astype(np.int32)),
            "n": pa.array(np.concatenate([[total, documents], counts[often], np.zeros(m, np.int64)]).astype(np.int64)),
            "signs": pa.array([None] * (2 + n) + [signs[x].tobytes() for x in seen], pa.binary()),
        }
    )


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, a place of each, and how often they occur."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(keys)])
    return ordered[first], order[first], np.diff(first, append=len(keys))


def _summed(keys: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    some, at, place = np.unique(keys, return_index=True, return_inverse=True)
    return some, codes[at], np.bincount(place, counts, len(some)).astype(np.int64)


def _trimmed(keys: np.ndarray, codes: np.ndarray, counts: np.ndarray, most: int = _HELD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, without the rarest of too many keys: they can't be among the frequent ones."""
    keys, codes, counts = _summed(keys, codes, counts)
    if len(keys) > most:
        floor = np.partition(counts, len(counts) - most)[len(counts) - most]
        keep = counts >= max(floor, 2)
        keys, codes, counts = keys[keep], codes[keep], counts[keep]
    return keys, codes, counts


def _clusters(code: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Cluster of each ending by k-means over the square roots of what stands before it."""
    out = SINGLES + (words.mix(np.arange(_ENDINGS, dtype=np.uint64)) % np.uint64(CLUSTERS)).astype(np.int64)
    size = signs.sum(1).astype(np.float64)
    if len(code) < CLUSTERS:
        return out
    point = np.sqrt(signs / np.maximum(size, 1)[:, None])
    rng = np.random.default_rng(11)
    center = point[np.argmax(size)][None]
    for _ in range(CLUSTERS - 1):
        gap = np.clip(1 - (point @ center.T).max(1), 1e-9, None) * size
        center = np.vstack([center, point[rng.choice(len(point), p=gap / gap.sum())]])
    for _ in range(20):
        nearest = (point @ center.T).argmax(1)
        total = np.zeros_like(center)
        np.add.at(total, nearest, point * size[:, None])
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        center = np.where(norm > 0, total / np.maximum(norm, 1e-12), center)
    out[code] = SINGLES + (point @ center.T).argmax(1)
    return out


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _doubles(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float64)


def _used_weights(data: bytes) -> np.ndarray:
    """Weights times their use, and the use, of a block of rows."""
    used = np.frombuffer(data[: 4 * _BLOCK_ROWS], np.float32).astype(np.float64)
    out = np.zeros((_BLOCK_ROWS, CLASSES + 1))
    out[:, -1] = used
    some = used > 0
    out[some, :-1] = np.frombuffer(data[4 * _BLOCK_ROWS :], np.float32).reshape(-1, CLASSES) * used[some, None]
    return out.ravel()


def _packed(weight: np.ndarray, used: np.ndarray) -> bytes:
    """A block of rows as bytes: how often each was used, and the weights of the used ones."""
    return used.astype(np.float32).tobytes() + weight[used > 0].astype(np.float32).tobytes()


#: How each kind of array is read where it arises, and once it is a sum.
_FIRST = {
    "weights": _used_weights, "bias": _doubles, "counts": _longs, "classes": _longs, "ending": _longs, "one": _longs, "two": _longs
}
_SUMS = _FIRST | {"weights": _doubles}


def _add(batches: Iterator[pa.RecordBatch], decode: dict) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        kinds, keys = batch.column("kind").to_pylist(), batch.column("key").to_pylist()
        for kind, key, data in zip(kinds, keys, batch.column("data"), strict=True):
            value = decode[kind](data.as_py())
            sums[kind, key] = sums[kind, key] + value if (kind, key) in sums else value
    for (kind, key), value in sums.items():
        yield pa.record_batch(
            {"kind": pa.array([kind]), "key": pa.array([key], pa.int64()), "data": pa.array([value.tobytes()], pa.binary())}
        )


def _total(rows: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """Sums of the arrays (data) of equal (kind, key): of 64 tasks each, and then of all.

    There are as many keys as the tables of the model have blocks, whatever the input.
    """
    schema = "kind string, key long, data binary"
    part = F.floor(F.spark_partition_id() / F.lit(64))
    parts = rows.withColumn("part", part).repartition("kind", "key", "part").drop("part")
    sums = parts.mapInArrow(partial(_add, decode=_FIRST), schema).repartition("kind", "key")
    table = sums.mapInArrow(partial(_add, decode=_SUMS), schema).toArrow()
    kinds, keys, data = (table.column(i).to_pylist() for i in range(3))
    return {(k, n): _SUMS[k](d) for k, n, d in zip(kinds, keys, data, strict=True)}


def survey(texts: DataFrame) -> tuple[Vocabulary, np.ndarray, int, int]:
    """The vocabulary of ``texts`` (text), the classes' approximate sizes, and the numbers
    of words and of texts."""
    rows = stored(texts.select("text").mapInArrow(_survey, _SURVEY), "survey")
    sums = {r[0]: r[1] for r in rows.filter("kind in ('words', 'documents')").groupBy("kind").agg(F.sum("n")).collect()}
    total, documents = sums.get("words") or 0, sums.get("documents") or 0
    counts = stored(rows.filter("kind = 'word'").groupBy("key", "code").agg(F.sum("n").alias("n")), "words")
    table = most_frequent(counts, HEAD).toArrow()  # at most HEAD rows
    head = table.column("key").to_numpy().view(np.uint64)
    code, n = table.column("code").to_numpy().astype(np.int64), table.column("n").to_numpy()
    order = np.lexsort((head, -n))
    head, code, n = head[order], code[order], n[order]
    ends = rows.filter("kind = 'ending'").select("kind", F.col("code").cast("long").alias("key"), F.col("signs").alias("data"))
    ends = _total(ends)  # at most 65,536 rows
    endings = np.array([code for _, code in ends], np.int64)
    signs = np.array(list(ends.values()), np.int64).reshape(-1, _SIGNS)
    by_code = np.argsort(endings)
    ending_class = _clusters(endings[by_code], signs[by_code])
    head_class = ending_class[code]
    singles = min(SINGLES - 1, len(head))
    head_class[:singles] = 1 + np.arange(singles)
    size = np.zeros(CLASSES)
    np.add.at(size, ending_class[endings], signs.sum(1))
    np.add.at(size, ending_class[code[:singles]], -n[:singles])
    size[0], size[1 : 1 + singles] = documents, n[:singles]
    pairs = stored(rows.filter("kind = 'pair'").groupBy("key").agg(F.sum("n").alias("n")), "pairs")
    pairs = most_frequent(pairs, HEAD_TWO).toArrow().column("key").to_numpy().view(np.uint64)  # at most HEAD_TWO rows
    return Vocabulary(head, head_class, ending_class, np.sort(pairs)), np.maximum(size, 1), total, documents


def _trained(
    batches: Iterator[pa.RecordBatch], vocabulary: Broadcast, model: Broadcast
) -> Iterator[pa.RecordBatch]:
    """The task's weights times their use, and its counts of frequent words and classes, and
    of classes after frequent words and pairs."""
    weight, bias = model.value
    known = vocabulary.value
    learner = Learner(weight, bias)
    counts = np.zeros(len(known.head), np.int64)
    classes = np.zeros(CLASSES, np.int64)
    after = {"one": np.zeros((HEAD_ONE + 1) * CLASSES, np.int64), "two": np.zeros(len(known.pairs) * CLASSES, np.int64)}
    seen = 0
    for batch in batches:
        for piece, data in _pieces(batch):
            t = tokens(data, piece.offsets, known)
            counts += np.bincount(t.head[t.head >= 0], minlength=len(counts))
            classes += np.bincount(t.cls, minlength=CLASSES)
            c = contexts(t, known)
            for sums, place in zip(after.values(), (c.one_place, c.two_place), strict=True):
                np.add.at(sums, (place * CLASSES + t.cls)[place >= 0], 1)
            rows = features(t)
            for low in range(0, len(t.cls), _MINIBATCH):
                learner.step(rows[:, low : low + _MINIBATCH], t.cls[low : low + _MINIBATCH])
            seen += len(t.cls)
    if not seen:
        return
    out: list[tuple[str, int, bytes]] = [
        ("bias", 0, np.concatenate([learner.bias * seen, [seen]]).astype(np.float64).tobytes()),
        ("classes", 0, classes.tobytes()),
    ]
    for kind, sums in ({"counts": counts} | after).items():
        for low in range(0, len(sums), _COUNT_BLOCK):
            if sums[low : low + _COUNT_BLOCK].any():
                out.append((kind, low, sums[low : low + _COUNT_BLOCK].tobytes()))
    for low in range(0, CONTEXTS, _BLOCK_ROWS):
        some = slice(low, low + _BLOCK_ROWS)
        out.append(("weights", low, _packed(learner.weight[some], learner.used[some])))
    for low in range(0, len(out), 32):
        kinds, keys, data = zip(*out[low : low + 32], strict=True)
        yield pa.record_batch({"kind": pa.array(kinds), "key": pa.array(keys, pa.int64()), "data": pa.array(data, pa.binary())})


@dataclass
class Evidence:
    """Counts of the classes after frequent words (the first row: after a text's begin) and
    pairs."""

    one: np.ndarray
    two: np.ndarray

    def __post_init__(self):
        self.one_total, self.two_total = self.one.sum(1), self.two.sum(1)

    def __reduce__(self) -> tuple:
        counts = (self.one, self.two)
        small = all(x.max(initial=0) < 1 << 31 for x in counts)
        return _evidence, tuple(x.astype(np.int32) if small else x for x in counts)


def _evidence(one: np.ndarray, two: np.ndarray) -> Evidence:
    return Evidence(one.astype(np.int64), two.astype(np.int64))


def _run_counts(run: np.ndarray, cls: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token, how many counted ones of its run have its class, and how many there are."""
    total = np.bincount(run, counted)[run]
    code = run * CLASSES + cls
    place = _runs(code) if (code[1:] >= code[:-1]).all() else np.unique(code, return_inverse=True)[1]
    return np.bincount(place, counted)[place], total


@dataclass
class Model:
    """What scoring needs: the vocabulary, weights, and exact counts of the training texts."""

    vocabulary: Vocabulary
    weight: np.ndarray
    bias: np.ndarray
    evidence: Evidence | None
    head_counts: np.ndarray
    class_counts: np.ndarray
    n_texts: int

    @property
    def n_tokens(self) -> int:
        return int(self.class_counts.sum())


def _release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of tables that are not in use any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fit(texts: DataFrame) -> Model:
    """A model of ``texts`` (text); every one of them is learned from."""
    spark = texts.sparkSession
    ship(spark, "watchfold")
    texts = texts.select(F.col("text").cast("string").alias("text"))
    vocabulary, sizes, total, documents = survey(texts)
    sent = spark.sparkContext.broadcast(vocabulary)
    parts = texts.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(ROUNDS)).cast("int"))
    parts = parts.coalesce(max(spark.sparkContext.defaultParallelism, total // _TASK_TOKENS))
    weight = np.zeros((CONTEXTS, CLASSES), np.float32)
    bias = np.log(sizes / sizes.sum()).astype(np.float32)
    head, classes = np.zeros(len(vocabulary.head), np.int64), np.zeros(CLASSES, np.int64)
    after = {"one": np.zeros((HEAD_ONE + 1) * CLASSES, np.int64), "two": np.zeros(len(vocabulary.pairs) * CLASSES, np.int64)}
    for part in range(ROUNDS):
        now = spark.sparkContext.broadcast((weight, bias))
        step = partial(_trained, vocabulary=sent, model=now)
        half = parts.filter(F.col("part") == part).select("text")
        for (kind, low), some in _total(half.mapInArrow(step, "kind string, key long, data binary")).items():
            if kind == "weights":
                block = some.reshape(_BLOCK_ROWS, CLASSES + 1)
                used = block[:, -1] > 0
                weight[np.flatnonzero(used) + low] = block[used, :-1] / block[used, -1:]
            elif kind == "counts":
                head[low : low + len(some)] += some
            elif kind == "classes":
                classes += some
            elif kind in after:
                after[kind][low : low + len(some)] += some
            else:
                bias = (some[:-1] / some[-1]).astype(np.float32)
        now.destroy()
        _release(spark)
    sent.destroy()
    evidence = Evidence(*(sums.reshape(-1, CLASSES) for sums in after.values()))
    return Model(vocabulary, weight, bias, evidence, head, classes, documents)


_SCORED = (
    "doc_id long, text_hash long, learn boolean, n_tokens long, n_known long, "
    "base_sum double, inner_sum double, clusters binary, word long, n long, cls int"
)


def _text_hashes(column: pa.Array) -> np.ndarray:
    data = pc.fill_null(column.cast(pa.large_binary()), b"")
    return np.array([xxhash.xxh3_64_intdigest(x.as_py()) for x in data], np.uint64)


def _scored(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    """A row per text with the sums over its frequent words, and a row for each of its
    other distinct words."""
    known: Model = model.value
    log_head = np.log10(np.append(known.head_counts, [known.n_texts, 0]) + 0.5)  # at -2 the end, at -1 nothing
    log_head[-1] = 0.0
    for batch in batches:
        hashes = words.signed(_text_hashes(batch.column("text")))
        for piece, data in _pieces(batch):
            rows = piece.last - piece.first
            t = tokens(data, piece.offsets, known.vocabulary)
            inner = t.cls >= SINGLES
            logs = log_head[t.head]
            clusters = np.bincount(t.row[inner] * CLUSTERS + t.cls[inner] - SINGLES, minlength=rows * CLUSTERS)
            clusters = clusters.reshape(rows, CLUSTERS).astype(np.int32)
            ids = batch.column("doc_id").slice(piece.first, rows)
            learn = batch.column("learn").slice(piece.first, rows)
            own = pa.array(hashes[piece.first : piece.last])
            yield _record(
                doc_id=ids,
                text_hash=own,
                learn=learn,
                n_tokens=pa.array(np.bincount(t.row, minlength=rows)),
                n_known=pa.array(np.bincount(t.row[_counted(t, known)], minlength=rows)),
                base_sum=pa.array(np.bincount(t.row, logs, rows)),
                inner_sum=pa.array(np.bincount(t.row, np.where(inner, logs, 0), rows)),
                clusters=pa.array([x.tobytes() for x in clusters], pa.binary()),
            )
            rare = np.flatnonzero(t.head == -1)
            order = rare[np.lexsort((t.key[rare], t.row[rare]))]
            row, key = t.row[order], t.key[order]
            first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])])[: len(row)])
            n = np.diff(np.concatenate([first, [len(row)]]))
            for low in range(0, len(first), 50_000):
                some = first[low : low + 50_000]
                place = pa.array(row[some])
                yield _record(
                    doc_id=ids.take(place),
                    text_hash=own.take(place),
                    learn=learn.take(place),
                    word=pa.array(words.signed(key[some])),
                    n=pa.array(n[low : low + 50_000]),
                    cls=pa.array(t.cls[order[some]], pa.int32()),
                )


def _counted(t: Tokens, known: Model) -> np.ndarray:
    """Frequent tokens that the training texts have."""
    counts = np.append(known.head_counts, [known.n_texts, 0])
    return counts[t.head] > 0


_KINDS = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "int": pa.int32()}


def _record(**columns: pa.Array) -> pa.RecordBatch:
    """A batch of the scored schema; columns that are not given are null."""
    size = len(next(iter(columns.values())))
    arrays, names = [], []
    for part in _SCORED.split(", "):
        name, kind = part.split()
        arrays.append(columns[name].cast(_KINDS[kind]) if name in columns else pa.nulls(size, _KINDS[kind]))
        names.append(name)
    return pa.record_batch(arrays, names=names)


#: Types of the keys and of what is beside them, by kind.
_WIDTHS = ((np.int64, np.uint32), (np.int64, np.uint16), (np.uint32, np.uint16))
_BATCH_BYTES = 1 << 24
_BATCH_ROWS = 10_000


class _Packed(NamedTuple):
    """Tokens of a chunk that go to a part, or the chunk's documents."""

    part: int
    chunk: int
    kind: int
    place: int
    n: int
    docs: bytes
    logs: bytes
    keys: bytes | None
    others: bytes | None


def _deltas(numbers: np.ndarray) -> bytes:
    """Ascending numbers as bytes, each but the first by its distance to the one before."""
    gaps = np.diff(numbers, prepend=0)
    most = gaps.max(initial=0)
    return gaps.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32).tobytes()


def _numbers(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, f"u{len(data) // n}"), dtype=np.int64) if n else np.empty(0, np.int64)


class _Chunk:
    """Documents whose tokens go to the shuffle together, as arrays per part and kind.

    A token is its document, the logarithm, and a key of context, class and whether it is
    learned from. The context is the word's hash (57 bits), beside which 32 bits of the
    pair's travel, for tokens after rare words (kind 0), the word's place and 42 bits of the
    pair's hash after other rare pairs (1), and the pair's place, beside which the word's
    travels, after frequent pairs (2). The documents are rows of kind 3.
    """

    def __init__(self):
        self.rows = self.size = 0
        self.docs: list[tuple] = []
        self.tokens: list[tuple] = []

    def add(self, ids: pa.Array, hashes: np.ndarray, learn: np.ndarray, t: Tokens, c: Contexts, logs: np.ndarray) -> None:
        self.docs.append((pc.fill_null(ids, 0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), hashes, learn))
        steps = np.minimum(np.rint(-_LOG_STEPS * logs), 0xFFFF).astype(np.uint16)
        kind = np.where(c.one_place < 0, 0, np.where(c.two_place < 0, 1, 2)).astype(np.uint8)
        one_place, two_place = c.one_place.astype(np.uint64), c.two_place.astype(np.uint64)
        after_word = one_place << np.uint64(42) | c.two >> np.uint64(22)
        context = np.where(kind == 0, c.one >> np.uint64(7), np.where(kind == 1, after_word, two_place))
        key = context << np.uint64(7) | (2 * t.cls + learn[t.row]).astype(np.uint64)
        other = np.where(kind == 0, c.two >> np.uint64(32), one_place).astype(np.uint32)
        dealt = (np.where(kind == 0, c.one, c.two) >> np.uint64(32)).astype(np.uint32)
        self.tokens.append(((t.row + self.rows).astype(np.uint32), steps, kind, key, other, dealt))
        self.rows, self.size = self.rows + len(hashes), self.size + len(t.cls)

    def packed(self, name: str, parts: int) -> Iterator[pa.RecordBatch]:
        doc, logs, kinds, keys, others, dealt = (np.concatenate(x) for x in zip(*self.tokens, strict=True))
        ids, valid, hashes, learn = (np.concatenate(x) for x in zip(*self.docs, strict=True))
        name = xxhash.xxh3_64(name)
        for column in (ids, valid, hashes, learn):
            name.update(column.tobytes())
        chunk = int(words.signed(np.array([name.intdigest()], np.uint64))[0])
        rows = [(chunk % parts, 3, 0, len(doc), learn.tobytes(), valid.tobytes(), ids.tobytes(), hashes.tobytes())]
        for kind in range(3):
            at = np.flatnonzero(kinds == kind)
            if kind == 2:
                cuts = [(low // _SPREAD, at[low : low + _SPREAD]) for low in range(0, len(at), _SPREAD)]
            else:
                part = dealt[at] % np.uint32(parts)
                order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
                at = at[order]
                cuts = [(k, at[a:b]) for k, (a, b) in enumerate(itertools.pairwise(ends)) if a < b]
            for k, some in cuts:
                part, place = ((chunk + k) % parts, k) if kind == 2 else (k, 0)
                key, other = (x[some].astype(y) for x, y in zip((keys, others), _WIDTHS[kind], strict=True))
                columns = (logs[some], key) if kind == 1 else (logs[some], key, other)
                data = [_deltas(doc[some].astype(np.int64)), *(x.tobytes() for x in columns)]
                rows.append((part, kind, place, len(some), *data, *[None] * (4 - len(data))))
                if len(rows) == 16:
                    yield self._batch(chunk, rows)
                    rows = []
        if rows:
            yield self._batch(chunk, rows)

    def _batch(self, chunk: int, rows: list[tuple]) -> pa.RecordBatch:
        part, kind, place, n, *data = zip(*rows, strict=True)
        columns = [pa.array(x, pa.int32()) for x in (part, kind, place, n)]
        columns.insert(1, pa.array([chunk] * len(rows), pa.int64()))
        columns += [pa.array(x, pa.binary()) for x in data]
        return pa.record_batch(columns, names=_Packed._fields)


def _batches(rows: Iterator) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text as its bytes, learn) as batches."""
    held, size = [], 0
    for row in itertools.chain(rows, [None]):
        if held and (row is None or size >= _BATCH_BYTES or len(held) == _BATCH_ROWS):
            ids, texts, learn = zip(*held, strict=True)
            # a view, since texts may be no valid UTF-8
            texts = pa.array(texts, pa.large_binary()).view(pa.large_string())
            yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "text": texts, "learn": pa.array(learn, pa.bool_())})
            held, size = [], 0
        if row is not None:
            held.append(row)
            size += len(row[1])


def _dealt(rows: Iterator, model: Broadcast, parts: int) -> Iterator[tuple[int, tuple]]:
    """All tokens of rows (doc_id, text as its bytes, learn), packed, by part."""
    for batch in _classed(_batches(rows), model, parts):
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield row[0], row


def _classed(batches: Iterator[pa.RecordBatch], model: Broadcast, parts: int) -> Iterator[pa.RecordBatch]:
    """All tokens with the log probabilities of their classes by the table."""
    known: Model = model.value
    chunk, number, source = _Chunk(), 0, TaskContext.get().partitionId()
    for batch in batches:
        hashes = _text_hashes(batch.column("text"))
        learn = batch.column("learn").to_numpy(zero_copy_only=False).astype(bool)
        for piece, data in _pieces(batch):
            t = tokens(data, piece.offsets, known.vocabulary)
            logs, context = np.empty(len(t.cls), np.float64), features(t)
            for low in range(0, len(t.cls), _MINIBATCH):
                some = slice(low, low + _MINIBATCH)
                logs[some] = class_log_probabilities(known.weight, known.bias, context[:, some], t.cls[some])
            some = slice(piece.first, piece.last)
            ids = batch.column("doc_id").slice(piece.first, piece.last - piece.first)
            chunk.add(ids, hashes[some], learn[some], t, contexts(t, known.vocabulary), logs)
            if chunk.size >= CHUNK_TOKENS:
                yield from chunk.packed(f"{source} {number}", parts)
                chunk, number = _Chunk(), number + 1
    if chunk.rows:
        yield from chunk.packed(f"{source} {number}", parts)


_CLASSED = "route long, pair long, slot long, kind int, learn boolean, cls int, log_p double"


@dataclass
class _Kind:
    """The tokens of one kind of a part, sorted by route, pair and class. Where the word or
    the pair before them is frequent, they have its place."""

    kind: int
    cls: np.ndarray
    learn: np.ndarray
    p: np.ndarray
    slot: np.ndarray
    route: np.ndarray
    pair: np.ndarray
    one: np.ndarray | None
    two: np.ndarray | None

    def after_one(self, evidence: Evidence) -> tuple[np.ndarray, np.ndarray]:
        """For each token, how often its class follows the word before in training, and how
        many tokens do."""
        if self.one is None:
            return _run_counts(_runs(self.route), self.cls, self.learn)
        return evidence.one[self.one, self.cls], evidence.one_total[self.one]

    def after_two(self, evidence: Evidence) -> tuple[np.ndarray, np.ndarray]:
        if self.two is None:
            return _run_counts(_runs(self.pair), self.cls, self.learn)
        return evidence.two[self.two, self.cls], evidence.two_total[self.two]


def _kinds(rows: list, pairs: bool = True) -> tuple[list[_Kind], list[tuple[int, np.ndarray]]]:
    """A part's tokens by kind, and for each row its chunk and documents, whose sums have
    slots of their own, one after the other. Without ``pairs`` only routes are sorted."""
    found: dict[int, list[tuple]] = {}
    slots, end = [], 0
    for r in rows:
        doc = _numbers(r.docs, r.n)
        first = np.diff(doc, prepend=-1) > 0
        slots.append((r.chunk, doc[first]))
        key, other = (np.frombuffer(x or b"", y) for x, y in zip((r.keys, r.others), _WIDTHS[r.kind], strict=True))
        found.setdefault(r.kind, []).append((np.frombuffer(r.logs, np.uint16), end - 1 + np.cumsum(first), key, other))
        end += len(slots[-1][1])
    kinds = []
    for kind, parts in found.items():
        logs, slot, key, other = (np.concatenate(x) for x in zip(*parts, strict=True))
        key, other = key.astype(np.int64), other.astype(np.int64)
        if kind == 0:
            order = _by_route(key, other) if pairs else np.argsort(key)
            logs, slot, key, other = (x[order] for x in (logs, slot, key, other))
        elif kind == 1 and pairs:
            order = np.argsort(key)
            logs, slot, key = (x[order] for x in (logs, slot, key))
        learn, cls, context = (key & 1).astype(bool), key >> 1 & CLASSES - 1, key >> 7
        p = np.exp(logs.astype(np.float64) / -_LOG_STEPS)
        # a pair is known by its word and its own hash
        pair = words.signed(words.mix(context.view(np.uint64)) + other.view(np.uint64)) if kind == 0 else context
        one = (None, context >> 42, other)[kind]
        kinds.append(_Kind(kind, cls, learn, p, slot, context, pair, one, context if kind == 2 else None))
    return kinds, slots


def _by_route(key: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Order by route, then by what is beside it, then by class. Two sorts of one number each
    are faster than one of two."""
    order = np.argsort(key)
    number = _runs(key[order] >> 7)
    rest = other << 7 | key & 127  # 39 bits
    if len(number) and number[-1] >> 24:
        return np.lexsort((rest, key >> 7))
    return order[np.argsort(number.astype(np.int64) << 39 | rest[order])]


def _of_part(rows: Iterator[tuple[int, tuple]], work: Callable[[Iterator[_Packed]], Iterator]) -> Iterator:
    return work(_Packed(*row) for _, row in rows)


def _in_order(rows: Iterator) -> tuple[list, list]:
    """A part's rows of tokens, in an order that does not depend on their way, and of documents."""
    rows = sorted(rows, key=lambda r: (r.chunk, r.kind, r.place))
    return [r for r in rows if r.kind < 3], [r for r in rows if r.kind == 3]


def _gained(rows: Iterator, evidence: Broadcast, one_strength: np.ndarray | None) -> Iterator[np.ndarray]:
    """Gains by counts after the word before, or, once their strengths are known, by those
    after the two words before, of all training tokens of a part."""
    known: Evidence = evidence.value
    out = np.zeros((_SIZES, len(_STRENGTHS) + 1), np.int64)
    for t in _kinds(_in_order(rows)[0], one_strength is not None)[0]:
        p, (n, total) = t.p[t.learn], (x[t.learn] for x in t.after_one(known))
        if one_strength is not None:
            # these tokens' own occurrences are left out of both counts
            p = blended(p, n - 1, total - 1, one_strength)
            n, total = (x[t.learn] for x in t.after_two(known))
        out += gains(p, n, total)
    yield out


def _runs(key: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))


def _weighed(
    batches: Iterator[pa.RecordBatch], one_strength: np.ndarray, two_strength: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Log probabilities of classes once what follows rare words and pairs is counted. Rows
    come sorted by route and pair, so that counts are sums over runs."""
    held: pa.Table | None = None

    def weighed(rows: pa.Table) -> pa.RecordBatch:
        route, pair, cls, logs = (rows.column(c).to_numpy() for c in ("route", "pair", "cls", "log_p"))
        token = cls >= 0
        counted = rows.column("learn").to_numpy(zero_copy_only=False).astype(bool) & token
        cls, p = np.maximum(cls, 0), np.exp(np.where(token, logs, 0))
        p = np.where(route != pair, blended(p, *_run_counts(_runs(route), cls, counted), one_strength), p)
        # a pair has one route
        p = blended(p, *_run_counts(_runs(pair), cls, counted), two_strength)
        out = rows.select(["slot"]).combine_chunks().to_batches()[0]
        return out.append_column("class_score", pa.array(np.where(token, np.log(p), logs)))

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        route = table.column("route").to_numpy()
        cut = int(np.searchsorted(route, route[-1])) if len(route) else 0
        if cut:
            yield weighed(table.slice(0, cut))
        held = table.slice(cut)
    if held is not None and len(held):
        yield weighed(held)


_SUMMED = "chunk long, n long, docs binary, sums binary, learn binary, valid binary, ids binary, hashes binary"


def _class_sums(
    rows: Iterator, evidence: Broadcast, one_strength: np.ndarray, two_strength: np.ndarray
) -> Iterator[tuple]:
    """Sums per chunk and document over a part's tokens, and the chunks' documents."""
    known: Evidence = evidence.value
    rows, documents = _in_order(rows)
    kinds, slots = _kinds(rows)
    sums = np.zeros(sum(len(docs) for _, docs in slots))
    names = [c.split()[0] for c in _CLASSED.split(", ")]
    for t in kinds:
        p = t.p if t.one is None else blended(t.p, *t.after_one(known), one_strength)
        if t.two is not None:
            sums += np.bincount(t.slot, np.log(blended(p, *t.after_two(known), two_strength)), len(sums))
            continue
        columns = (t.route, t.pair, t.slot, np.full(len(p), t.kind), t.learn, t.cls, np.log(p))
        table = pa.record_batch([pa.array(c) for c in columns], names=names)
        for batch in _weighed(iter([table]), one_strength, two_strength):
            sums += np.bincount(batch.column("slot").to_numpy(), batch.column("class_score").to_numpy(), len(sums))
    end = 0
    for r, (chunk, docs) in zip(rows, slots, strict=True):
        own = sums[end : end + len(docs)].astype(np.float32)
        end += len(docs)
        yield chunk, r.n, _deltas(docs), own.tobytes(), None, None, None, None
    for r in documents:
        yield r.chunk, -r.n, None, None, r.docs, r.logs, r.keys, r.others


def _closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per document. Rows come sorted by chunk, its documents before their sums."""
    rows = itertools.chain.from_iterable(b.to_pylist() for b in batches)
    for _, group in itertools.groupby(rows, key=lambda r: r["chunk"]):
        head = next(group)
        if head["ids"] is None:
            raise RuntimeError("sums without their documents")
        ids, valid, hashes, learn = (
            np.frombuffer(head[c], kind)
            for c, kind in (("ids", np.int64), ("valid", bool), ("hashes", np.int64), ("learn", bool))
        )
        sums, left = np.zeros(len(ids)), -head["n"]
        for r in group:
            own = np.frombuffer(r["sums"], np.float32)
            sums[_numbers(r["docs"], len(own))] += own
            left -= r["n"]
        if left:
            raise RuntimeError("documents without some of their sums")
        yield pa.record_batch(
            {
                "doc_id": pa.array(ids, mask=~valid),
                "text_hash": pa.array(hashes),
                "learn": pa.array(learn),
                "class_score": pa.array(sums),
            }
        )


_RARE = "kind int, doc_id long, text_hash long, log_sum double, known long, distinct long"


def _rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Logarithms of rare words' counts. Rows come sorted by word, so that a word's count
    is the sum over a run; for each cluster the distinct counted words follow at the end."""
    distinct = np.zeros(CLASSES, np.int64)
    held: pa.Table | None = None

    def counted(rows: pa.Table) -> pa.RecordBatch:
        word, n, cls = (rows.column(c).to_numpy() for c in ("word", "n", "cls"))
        learn = rows.column("learn").to_numpy(zero_copy_only=False).astype(bool)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        count = np.add.reduceat(np.where(learn, n, 0), first)
        distinct[:] += np.bincount(cls[first][count > 0], minlength=CLASSES)
        each = np.repeat(count, np.diff(np.concatenate([first, [len(word)]])))
        return pa.record_batch(
            {
                "kind": pa.array(np.zeros(len(word), np.int32)),
                "doc_id": rows.column("doc_id").combine_chunks(),
                "text_hash": rows.column("text_hash").combine_chunks(),
                "log_sum": pa.array(n * np.log10(each + 0.5)),
                "known": pa.array(np.where(each > 0, n, 0)),
                "distinct": pa.array(np.zeros(len(word), np.int64)),
            }
        )

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        word = table.column("word").to_numpy()
        cut = int(np.searchsorted(word, word[-1])) if len(word) else 0
        if cut:
            yield counted(table.slice(0, cut))
        held = table.slice(cut)
    if held is not None and len(held):
        yield counted(held)
    seen = np.flatnonzero(distinct)
    if len(seen):
        none = pa.nulls(len(seen), pa.int64())
        yield pa.record_batch(
            {
                "kind": pa.array(np.ones(len(seen), np.int32)),
                "doc_id": none,
                "text_hash": pa.array(seen),
                "log_sum": pa.array(np.zeros(len(seen))),
                "known": pa.array(np.zeros(len(seen), np.int64)),
                "distinct": pa.array(distinct[seen]),
            }
        )


@contextlib.contextmanager
def _shared_workers(context: SparkContext) -> Iterator[None]:
    """Functions over RDDs run in the Python workers of those over DataFrames, which have this
    setting of the environment; another set of workers would keep its memory beside them."""
    name = "SPARK_SIMPLIFIED_TRACEBACK"
    before = context.environment.get(name)
    context.environment[name] = "1"
    try:
        yield
    finally:
        if before is None:
            del context.environment[name]
        else:
            context.environment[name] = before


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text) by a model of the rows for which
    ``learn`` holds.

    Returns doc_id, n_tokens (words and the end), n_known (tokens that occur in the
    training texts), train_tokens, base_score (log10 probability by smoothed frequencies
    alone) and score (log10 probability by the model). Null counts as the empty text,
    which has the end as its only token. A null of ``learn`` counts as false. Equal rows
    get equal results, and each counts in training; without any training text all
    frequencies are zero. Extra columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark, "watchfold")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    model = fit(rows.filter("learn"))
    sent = spark.sparkContext.broadcast(replace(model, evidence=None))
    scored = stored(rows.mapInArrow(partial(_scored, model=sent), _SCORED), "scores")
    rare = scored.filter("word is not null").select("doc_id", "text_hash", "learn", "word", "n", "cls")
    rare = rare.repartition("word").sortWithinPartitions("word").mapInArrow(_rare, _RARE)
    sums = rare.groupBy("kind", "doc_id", "text_hash").agg(
        F.sum("log_sum").alias("log_sum"), F.sum("known").alias("known"), F.sum("distinct").alias("distinct")
    )
    sums = stored(sums, "sums")
    distinct = np.zeros(CLASSES, np.int64)
    for cls, n in sums.filter("kind = 1").select("text_hash", "distinct").collect():
        distinct[cls] += n
    counted = model.head_counts > 0
    distinct += np.bincount(model.vocabulary.head_class[counted], minlength=CLASSES)
    distinct[0] = model.n_texts > 0
    base = float(np.log10(model.n_tokens + 0.5 * (distinct.sum() + 1)))
    inner = np.log10(model.class_counts + 0.5 * (distinct + 1))[SINGLES:]

    tokens_of_all = scored.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, tokens_of_all // PART_TOKENS + 1)
    counts = spark.sparkContext.broadcast(model.evidence)
    _release(spark)
    with _shared_workers(spark.sparkContext):
        # pairs of an RDD of Python stay as Python has packed them on their way to each reading,
        # and their shuffle is kept while it is in use
        packed = rows.withColumn("text", F.col("text").cast("binary")).rdd
        packed = packed.mapPartitions(partial(_dealt, model=sent, parts=parts)).partitionBy(parts, int)
        gained = partial(_gained, evidence=counts)
        one = packed.mapPartitions(partial(_of_part, work=partial(gained, one_strength=None))).treeReduce(np.add)
        one = strengths(one)
        two = packed.mapPartitions(partial(_of_part, work=partial(gained, one_strength=one))).treeReduce(np.add)
        two = strengths(two)
        added = partial(_class_sums, evidence=counts, one_strength=one, two_strength=two)
        classed = packed.mapPartitions(partial(_of_part, work=added))
        classed = spark.createDataFrame(classed, _SUMMED)
    classed = classed.repartition("chunk")
    classed = classed.sortWithinPartitions("chunk", F.col("ids").isNull()).mapInArrow(
        _closed, "doc_id long, text_hash long, learn boolean, class_score double"
    )
    classed = classed.groupBy("doc_id", "text_hash", "learn").agg(F.sum("class_score").alias("class_score"))
    texts = scored.filter("word is null").groupBy("doc_id", "text_hash", "learn").agg(
        F.count("*").cast("int").alias("copies"),
        *(F.first(c).alias(c) for c in ("n_tokens", "n_known", "base_sum", "inner_sum", "clusters")),
    )
    own = sums.filter("kind = 0").select("doc_id", "text_hash", "log_sum", "known")
    joined = texts.alias("t").join(
        own.alias("s"), F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("t.text_hash") == F.col("s.text_hash")), "left"
    )
    joined = joined.join(
        classed.alias("c"),
        F.col("t.doc_id").eqNullSafe(F.col("c.doc_id"))
        & (F.col("t.text_hash") == F.col("c.text_hash"))
        & (F.col("t.learn") == F.col("c.learn")),
        "left",
    )
    # equal rows have added up their equal sums
    log_sum = F.coalesce(F.col("log_sum") / F.col("copies"), F.lit(0.0))
    known = F.coalesce(F.expr("known div copies"), F.lit(0).cast("long"))
    return joined.select(
        "t.doc_id",
        "t.learn",
        "n_tokens",
        (F.col("n_known") + known).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base_sum") + log_sum - F.col("n_tokens") * base).alias("base_score"),
        (F.col("class_score") / F.col("copies") / F.log(F.lit(10.0))).alias("class_score"),
        (F.col("inner_sum") + log_sum).alias("inner_sum"),
        "clusters",
        "copies",
    ).mapInArrow(
        partial(_finished, inner=inner),
        "doc_id long, learn boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _finished(batches: Iterator[pa.RecordBatch], inner: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Closes the score and gives equal rows a row each."""
    for batch in batches:
        if not len(batch):
            continue
        clusters = np.frombuffer(b"".join(batch.column("clusters").to_pylist()), np.int32).reshape(len(batch), CLUSTERS)
        total = batch.column("class_score").to_numpy() + batch.column("inner_sum").to_numpy() - clusters @ inner
        out = batch.select(["doc_id", "learn", "n_tokens", "n_known", "train_tokens", "base_score"])
        out = out.append_column("score", pa.array(total))
        yield out.take(pa.array(np.repeat(np.arange(len(batch)), batch.column("copies").to_numpy())))
