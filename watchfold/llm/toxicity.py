"""Toxicity by a factorization machine over hashed terms.

Terms are the distinct words of a text (Unicode lower case; anything but letters, digits
and non-ASCII characters separates) and their beginnings, hashed to 2**18 features. A weight per feature and
the products of latent vectors, one per pair of features, make the score, so that two
words may say together what neither says alone.

Learning follows AdaGrad with an L1 step on the weights. Features that chance may tie to
the labels are left out, and only features with a weight have a latent vector. Pairs of
features are held against the labels on their own, whether or not their parts are tied to
them, and those that say more than their parts have a weight like features. It uses a bounded sample of the labelled rows, in the order of a hash of
doc_id: at most ``MAX_ROWS`` rows and ``MAX_TERMS`` terms. Everything else, the scoring,
covers all rows and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from watchfold.llm import words
from watchfold.llm.graphs import stored
from watchfold.session import scratch_dir, ship
from watchfold.sources.files import open_filesystem

FEATURES = 1 << 18
FACTORS = 8
#: Bytes of a word's beginning, which is a term of its own.
BEGINNING = 4
#: Bounds of the labelled sample that the model is fitted on.
MAX_ROWS = 20_000
MAX_TERMS = 12_000_000

#: Features in fewer documents of the sample, or less surely tied to the labels (by the
#: chi-squared statistic), get no weight.
_LEAST_DOCUMENTS = 3
_LEAST_TIE = 15.0
#: Toxic documents of the sample that a pair must have, and how surely (as a logarithm, beyond
#: that of the number of pairs) they are more than its parts explain.
_LEAST_PAIR = 5
_PAIR_MARGIN = 3.0
_EPOCHS = 20
_BATCH = 256
_RATE = 0.3
_L1 = 1e-4
_L2 = 1e-4


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text is 0 modulo 5.

    So is a row without id.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


@dataclass
class Model:
    """Bias, weights and latent vectors of the features, and weights of pairs of them."""

    bias: float
    weight: np.ndarray
    latent: np.ndarray
    pairs: np.ndarray
    pair_weight: np.ndarray

    def scores(self, feature: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Probability per row, from the (row, feature) entries of its text."""
        active = self.weight != 0
        active[self.pairs.ravel()] = True
        active = active[feature]
        entry = np.unique(row[active].astype(np.int64) * FEATURES + feature[active])
        row, feature = entry // FEATURES, entry % FEATURES
        z = self.bias + np.bincount(row, self.weight[feature], rows)
        both, pair = _pair_entries(row, feature, self.pairs)
        z += np.bincount(both, self.pair_weight[pair], rows)
        for latent in self.latent.T[:, feature]:
            z += 0.5 * (np.bincount(row, latent, rows) ** 2 - np.bincount(row, latent * latent, rows))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _features(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, number of rows, and the (feature, row) entries of each piece."""
    column = pc.utf8_lower(batch.column("text").cast(pa.large_string()))
    for piece in words.pieces(column):
        found = words.split(piece.data, piece.offsets, words.NOT_ALNUM)
        starts = words.Words(found.start, np.minimum(found.end, found.start + BEGINNING), found.first)
        hashes = [words.hash_words(piece.data, found), words.mix(words.hash_words(piece.data, starts))]
        feature = (np.concatenate(hashes) & np.uint64(FEATURES - 1)).astype(np.int64)
        yield piece.first, piece.last - piece.first, feature, np.tile(found.row, 2)


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct features of each labelled text."""
    for batch in batches:
        for first, rows, feature, row in _features(batch):
            entry = np.unique(row * FEATURES + feature)
            border = np.searchsorted(entry // FEATURES, np.arange(rows + 1))
            lists = pa.ListArray.from_arrays(
                pa.array(border, pa.int32()), pa.array((entry % FEATURES).astype(np.int32))
            )
            place, toxic = (batch.column(c).slice(first, rows) for c in ("place", "toxic"))
            yield pa.record_batch(
                {"place": place, "toxic": toxic, "features": lists, "terms": pa.array(np.diff(border), pa.int32())}
            )


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_terms: int = MAX_TERMS) -> Model:
    """A model of ``labels`` (doc_id, toxic) over the texts of ``docs`` (doc_id, text).

    Rows that :func:`held_out` names are not looked at. A document with several labels is
    toxic if one of them says so; null labels and labels without a text are ignored.
    Without any label the model rejects nothing.
    """
    ship(docs.sparkSession, "watchfold")
    doc_id = F.col("doc_id").cast("long")
    known = labels.select(doc_id.alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("toxic is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("place", F.xxhash64("doc_id"))
    known = stored(known.orderBy("place").limit(max_rows), "labels")  # at most max_rows rows: may be broadcast
    texts = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(known), "doc_id").mapInArrow(
        _samples, "place long, toxic int, features array<int>, terms int"
    )
    rows = stored(rows, "samples")
    order = ["place", "toxic", "terms"]
    ahead = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    chosen = rows.select(*order).withColumn("sum", F.sum("terms").over(ahead)).filter(F.col("sum") > max_terms)
    end = chosen.agg(F.min("place")).first()[0]
    if end is not None:
        rows = rows.filter(F.col("place") < end)
    # one sorted file, read past the JVM, whose heap would otherwise hold all of it
    path = scratch_dir(docs.sparkSession, "chosen")
    rows.orderBy(*order).limit(max_rows).write.parquet(path)
    filesystem, name = open_filesystem(path)
    table = pq.read_table(name, filesystem=filesystem, columns=["toxic", "features", "terms"])
    column = table.column("features").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.int32()))
    feature = column.flatten().to_numpy(zero_copy_only=False)
    border = np.concatenate([[0], np.cumsum(table.column("terms").to_numpy())]).astype(np.int64)
    label = table.column("toxic").to_numpy().astype(np.float64)
    del table, column
    pa.default_memory_pool().release_unused()
    model = learn(feature, border, label)
    del feature
    pa.default_memory_pool().release_unused()
    return model


def _tied(feature: np.ndarray, border: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Features that are common enough and surely tied to the labels."""
    seen, toxic = np.zeros(FEATURES), np.zeros(FEATURES)
    marked = np.repeat(label > 0, np.diff(border))
    for low in range(0, len(feature), 1 << 20):
        some = feature[low : low + (1 << 20)]
        seen += np.bincount(some, minlength=FEATURES)
        toxic += np.bincount(some[marked[low : low + (1 << 20)]], minlength=FEATURES)
    share = label.mean() if len(label) else 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        tie = (toxic - seen * share) ** 2 / (seen * share * (1 - share) * (1 - seen / len(label)))
    return (seen >= _LEAST_DOCUMENTS) & (np.nan_to_num(tie, posinf=0.0) >= _LEAST_TIE)


def _joined(column: np.ndarray, border: np.ndarray, some: np.ndarray) -> np.ndarray:
    """``column[border[i]:border[i + 1]]`` of each i of ``some``, one after the other."""
    size = border[some + 1] - border[some]
    return column[np.arange(size.sum()) + np.repeat(border[some] - np.cumsum(size) + size, size)]


def _docs_by_feature(x: np.ndarray, doc: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each feature's documents, about a million entries sorted at a time."""
    ends = np.cumsum(np.bincount(x, minlength=size))
    low = 0
    while low < size:
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + (1 << 20), side="right")))
        at = np.flatnonzero((x >= low) & (x < high))
        docs = doc[at[np.argsort(x[at], kind="stable")]]
        for a in range(low, high):
            yield a, docs[(ends[a - 1] if a else 0) - before : ends[a] - before]
        low = high


def _with(x: np.ndarray, border: np.ndarray, docs: np.ndarray, size: int) -> np.ndarray:
    """How many of ``docs`` have each feature."""
    out = np.zeros(size, np.int64)
    for low in range(0, len(docs), 256):
        out += np.bincount(_joined(x, border, docs[low : low + 256]), minlength=size)
    return out


def _tied_pairs(feature: np.ndarray, border: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Pairs (a < b) of features with more toxic documents than a, b or both on their own explain.

    Each feature's toxic documents are counted by all other features, the documents of
    those that may pass as well. All pairs with enough toxic documents are looked at.
    """
    none = np.empty((0, 2), np.int64)
    rows, toxic = len(label), label > 0
    if not toxic.any() or toxic.all():
        return none
    seen = np.bincount(feature, minlength=FEATURES)
    of_toxic = [feature[border[i] : border[i + 1]] for i in np.flatnonzero(toxic)]
    known = np.flatnonzero(np.bincount(np.concatenate(of_toxic), minlength=FEATURES) >= _LEAST_PAIR)
    place = np.full(FEATURES, -1, np.int32)
    place[known] = np.arange(len(known))
    # large arrays: filled part by part
    x = np.empty(seen[known].sum(), np.int32)
    doc, end = np.empty_like(x), 0
    for low in range(0, rows, 256):
        borders = border[low : low + 257]
        some = place[feature[borders[0] : borders[-1]]]
        keep = some >= 0
        n = int(keep.sum())
        x[end : end + n] = some[keep]
        doc[end : end + n] = np.repeat(np.arange(low, low + len(borders) - 1), np.diff(borders))[keep]
        end += n
    by_doc = np.searchsorted(doc, np.arange(rows + 1, dtype=np.int32))
    rate = (np.bincount(place[np.concatenate(of_toxic)] + 1, minlength=len(known) + 1)[1:] + 0.5) / (seen[known] + 1)
    share = toxic.mean()
    logit, base = np.log(rate / (1 - rate)), np.log(share / (1 - share))
    least = np.log(len(known) ** 2 / 2 + 1) + _PAIR_MARGIN
    found = [none]
    for a, mine in _docs_by_feature(x, doc, len(known)):
        t = _with(x, by_doc, mine[toxic[mine]], len(known))
        t[: a + 1] = 0
        together = 1 / (1 + np.exp(base - logit[a] - logit))
        expected = np.maximum(np.maximum(together, share), np.maximum(rate[a], rate))
        b = np.flatnonzero((t >= _LEAST_PAIR) & (-t * np.log(expected) >= least))
        if not len(b):
            continue
        n = t + _with(x, by_doc, mine[~toxic[mine]], len(known))
        t, n, e = t[b], n[b], expected[b]
        clean = np.where(n > t, (n - t) * np.log(np.maximum(1 - t / n, 1e-12) / (1 - e)), 0)
        b = b[(t > n * e) & (t * np.log(t / n / e) + clean >= least)]
        found.append(np.stack([np.full(len(b), known[a]), known[b]], axis=1))
    return np.concatenate(found)


def _pair_entries(row: np.ndarray, feature: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (row, number of a pair) entries of rows that have both features of a pair; rows
    and their distinct features are sorted, and pairs by their first."""
    low, high = (np.searchsorted(pairs[:, 0], feature, side=s) for s in ("left", "right"))
    entry = row.astype(np.int64) * FEATURES + feature
    ends = np.cumsum(high - low)
    found = [(row[:0], low[:0])]
    begin = 0
    while begin < len(row):  # about a million candidates at a time
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + (1 << 20), side="right")))
        size = (high - low)[begin:end]
        pair = np.arange(size.sum()) + np.repeat(low[begin:end] - np.cumsum(size) + size, size)
        row_of = np.repeat(row[begin:end], size)
        wanted = row_of.astype(np.int64) * FEATURES + pairs[pair, 1]
        at = np.minimum(np.searchsorted(entry, wanted), len(entry) - 1)
        there = entry[at] == wanted
        found.append((row_of[there], pair[there]))
        begin = end
    return np.concatenate([r for r, _ in found]), np.concatenate([p for _, p in found])


def _pairs_of_rows(feature: np.ndarray, border: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs that each row has, one row after the other, and the rows' borders."""
    member = np.zeros(FEATURES, bool)
    member[pairs.ravel()] = True
    found, sizes = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
    for low in range(0, len(border) - 1, 512):
        borders = border[low : low + 513]
        some = feature[borders[0] : borders[-1]]
        at = np.flatnonzero(member[some])
        row = np.searchsorted(borders - borders[0], at, side="right") - 1
        both, pair = _pair_entries(row, some[at], pairs)
        found.append(pair.astype(np.int32))
        sizes.append(np.bincount(both, minlength=len(borders) - 1))
    return np.concatenate(found), np.cumsum(np.concatenate(sizes))


def learn(feature: np.ndarray, border: np.ndarray, label: np.ndarray, seed: int = 7) -> Model:
    """Fits a model to rows whose features are ``feature[border[i]:border[i + 1]]``."""
    rows = len(label)
    pairs = _tied_pairs(feature, border, label)
    pair, pair_border = _pairs_of_rows(feature, border, pairs)
    pair_weight, pair_sum = np.zeros(len(pairs)), np.full(len(pairs), 1e-6)
    positive = float(label.sum())
    bias = float(np.log((positive + 0.5) / (rows - positive + 10.0)))
    weight, weight_sum = np.zeros(FEATURES), np.full(FEATURES, 1e-6)
    rng = np.random.default_rng(seed)
    latent, latent_sum = rng.normal(0, 0.05, (FEATURES, FACTORS)), np.full((FEATURES, FACTORS), 1e-2)
    usable = _tied(feature, border, label)
    bias_sum = 1e-6
    for _ in range(_EPOCHS if rows else 0):
        order = rng.permutation(rows)
        for low in range(0, rows, _BATCH):
            some = order[low : low + _BATCH]
            size = border[some + 1] - border[some]
            row = np.repeat(np.arange(len(some)), size)
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(border[some], size)
            x = feature[at]
            keep = usable[x]
            row, x = row[keep], x[keep]
            used, place = np.unique(x, return_inverse=True)
            w, v = weight[used], latent[used] * (weight[used] != 0)[:, None]
            total = np.stack([np.bincount(row, f[place], len(some)) for f in v.T], axis=1)
            square = np.bincount(row, (v * v).sum(1)[place], len(some))
            z = bias + np.bincount(row, w[place], len(some)) + 0.5 * ((total * total).sum(1) - square)
            pair_row = np.repeat(np.arange(len(some)), pair_border[some + 1] - pair_border[some])
            used_pair = _joined(pair, pair_border, some)
            z += np.bincount(pair_row, pair_weight[used_pair], len(some))
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label[some]) / len(some)
            # the bias moves slowly: the weights explain the rows
            bias_sum += error.sum() ** 2
            bias -= 0.1 * _RATE * error.sum() / np.sqrt(bias_sum)
            used_pair, pair_place = np.unique(used_pair, return_inverse=True)
            slope = np.bincount(pair_place, error[pair_row], len(used_pair))
            pair_sum[used_pair] += slope * slope
            step = _RATE / np.sqrt(pair_sum[used_pair])
            moved = pair_weight[used_pair] - step * slope
            pair_weight[used_pair] = np.sign(moved) * np.maximum(np.abs(moved) - step * _L1, 0)
            slope = np.bincount(place, error[row], len(used))
            weight_sum[used] += slope * slope
            step = _RATE / np.sqrt(weight_sum[used])
            moved = w - step * slope
            weight[used] = np.sign(moved) * np.maximum(np.abs(moved) - step * _L1, 0)
            for f in range(FACTORS):
                pull = np.bincount(place, error[row] * total[row, f], len(used)) - slope * v[:, f] + _L2 * v[:, f]
                pull = np.where(w != 0, pull, 0)
                latent_sum[used, f] += pull * pull
                latent[used, f] -= 0.3 * _RATE * pull / np.sqrt(latent_sum[used, f])
    active = weight != 0
    pairs, pair_weight = pairs[pair_weight != 0], pair_weight[pair_weight != 0]
    return Model(bias, weight.astype(np.float32), (latent * active[:, None]).astype(np.float32), pairs, pair_weight)


def _scored(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, rows, feature, row in _features(batch):
            score = model.value.scores(feature, row, rows)
            yield pa.record_batch({"doc_id": batch.column("doc_id").slice(first, rows), "score": pa.array(score)})


def _accepted(batches: Iterator[pa.RecordBatch], model: Broadcast, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, rows, feature, row in _features(batch):
            clean = model.value.scores(feature, row, rows) < threshold
            yield batch.slice(first, rows).filter(pa.array(clean))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` for every row of ``docs`` (doc_id, text); null and empty texts
    get the score of a text without terms. Equal rows get equal results."""
    ship(docs.sparkSession, "watchfold")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return texts.mapInArrow(partial(_scored, model=sent), f"doc_id {kind}, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    ship(docs.sparkSession, "watchfold")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(partial(_accepted, model=sent, threshold=threshold), docs.schema)
