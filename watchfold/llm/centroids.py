"""Exact k-means over integer vectors by Walsh-Hadamard progressive search.

The Walsh-Hadamard transform of an integer vector is exact, and the squared differences of
two transforms add up to 64 times the vectors' squared distance. In the order of rising
sequency the first coefficients hold the coarse shape, so that their partial sums, which
only grow, soon exceed the whole distance of a better centroid: such a centroid is
strictly worse and is followed no further. What is left gets all 64 coefficients, so that
distances and ties come out exact.

Vectors stay where they are: each round is one pass in which every task assigns its
vectors and sends back the sums of their coefficients per cluster, from which the inverse
transform has the sums of the components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold.llm.graphs import stored
from watchfold.session import ship

SIZE = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
#: Coefficients that have been added up when centroids are eliminated, coarse to fine.
STEPS = (4, 8, 16, 32, 64)
#: Components below this keep 64 times a squared distance within 62 bits; vectors with
#: larger ones are worked on with Python's integers.
NARROW = 1 << 24
#: Vectors that a task works on at once.
_BLOCK = 4096


def _sequency(size: int) -> np.ndarray:
    """Rows of the transform in the order of their number of sign changes."""
    at = np.arange(size)
    signs = np.array([[bin(int(i & j)).count("1") & 1 for j in at] for i in at])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


ORDER = _sequency(SIZE)


def transform(vectors: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, in natural order; exact for integers."""
    out = vectors.copy()
    half = 1
    while half < SIZE:
        pairs = out.reshape(len(out), SIZE // (2 * half), 2, half)
        left, right = pairs[:, :, 0, :], pairs[:, :, 1, :]
        out = np.stack([left + right, left - right], axis=2).reshape(len(out), SIZE)
        half *= 2
    return out


def search(coefficients: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row and the squared distance, ties to the smaller number.

    Both arguments are coefficients in the order of rising sequency. A pair is followed
    while its partial sum is not above the distance of the row's leader, the centroid that
    was ahead after the first step and is then summed up whole.
    """
    rows, least = len(coefficients), STEPS[0]
    coarse = coefficients[:, None, :least] - centroids[None, :, :least]
    sums = (coarse * coarse).sum(axis=2)
    lead = sums.argmin(axis=1)
    at = np.arange(rows)
    rest = coefficients[:, least:] - centroids[lead, least:]
    bound = sums[at, lead] + (rest * rest).sum(axis=1)
    row, centroid = np.nonzero((sums <= bound[:, None]) & (np.arange(len(centroids))[None, :] != lead[:, None]))
    total = sums[row, centroid]
    for low, high in zip(STEPS, STEPS[1:]):
        part = coefficients[row, low:high] - centroids[centroid, low:high]
        total = total + (part * part).sum(axis=1)
        keep = total <= bound[row]
        row, centroid, total = row[keep], centroid[keep], total[keep]
    # finished pairs and leaders: the smallest distance, then the smallest number
    row, centroid = np.concatenate([row, at]), np.concatenate([centroid, lead])
    total = np.concatenate([total, bound])
    order = np.lexsort((centroid, total, row)) if total.dtype != object else np.array(
        sorted(range(len(row)), key=lambda i: (row[i], total[i], centroid[i])), dtype=np.int64
    )
    first = order[np.concatenate([[True], row[order][1:] != row[order][:-1]])] if rows else order
    return centroid[first], total[first] // SIZE


def assign(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centroid, squared distance and coefficients of each row of integers."""
    wide = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) >= NARROW
    kind = object if wide else np.int64
    found = transform(vectors.astype(kind))
    cluster, distance = search(found[:, ORDER], transform(centroids.astype(kind))[:, ORDER])
    return cluster, distance, found


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    column = batch.column("vector")
    whole = column.flatten().to_numpy().reshape(len(batch), SIZE)
    for first in range(0, len(batch), _BLOCK):
        yield first, whole[first : first + _BLOCK]


_SUMS = "cluster int, place int, n long, total decimal(38,0)"


def _cluster_sums(batches: Iterator[pa.RecordBatch], centroids: list[list[int]]) -> Iterator[pa.RecordBatch]:
    """Per cluster, the number of its vectors in this task and the sum of each coefficient."""
    places = np.array(centroids, dtype=object)
    counts, sums = [0] * len(centroids), np.zeros((len(centroids), SIZE), dtype=object)
    for batch in batches:
        for _, vectors in _vectors(batch):
            cluster, _, found = assign(vectors, places)
            for k in np.unique(cluster):
                own = found[cluster == k]
                counts[k] += len(own)
                sums[k] += own.sum(axis=0)
    used = [(k, i) for k, n in enumerate(counts) if n for i in range(SIZE)]
    yield pa.record_batch(
        {
            "cluster": pa.array([k for k, _ in used], pa.int32()),
            "place": pa.array([i for _, i in used], pa.int32()),
            "n": pa.array([counts[k] for k, _ in used], pa.int64()),
            "total": pa.array([int(sums[k, i]) for k, i in used], pa.decimal128(38, 0)),
        }
    )


def _assigned(batches: Iterator[pa.RecordBatch], centroids: list[list[int]]) -> Iterator[pa.RecordBatch]:
    places = np.array(centroids, dtype=object)
    for batch in batches:
        for first, vectors in _vectors(batch):
            cluster, distance, _ = assign(vectors, places)
            yield pa.record_batch(
                {
                    "vec_id": batch.column("vec_id").slice(first, len(vectors)),
                    "cluster": pa.array(cluster.astype(np.int32)),
                    "distance": pa.array(distance.tolist(), pa.int64()),
                }
            )


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, vector)``: the whole vectors with components as floor(1024 * x)."""
    value = F.col("embedding")
    whole = (F.size(value) == SIZE) & ~F.exists(
        value, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )

    def component(x: Column) -> Column:
        scaled = x.cast("double") * SCALE
        return F.when(F.abs(scaled) < float(1 << 62), F.floor(scaled)).otherwise(
            F.raise_error(F.concat(F.lit("component is too large: "), x.cast("string"))).cast("long")
        )

    return vectors.filter(F.coalesce(whole, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(value, component).alias("vector")
    )


def updated(centroids: list[list[int]], parts: DataFrame) -> list[list[int]]:
    """Centroids after a round: floor of the components' mean, empty clusters as before."""
    merged = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    totals, counts = np.zeros((len(centroids), SIZE), dtype=object), [0] * len(centroids)
    for row in merged.collect():  # 64 rows per cluster
        totals[row["cluster"], row["place"]] = int(row["total"])
        counts[row["cluster"]] = row["n"]
    # the transform is its own inverse but for the factor 64
    sums = transform(totals) // SIZE
    return [[int(x) // n for x in sums[k]] if n else list(centroids[k]) for k, n in enumerate(counts)]


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3) -> tuple[DataFrame, list[list[int]]]:
    """``(vec_id, cluster, distance)`` for every whole vector of ``vectors`` (vec_id,
    embedding), and the final centroids.

    Vectors count if they have exactly 64 components, none of them null or non-finite;
    others have no row. The ``clusters`` vectors with the smallest SHA-256 of
    ``seed:vec_id`` are the first centroids, fewer if there are fewer vectors. Equal
    hashes are ordered by the vector; rows without vec_id have no hash and come last.
    Equal rows get equal results. A vector's ties go to the smaller cluster, a cluster
    without vectors keeps its centroid. Components and distances must fit a long, or the
    job fails. Extra columns are not looked at; an empty table stays empty.
    """
    ship(vectors.sparkSession, "watchfold")
    kept = stored(integer_vectors(vectors), "vectors")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.select(hashed.alias("hash"), "vector").orderBy(F.asc_nulls_last("hash"), "vector").limit(clusters)
    centroids = [list(r["vector"]) for r in first.collect()]
    if centroids:
        for _ in range(rounds):
            centroids = updated(centroids, kept.select("vector").mapInArrow(partial(_cluster_sums, centroids=centroids), _SUMS))
    out = kept.mapInArrow(partial(_assigned, centroids=centroids), "vec_id long, cluster int, distance long")
    return out if centroids else kept.selectExpr("vec_id", "0 as cluster", "0L as distance"), centroids


def cluster_report(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3) -> DataFrame:
    """:func:`clustered` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` (of
    the final centroid's components, joined by commas) on every row."""
    found, centroids = clustered(vectors, clusters, rounds, seed)
    found = stored(found, "clusters")
    spark = found.sparkSession
    digests = [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids)]
    digest = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    each = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = {r["cluster"]: r["cluster_inertia"] for r in each.collect()}  # one row per cluster
    known = spark.createDataFrame([(k, n, sum(sums.values())) for k, n in sums.items()], "cluster int, cluster_inertia long, inertia long")
    # a row per cluster on the right: no more than `clusters`
    return found.join(F.broadcast(known.join(digest, "cluster")), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
