"""Exact k-means against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchfold.llm import centroids


def brute(rows, clusters=8, rounds=10):
    """(vec_id, embedding) -> sorted (vec_id, cluster, distance)."""
    kept = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest()
    first = sorted((r for r in kept if r[0] is not None), key=lambda r: (digest(r[0]), r[1]))
    first += sorted((r for r in kept if r[0] is None), key=lambda r: r[1])
    places = [v for _, v in first[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(places))

    for _ in range(rounds):
        own = [[] for _ in places]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        places = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else p for g, p in zip(own, places, strict=True)]
    return sorted(((i, k, d) for i, v in kept for d, k in [nearest(v)]), key=str)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def found(df):
    return sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in df.collect()), key=str)


def test_transform_is_the_walsh_hadamard_matrix():
    signs = np.array([[(-1) ** bin(i & j).count("1") for j in range(64)] for i in range(64)])
    x = np.random.default_rng(1).integers(-1000, 1000, (5, 64))
    assert (centroids.transform(x) == x @ signs).all()
    changes = [(np.diff(signs[i]) != 0).sum() for i in centroids.ORDER]
    assert changes == list(range(64))


@pytest.mark.parametrize("kind", [np.int64, object])
@pytest.mark.parametrize("spread", [2, 300])
def test_search_is_exact_and_ties_go_to_the_smaller_number(kind, spread):
    rng = np.random.default_rng(spread)
    x, c = rng.integers(-spread, spread, (400, 64)), rng.integers(-spread, spread, (9, 64))
    c[5], c[7] = c[2], x[3]
    cluster, distance = centroids.search(*(centroids.transform(v.astype(kind))[:, centroids.ORDER] for v in (x, c)))
    full = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (cluster == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()


def test_given_vectors_agree_with_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").limit(200)
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    assert found(centroids.clustered(vectors(spark, rows).repartition(5))[0]) == brute(rows)


def test_ties_repeated_and_large_vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) / 4 for x in rng.integers(-2, 2, 64)]) for i in range(40)]
    rows += [rows[3]] * 30 + [(100 + i, rows[5][1]) for i in range(20)]
    rows += [(200, [40_000.5] * 64), (201, [-40_000.25] * 64), (None, [0.5] * 64), (None, [0.5] * 64)]
    assert found(centroids.clustered(vectors(spark, rows))[0]) == brute(rows)


def test_what_is_no_whole_vector_has_no_row(spark):
    good = [0.25] * 64
    rows = [(1, good), (2, None), (3, []), (4, good[1:]), (5, [*good, 1.0])]
    rows += [(6, [None, *good[1:]]), (7, [float("nan"), *good[1:]]), (8, [*good[1:], float("inf")]), (9, [-float("inf"), *good[1:]])]
    df = vectors(spark, rows).withColumns({"cluster": F.lit("x"), "distance": F.lit("y"), "vector": F.lit(0)})
    assert centroids.cluster_report(df).collect()[0].asDict() == {
        "vec_id": 1,
        "cluster": 0,
        "distance": 0,
        "cluster_inertia": 0,
        "inertia": 0,
        "centroid_sha256": hashlib.sha256(",".join(["256"] * 64).encode()).hexdigest(),
    }
    assert centroids.cluster_report(vectors(spark, rows[1:])).collect() == []
    assert centroids.cluster_report(vectors(spark, [])).collect() == []


def test_components_beyond_a_long_fail(spark):
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_report(vectors(spark, [(1, [1e300] * 64)])).collect()
