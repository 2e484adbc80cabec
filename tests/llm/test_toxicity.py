"""Toxicity: held-out accuracy, pairs of words, and rows that could go wrong."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchfold.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").filter(toxicity.held_out(F.col("doc_id")))
    counts = {(r["toxic"], r["p"]): r["count"] for r in rows.withColumn("p", F.col("score") >= 0.5).groupBy("toxic", "p").count().collect()}
    assert counts.get((1, True), 0) >= 0.85 * (counts.get((1, True), 0) + counts.get((1, False), 0))
    assert counts.get((0, True), 0) <= 0.01 * (counts.get((0, True), 0) + counts.get((0, False), 0))


def test_pairs_of_words_count():
    """Neither of two features decides alone, only both together."""
    rng = random.Random(5)
    rows, labels = [], []
    for _ in range(3000):
        some = {f for f in (1, 2) if rng.random() < 0.5} | set(rng.sample(range(10, 60), 6))
        rows.append(sorted(some))
        labels.append(float({1, 2} <= some))
    border = np.cumsum([0, *map(len, rows)])
    model = toxicity.learn(np.array(sum(rows, [])), border, np.array(labels))
    both, one = (model.scores(np.array(f), np.zeros(len(f), np.int64), 1)[0] for f in ([1, 2, 20], [1, 20]))
    assert both > 0.5 > one


def test_rare_pairs_count_beside_unrelated_toxic_rows():
    """Some twenty rows have both features of a pair; other toxic rows hide it from either."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(16_000):
        some, a, b, other = set(rng.integers(100, 3100, 40).tolist()), *(rng.random(3) < (0.05, 0.02, 0.05))
        rows.append(sorted(some | ({1} if a else set()) | ({2} if b else set()) | ({3} if other else set())))
        labels.append(float((a and b) or other))
    border = np.cumsum([0, *map(len, rows)])
    model = toxicity.learn(np.concatenate(rows), border, np.array(labels))

    def toxic(*features):
        texts = [np.array(sorted({*features, *rng.integers(100, 3100, 40).tolist()})) for _ in range(50)]
        return sum(model.scores(f, np.zeros(len(f), np.int64), 1)[0] >= 0.5 for f in texts)

    assert toxic(1, 2) >= 45 and toxic(3) >= 45 and toxic(1) + toxic(2) + toxic() <= 3


@pytest.fixture()
def taught(spark, odd):
    labels = [(i, int(i % 4 == 0)) for i in range(100, 400)] + [(1, None), (None, 1), (100, 1), (9999, 1), (101, 0)]
    docs = [(i, "a plain text about nothing" + (" you blockhead" if i % 4 == 0 else "")) for i in range(100, 400)]
    texts = odd.select("doc_id", "text").union(spark.createDataFrame(docs, "doc_id long, text string"))
    return toxicity.fit(texts, spark.createDataFrame(labels, "doc_id long, toxic int")), texts


def test_odd_rows(taught, odd):
    model, _ = taught
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 13 and all(0 <= r["score"] < 0.5 for r in rows)
    left = toxicity.without_toxic(odd, model)
    assert left.columns == odd.columns and left.count() == 13


def test_toxic_rows_go(taught):
    model, texts = taught
    left = {r[0] for r in toxicity.without_toxic(texts, model).select("doc_id").collect()}
    assert not any(i % 4 == 0 and i >= 100 for i in left if i is not None)
    assert all(i in left for i in range(100, 400) if i % 4)


def test_bounds_of_the_sample(spark, taught):
    _, texts = taught
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100, 400)], "doc_id long, toxic int")
    toxicity.fit(texts, labels, max_rows=50, max_terms=100)


def test_no_rows(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    assert all(r["score"] < 0.5 for r in toxicity.score(odd, model).collect())
    assert toxicity.score(none, toxicity.fit(none, labels)).collect() == []
