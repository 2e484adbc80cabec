"""Shards: a permutation, no gaps, and the same shuffle however rows are laid out."""

from collections import defaultdict

import numpy as np
import pytest

from watchfold.llm import shards


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutes(n):
    there = shards.permute(np.arange(n), n, 1)
    assert sorted(there) == list(range(n))
    if n >= 1000:
        assert (there != shards.permute(np.arange(n), n, 2)).any()
        assert abs(np.corrcoef(np.arange(n), there)[0, 1]) < 0.1


def check(rows, count):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(count)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(count))


def test_shards_of_documents(small, monkeypatch):
    monkeypatch.setattr(shards, "BUCKET_ROWS", 16)
    rows = small.select("doc_id", "n_chars")
    first = shards.shard(rows, 7).collect()
    check(first, 7)
    again = shards.shard(rows.repartition(5), 7).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    assert {tuple(r)[:2] for r in first} == {tuple(r) for r in rows.collect()}


def test_odd_rows(odd, none):
    rows = shards.shard(odd, 3)
    assert sorted(rows.columns) == sorted(odd.columns)
    found = rows.collect()
    assert len(found) == 13
    check(found, 3)
    assert shards.shard(none, 3).collect() == []


def test_many_equal_rows(spark):
    rows = spark.range(1000).selectExpr("1 as doc_id", "2 as size").unionByName(spark.range(500).selectExpr("id as doc_id", "3 as size"))
    check(shards.shard(rows, 24).collect(), 24)
