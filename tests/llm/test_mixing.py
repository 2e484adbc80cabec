"""Mixing: targets, the schedule's digits, and what every document gives."""

from collections import defaultdict

import numpy as np
import pytest

from watchfold.llm import mixing


def plain_targets(sizes, weights):
    total, capped = sum(sizes), {}
    while True:
        rest = total - sum(capped.values())
        open_ = [i for i in range(len(sizes)) if i not in capped]
        share = {i: weights[i] * rest / sum(weights[j] for j in open_) for i in open_} if open_ else {}
        above = [i for i in open_ if share[i] > 3 * sizes[i]]
        if not above:
            return [capped.get(i, share.get(i)) for i in range(len(sizes))]
        capped.update({i: 3.0 * sizes[i] for i in above})


@pytest.mark.parametrize("sizes", [[100], [10, 10, 10], [1, 1000, 5, 80], [0, 7, 0, 90], [3] * 9, [100000, 1, 1, 1]])
def test_targets(sizes):
    weights = [1 + k % 3 for k in range(len(sizes))]
    found = mixing.targets(sizes, weights)
    assert found == pytest.approx(plain_targets(sizes, weights))
    assert sum(found) == pytest.approx(sum(sizes))


def test_points_below():
    points = mixing.van_der_corput(np.arange(300))
    for x in (0, 1, 1 << 50, (1 << 51) + 12345, (1 << 52) // 3, (1 << 52) - 1, 1 << 52):
        n = np.arange(301)
        got = mixing.points_below(n, np.full(301, x, np.int64))
        assert got.tolist() == [int((points[:k] < x).sum()) for k in range(301)]


def test_schedule_meets_targets():
    size, target = np.array([95, 0, 300, 31]), np.array([190, 0, 150, 86])
    plan = mixing.Schedule(size, target, 10)
    source, block, take = plan.at(np.arange(plan.slots))
    assert np.bincount(source, take, 4).tolist() == target.tolist()
    for s in range(4):
        uses = np.bincount(block[(source == s) & (take > 0)])
        assert len(uses) == 0 or uses.max() - uses.min() <= 1


@pytest.mark.parametrize("block_words", [16, 1024])
def test_mix_of_documents(small, monkeypatch, block_words):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(mixing, "_BUCKET_ROWS", 8)
    rows = mixing.mix(small).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    order = sorted(sizes)
    expected = plain_targets([sizes[s] for s in order], [1 + k % 3 for k in range(len(order))])
    assert [target[s] for s in order] == pytest.approx(expected)
    assert all(abs(taken[s] - target[s]) <= 1 and r["source_size"] for s in order)
    again = mixing.mix(small.repartition(3)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mixed_rows(small):
    rows = mixing.mix(small).collect()
    copies = sum(round(r["taken"] / r["size"]) for r in rows if r["size"])
    mixed = mixing.mixed(small)
    assert mixed.columns == small.columns
    assert abs(mixed.count() - copies) <= 2


def test_few_texts_meet_the_table_of_copies(small, odd, monkeypatch):
    sure, held = mixing._with_copies(small, "copy")
    assert sure.count() > 0.8 * small.count() and sure.count() + held.count() == small.count()
    expected = [sorted(map(str, mixing.mixed(x).collect())) for x in (small, odd)]
    taken = {(r["doc_id"], r["row_hash"]): round(r["taken"] / r["size"]) if r["size"] else 0 for r in mixing.mix(small).collect()}
    assert len(expected[0]) == sum(taken.values())
    for marks in (1, 16):  # nearly all places are shared
        monkeypatch.setattr(mixing, "MARKS", marks)
        sure, held = mixing._with_copies(small, "copy")
        assert held.count() > sure.count()
        assert [sorted(map(str, mixing.mixed(x).collect())) for x in (small, odd)] == expected


def test_odd_rows(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == 13
    assert all(r["taken"] == 0 for r in rows if r["doc_id"] in (3, 4, 5))
    null = [r for r in rows if r["source"] is None]
    assert [(r["doc_id"], r["source_size"]) for r in null] == [(2, 10)]
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mixed(odd).count() >= 1
    assert mixing.mix(none).collect() == [] and mixing.mixed(none).collect() == []


def test_too_many_sources(small, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
    with pytest.raises(ValueError, match="sources"):
        mixing.mix(small)
