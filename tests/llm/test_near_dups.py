"""Near-duplicates against brute force over all pairs of full sets."""

import random

import numpy as np
from pyspark.sql import functions as F

from watchfold.llm import near_dups, words


def shingles(text):
    fold = {c: c + 32 for c in range(65, 91)}
    found = (text or "").translate(fold).encode().split()
    return {tuple(found[i : i + 5]) for i in range(max(len(found) - 4, min(len(found), 1)))}


def brute(rows):
    """(doc_id, text) rows -> doc_id: component, by joining whatever is linked."""
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in rows}
    changed = True
    pairs = [
        (a, b) for a, x in sets for b, y in sets if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def found(docs, **options):
    return {r["doc_id"]: r for r in near_dups.near_duplicates(docs, **options).collect()}


def variants(size, families, changes, first):
    """Families of texts with a few words changed, at similarities around the threshold."""
    rng = random.Random(size)
    rows = []
    for family in range(families):
        base = [f"s{size}f{family}w{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(8):
            text = list(base)
            for _ in range(rng.randrange(changes)):
                text[rng.randrange(size)] = f"z{rng.randrange(10**6)}"
            rows.append((first + len(rows), " ".join(text)))
    return rows


def test_components_agree_with_brute_force(spark):
    rows = []
    for size, changes in ((6, 3), (12, 4), (60, 6), (400, 30)):
        rows += variants(size, 12, changes, len(rows))
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {i: r["component_id"] for i, r in got.items()} == brute(rows)
    assert all(r["n_shingles"] == len(shingles(t)) for (i, t), r in zip(rows, [got[i] for i, _ in rows], strict=True))


def test_given_documents_agree_with_brute_force(small):
    rows = [(r[0], r[1]) for r in small.select("doc_id", "text").collect()]
    got = found(small)
    assert {i: r["component_id"] for i, r in got.items()} == brute(rows)


def test_links_that_do_not_meet_at_the_smallest_member(spark, monkeypatch):
    """A chain of texts and a block size of 4: links beyond the star are found in blocks."""
    monkeypatch.setattr(near_dups, "BLOCK", 4)
    words_ = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(words_[4 * i : 4 * i + 60])) for i in range(20)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {i: r["component_id"] for i, r in got.items()} == brute(rows)
    assert {r["component_id"] for r in got.values()} == {0}


def test_odd_rows(odd):
    rows = near_dups.near_duplicates(odd).collect()
    assert len(rows) == 13
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"]
    assert by_id[8]["component_id"] == 7
    for alone in (3, 4, 5):
        assert by_id[alone]["n_shingles"] == 0 and by_id[alone]["component_id"] == alone and by_id[alone]["kept"]
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    left = near_dups.without_near_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted((r[0] is None, r[0]) for r in left.collect() if r[0] is not None) == [
        (False, i) for i in (1, 3, 4, 5, 6, 7, 9, 10, 11)
    ]
    assert left.filter("doc_id is null").count() == 1


def test_no_rows(none):
    assert near_dups.near_duplicates(none).collect() == []
    assert near_dups.without_near_duplicates(none).collect() == []


def test_estimates_are_close_to_the_similarity():
    rng = np.random.default_rng(1)
    for shared, own in ((600, 100), (300, 300), (0, 500)):
        both = rng.integers(0, 2**63, shared, dtype=np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 2**63, own, dtype=np.uint64)]) for _ in range(2))
        regs = [near_dups.registers(words.mix(x), np.zeros(len(x), np.int64), 1) for x in (a, b)]
        equal = ((regs[0] == regs[1]) & (regs[0] > 0)).sum(1)
        used = ((regs[0] > 0) | (regs[1] > 0)).sum(1)
        size = np.array([shared + own])
        assert abs(near_dups.estimate(equal, used, size, size)[0] - shared / (shared + 2 * own)) < 0.15


def test_the_plan_has_no_product(small):
    result = near_dups.near_duplicates(small.withColumn("n", F.lit(1)))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_dropping_keeps_one_row_of_each_component(spark, odd, none):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(i, base if i % 4 == 0 else f"{base} tail{i % 3}" if i % 4 == 1 else f"text number {i} stands alone here") for i in range(200)]
    rows += [(3, rows[3][1]), (0, base), (None, base), (None, "no id"), (500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as bits", "1 as bucket", "2 as kept")
    found = near_dups.near_duplicates(docs.select("doc_id", "text")).collect()
    kept = {r["doc_id"] for r in found if r["kept"] and r["doc_id"] is not None}
    left = near_dups.without_near_duplicates(docs).collect()
    assert sorted(r["doc_id"] for r in left if r["doc_id"] is not None) == sorted(kept)
    assert sum(r["doc_id"] is None for r in left) == 2
    texts = dict(rows)
    assert all(r["text"] == texts[r["doc_id"]] and r["bits"] == "x" for r in left if r["doc_id"] is not None)
    assert near_dups.without_near_duplicates(none).collect() == []
    assert len(near_dups.without_near_duplicates(odd).collect()) == len({r["doc_id"] for r in near_dups.near_duplicates(odd).collect() if r["kept"]})
