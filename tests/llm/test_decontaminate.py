"""Benchmark passages against a search of every window in every text."""

import re

import pytest

from watchfold.llm import decontaminate


def word_list(text):
    fold = {c: c + 32 for c in range(65, 91)}
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(fold))


def brute(text, items, window=10):
    """Hit word numbers and items of a text."""
    found, hit, named = word_list(text), set(), set()
    for item_id, item in items:
        own = word_list(item)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            for at in range(len(found) - size + 1):
                if found[at : at + size] == own[i : i + size]:
                    hit.update(range(at, at + size))
                    if item_id is not None:
                        named.add(str(item_id))
    return hit, sorted(named)


PASSAGE = "the quick brown Fox jumps over 13 lazy dogs and runs away, far away"
ITEMS = [
    (1, PASSAGE),
    (1, PASSAGE),
    (2, "Ünïcode wörds — only four"),
    (3, None),
    (4, ""),
    (5, "?!"),
    (10, "fox jumps over 13 lazy dogs and runs away far"),
    (None, "an item without id has ten words in it as well"),
]
TEXTS = [
    (1, "So. THE QUICK brown-fox jumps over 13 lazy dogs & runs away!"),
    (2, "the quick brown fox jumps over 13 lazy dogs and then"),
    (3, f"{PASSAGE} {PASSAGE}; ünïcode wörds only four times"),
    (4, None),
    (5, ""),
    (6, "Say: an item without id has ten words in it as well."),
    (7, "foxjumps over 13 lazy dogs and runs away far"),
    (8, "é" * 3000 + " " + PASSAGE.upper() + " " + "z " * 20000),
    (8, "é" * 3000 + " " + PASSAGE.upper() + " " + "z " * 20000),
    (None, "runs. Fox jumps over 13 lazy dogs and runs away far"),
]


@pytest.fixture()
def tables(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("*", "'x' as spans", "1 as items")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "0 as doc_id")


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 16])
def test_spans_and_items_agree_with_brute_force(tables, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    docs, benchmark = tables
    rows = decontaminate.scan(docs, benchmark).collect()
    assert len(rows) == len(TEXTS)
    for (doc_id, text), row in zip(TEXTS, rows, strict=True):
        hit, named = brute(text, ITEMS)
        assert row["doc_id"] == doc_id and row["n_words"] == len(word_list(text))
        assert {w for s in row["spans"] for w in range(s["word"], s["word"] + s["words"])} == hit
        assert row["items"] == named
        for s in row["spans"]:  # offsets lead back to the same words of the original text
            assert word_list(text[s["start"] : s["end"]]) == word_list(text)[s["word"] : s["word"] + s["words"]]


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 16])
def test_only_hit_documents_go(tables, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    docs, benchmark = tables
    left = decontaminate.decontaminate(docs, benchmark)
    assert left.columns == docs.columns
    clean = [t for _, t in TEXTS if not brute(t, ITEMS)[0]]
    assert sorted(r["text"] or "" for r in left.collect()) == sorted(t or "" for t in clean)


def test_empty_tables(spark, odd, none):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(odd, benchmark).count() == 13
    assert all(r["spans"] == [] for r in decontaminate.scan(odd, benchmark).collect())
    assert decontaminate.scan(none, spark.createDataFrame(ITEMS, "item_id long, text string")).collect() == []
