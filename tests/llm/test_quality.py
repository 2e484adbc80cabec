"""Quality: counts against plain Python, distances, and which documents stay."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchfold.llm import quality


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    runs = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    often = Counter(runs)
    covered = {i + k for i, run in enumerate(runs) if often[run] > 1 for k in range(8)}
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [
    "a b c\n\na b c\n \n \nx",
    "one two three four five six seven eight nine one two three four five six seven eight nine ten",
    "r " * 40,
    "## é😀|<b> $5 & more\r\nü\tz",
    "\x1c \x85 a",
    "",
    None,
    "repeat this line of eight words right here\n" * 5,
]


@pytest.fixture()
def tables(spark, small, odd):
    texts = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    return texts.unionByName(small.select("doc_id", "text", "lang")).unionByName(odd.select("doc_id", "text", "lang"))


def test_counts_agree_with_plain_python(tables):
    rows = quality.quality(tables, quality.references(tables)).collect()
    for (text,), r in zip(tables.select("text").collect(), rows, strict=True):
        counts = plain(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (r["base_failed"] and r["kept"])


def test_distances_agree_with_plain_python(small):
    known = quality.references(small)
    rows = {r["doc_id"]: r for r in quality.quality(small, known).collect()}
    texts = [r for r in small.select("doc_id", "text", "lang").collect() if r["lang"] == "en"]
    words = Counter(w for r in texts for w in r["text"].encode().lower().split())
    top = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[: quality.COMMON_WORDS]]

    def spread(counts):
        total = sum(counts.values())
        part = [counts[w] / total for w in top]
        return [*part, 1 - sum(part)]

    def distance(p, q):
        def one(x, y):
            return sum(a * math.log2(2 * a / (a + b)) for a, b in zip(x, y, strict=True) if a > 1e-15)

        return math.sqrt(max(0.0, (one(p, q) + one(q, p)) / 2))

    reference = spread(words)
    for r in texts[:40]:
        own = Counter(r["text"].encode().lower().split())
        if sum(own.values()) >= quality.LEAST_WORDS:
            assert rows[r["doc_id"]]["word_distance"] == pytest.approx(distance(spread(own), reference), abs=1e-6)


def test_jensen_shannon_ends():
    p = np.array([[1.0, 0.0], [0.5, 0.5]])
    assert quality.jensen_shannon(p, np.array([[0.0, 1.0], [0.5, 0.5]])).tolist() == [1.0, 0.0]


def test_junk_goes_and_prose_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.quality(docs, quality.references(docs)).join(labels, "doc_id").filter("not base_failed and n_words >= 100")
    kept = {(r["quality"], r["kept"]): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    assert kept.get((1, False), 0) <= 0.01 * kept[(1, True)]
    assert kept[(0, False)] >= kept.get((0, True), 0)


def test_rare_languages_have_their_own_reference(spark):
    english = [(i, f"some words in row {i % 7} of a common language, " * 20, "en") for i in range(3000)]
    foreign = [(9000 + i, f"мало слов на {i % 2} языке, " * 20, "ru") for i in range(2)] + [(9100, "ΩΨ " * 100, None)]
    schema = "doc_id long, text string, lang string"
    docs = spark.createDataFrame(english + foreign, schema)
    alone = spark.createDataFrame(foreign, schema)
    found = {r["doc_id"]: r for r in quality.quality(docs, quality.references(docs)).filter("doc_id >= 9000").collect()}
    own = {r["doc_id"]: r for r in quality.quality(alone, quality.references(alone)).collect()}
    assert found == own and len(own) == 3
    assert all(r["character_distance"] < 0.1 for r in own.values())


def test_unknown_languages_are_judged_by_the_base_rules(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(90)), "xx"), (2, "too few", "xx")], "doc_id long, text string, lang string")
    known = quality.references(docs.withColumn("lang", F.lit("en")))
    rows = {r["doc_id"]: r for r in quality.quality(docs, known).collect()}
    assert rows[1]["kept"] and not rows[2]["kept"]
    assert rows[1]["character_distance"] is None and rows[1]["word_distance"] is None


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(quality, "MOST_LANGUAGES", 2)
    docs = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", None)], "text string, lang string")
    assert len(quality.references(docs.filter("lang is not null")).languages) == 2
    with pytest.raises(ValueError, match="languages"):
        quality.references(docs)


def test_no_rows(none):
    assert quality.quality(none, quality.references(none)).collect() == []
