"""Phrases against a plain count of all runs of words."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchfold.llm import phrases, words


def brute(rows, least=10, most=2000):
    """(text, lang) -> sorted result rows."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fold)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for size in (1, 2, 3):
                f[lang].update(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in often.items():
            if any(100 * b >= 50 * a for q, b in often.items() if len(q) > len(p) and p in (q[:2], q[1:])):
                continue
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), a, counts[p[:k]], counts[p[k:]], score))
        for rank, (_, _, phrase, a, left, right, score) in enumerate(sorted(ranked)[:most], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n[lang], score))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def docs(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


ODD = [
    (None, None),
    ("", "en"),
    (" \t\n.,;:!?", "en"),
    ("a b " * 30, None),
    ("a b " * 20, "und"),
    ("New York, new york. NEW YORK is new york " * 12, "en"),
    ("New York, new york. NEW YORK is new york " * 12, "en"),
    ("one two three\tfour é😀 \x00x " * 15, ""),
    ("x" * 5000 + " next " * 12, "fr"),
    (("y" * 2000 + " near ") * 12, "fr"),
]


@pytest.mark.parametrize("head", [phrases.HEAD, 3, 0])
def test_odd_texts_agree_with_brute_force(spark, head):
    table = docs(spark, ODD).withColumns({n: F.lit("x") for n in ("key", "word", "n", "rank", "w1")})
    assert found(table.repartition(3), head=head) == brute(ODD)


@pytest.mark.parametrize("head", [phrases.HEAD, 40])
def test_given_documents_agree_with_brute_force(spark, small, head):
    rows = [(r["text"], r["lang"]) for r in small.select("text", "lang").collect()]
    assert found(small, head=head) == brute(rows)


def test_ties_are_ordered_by_bytes_and_cut_at_the_limit(spark):
    rows = [(f"{w}1 {w}2.", "en") for w in ("b", "é", "a", "Z", "z", "\U0001f600", "￮") for _ in range(11)]
    assert found(docs(spark, rows), most=4) == brute(rows, most=4)
    assert [r[2] for r in found(docs(spark, rows))] == [r[2] for r in brute(rows)]


def test_counts_of_thirteen_digits_stay_exact(spark):
    a, left, right = 9_999_999_999_999, 9_999_999_999_999, 99_999_999_999_998
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(phrases._score(F.col("a"), F.col("l"), F.col("r")))
    assert row.first()[0] == 1_000_000 * a * a // (left * right)


def test_tasks_that_write_out_often_and_many_shards_change_nothing(spark, small, monkeypatch):
    rows = [(r["text"], r["lang"]) for r in small.select("text", "lang").collect()]
    monkeypatch.setattr(phrases, "SHARD_ENTRIES", 1 << 10)
    assert found(small) == brute(rows)
    data = np.frombuffer(rows[0][0].encode(), np.uint8)
    head = phrases._Head(np.empty(0, np.uint64), np.empty(0, np.int64), np.full(phrases.MARKS // 8, 255, np.uint8))
    zero, salts = np.zeros(1, np.int64), np.zeros(1, np.uint64)
    _, keys = phrases._phrase_keys(data, np.array([0, len(data)]), salts, zero, head)

    def total(held, distinct):
        monkeypatch.setattr(phrases, "_HELD", held)
        monkeypatch.setattr(phrases, "_DISTINCT", distinct)
        counter, batches = phrases._Counter(3, 4), []
        for i in range(0, len(keys), 50):
            batches += counter.add(keys[i : i + 50])
        batches.append(counter.flush())
        filters = [(s, x) for b in batches for s, x in zip(b.column("shard").to_pylist(), b.column("filter").to_pylist(), strict=True)]
        return len(batches), [phrases.quotient.merge([x for t, x in filters if t == s], s) for s in sorted({s for s, _ in filters})]

    (many, often), (single, once) = total(300, 150), total(1 << 20, 1 << 20)
    assert many > 2 and single == 1
    for (k, n), (k2, n2) in zip(often, once, strict=True):
        assert (k == k2).all() and (n == n2).all()


@pytest.mark.parametrize("text", ["aa bb cc dd " * 500, "a, b c. " * 400, "x" * 900 + " y " * 300, "w " * 3 + "v" * 4000, " " * 3000 + "a b", "q"])
def test_long_texts_are_cut_without_loss(text):
    data = np.frombuffer(text.encode(), np.uint8)
    for size in (40, 97):
        runs, ones = Counter(), Counter()
        for low, high, again in phrases.segments(data, 0, len(data), size):
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text[low:high]):
                ws = piece.split()
                ones.update(ws[again:])
                for n in (2, 3):
                    runs.update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1) if i + n - 1 >= again)
                again = 0
        want, words_ = Counter(), Counter()
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = piece.split()
            words_.update(ws)
            for n in (2, 3):
                want.update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
        assert ones == words_ and runs == want


def test_a_long_text_counts_like_its_pieces(spark):
    text = "alpha beta gamma delta " * 150_000
    assert len(text) > 2 * words.PIECE_BYTES
    assert found(docs(spark, [(text, "en")])) == brute([(text, "en")])


def test_no_rows(spark):
    assert found(docs(spark, [])) == [] and found(docs(spark, [(None, None)])) == []
