"""Language-model scores: the base against brute force, and what the model is worth."""

import math
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from watchfold.llm import lm, words


def plain(text):
    return [*(text or "").encode().lower().split(), None]


def is_held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 1


def check_base(docs, rows):
    counts = Counter(t for r in docs for t in plain(r[1]) if not is_held_out(r[0]))
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for doc_id, text in docs:
        own = plain(text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        expected.append((doc_id is None, doc_id or 0, len(own), sum(counts[t] > 0 for t in own), total, base))
    got = [
        (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])
        for r in rows
    ]
    for a, b in zip(sorted(got), sorted(expected), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


def test_base_scores_agree_with_brute_force(small, odd, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 64)  # so that most words take the way of rare ones
    docs = small.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = lm.score(docs, ~lm.held_out(F.col("doc_id"))).collect()
    check_base([(r[0], r[1]) for r in docs.collect()], rows)
    assert all(r["learn"] != is_held_out(r["doc_id"]) and r["score"] <= 0 for r in rows)


def test_the_model_beats_frequencies_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lm.score(docs, ~lm.held_out(F.col("doc_id"))).filter("not learn").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > 0.95 * rows[1]


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    weight = rng.normal(size=(lm.CONTEXTS, lm.CLASSES)).astype(np.float32)
    rows = np.repeat(rng.integers(0, lm.CONTEXTS, (4, 50)).astype(np.uint16), lm.CLASSES, axis=1)
    z = lm.class_log_probabilities(weight, np.zeros(lm.CLASSES, np.float32), rows, np.tile(np.arange(lm.CLASSES), 50))
    assert np.exp(z).reshape(50, -1).sum(1) == pytest.approx(np.ones(50), rel=1e-4)


def test_sums_of_rows():
    rng = np.random.default_rng(3)
    values, key = rng.integers(0, 9, (500, 4)).astype(np.float32), rng.zipf(1.5, 500).astype(np.uint16)
    used, times, sums = lm._row_sums(values, key)
    assert used.tolist() == sorted(set(key.tolist()))
    for k, n, total in zip(used, times, sums, strict=True):
        assert n == (key == k).sum() and total.tolist() == values[key == k].sum(0).tolist()


def test_training_learns_what_follows():
    rng = np.random.default_rng(2)
    learner = lm.Learner(np.zeros((lm.CONTEXTS, lm.CLASSES), np.float32), np.zeros(lm.CLASSES, np.float32))
    for _ in range(200):
        context = rng.integers(0, 5, 256).astype(np.uint16)
        learner.step(np.stack([context, context + 10, context + 20, context + 30]), context.astype(np.int64) + 7)
    rows = (np.arange(5) + 10 * np.arange(4)[:, None]).astype(np.uint16)
    z = lm.class_log_probabilities(learner.weight, learner.bias, rows, np.arange(5) + 7)
    assert (z > np.log(0.9)).all()


def test_index_finds_keys():
    keys = words.mix(np.arange(5000, dtype=np.uint64))
    index = lm.Index(keys)
    assert index.find(keys).tolist() == list(range(5000))
    assert (index.find(words.mix(np.arange(5000, 9000, dtype=np.uint64))) == -1).all()
    assert lm.Index(keys[:0]).find(keys[:3]).tolist() == [-1] * 3


def test_nothing_to_learn_from(odd, none):
    rows = lm.score(odd, F.lit(None).cast("boolean")).collect()
    assert len(rows) == 13 and all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in rows)
    assert lm.score(none, F.lit(True)).collect() == []


def test_packed_weights_come_back():
    rng = np.random.default_rng(4)
    weight = rng.normal(size=(lm._BLOCK_ROWS, lm.CLASSES)).astype(np.float32)
    used = rng.integers(0, 3, lm._BLOCK_ROWS).astype(np.float32)
    back = lm._used_weights(lm._packed(weight, used)).reshape(lm._BLOCK_ROWS, -1)
    assert back[:, -1].tolist() == used.tolist()
    some = used > 0
    assert np.abs(back[some, :-1] / used[some, None] - weight[some]).max() <= np.abs(weight).max() / 127
    assert (back[~some] == 0).all()


def test_every_pair_of_words_counts(spark):
    """More pairs of words than the table has rows, each with a follower of its own."""
    rng = np.random.default_rng(6)
    first, second = rng.integers(0, 320, (2, 2400, 150))
    third = (words.mix((first * 1000 + second).astype(np.uint64)) % np.uint64(16)).astype(int)
    rows = [
        (i, " ".join(f"a{a}x b{b}y {'cdefghijklmnopqr'[c]}" for a, b, c in zip(first[i], second[i], third[i], strict=True)))
        for i in range(2400)
    ]
    assert len({*zip(first.ravel(), second.ravel(), strict=True)}) > lm.CONTEXTS
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    rows = lm.score(docs, ~lm.held_out(F.col("doc_id"))).filter("not learn").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > 0.77 * rows[1]  # 0.85 by the table alone


def test_counts_of_rare_words_and_pairs_agree_with_brute_force():
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):
        route = int(rng.integers(0, 30))  # even routes are words, with pairs of their own
        pair = route if route % 2 else 100 + 10 * route + int(rng.integers(0, 4))
        rows.append((route, pair, i % 50, 7, bool(rng.random() < 0.7), int(rng.integers(-1, 3)), float(np.log(rng.random()))))
    rows.sort()
    names = [c.split()[0] for c in lm._CLASSED.split(", ")]
    table = pa.table({n: list(x) for n, x in zip(names, zip(*rows, strict=True), strict=True)})
    one, two = (np.linspace(a, 9, lm._SIZES) for a in (1, 2))
    got = [x for b in lm._weighed(iter(table.to_batches(max_chunksize=17)), one, two) for x in b.column("class_score").to_pylist()]
    for (route, pair, _, _, _, cls, logs), score in zip(rows, got, strict=True):
        p = math.exp(logs)
        if cls >= 0:
            for place, key, strength in ((0, route, one), (1, pair, two)):
                seen = [r[5] for r in rows if r[place] == key and r[4] and r[5] >= 0]
                if seen and (place or route != pair):
                    weight = strength[int(math.log2(len(seen)))]
                    p = (seen.count(cls) + weight * p) / (len(seen) + weight)
        assert score == pytest.approx(math.log(p))


def test_blended_probabilities_sum_to_one():
    rng = np.random.default_rng(8)
    p, n = rng.dirichlet(np.ones(lm.CLASSES)), rng.integers(0, 4, lm.CLASSES)
    strength = np.full(lm._SIZES, 3.0)
    total = np.full(lm.CLASSES, n.sum())
    assert lm.blended(p, n, total, strength).sum() == pytest.approx(1)
    assert (lm.blended(p, n * 0, total * 0, strength) == p).all()
    assert (lm.blended(p, n, total, np.full(lm._SIZES, np.inf)) == p).all()


def test_small_weights_travel_beside_large_ones():
    weight = np.zeros((lm._BLOCK_ROWS, lm.CLASSES), np.float32)
    weight[5, :2] = 4.0, 0.01
    used = np.zeros(lm._BLOCK_ROWS, np.float32)
    used[5] = 1
    assert (lm._used_weights(lm._packed(weight, used)).reshape(lm._BLOCK_ROWS, -1)[5, :-1] == weight[5]).all()


def test_gains_leave_each_token_out_of_its_counts():
    rng = np.random.default_rng(12)
    total = rng.integers(1, 40, 300)
    n, p = rng.integers(1, total + 1), rng.random(300)
    got = lm.gains(p, n, total)
    for k in range(lm._SIZES):
        some = [(q, a - 1, b - 1) for q, a, b in zip(p, n, total, strict=True) if b > 1 and int(math.log2(b - 1)) == k]
        assert got[k, -1] == len(some)
        for strength, gain in zip(lm._STRENGTHS, got[k, :-1], strict=True):
            each = [math.log(q if np.isinf(strength) else (a + strength * q) / (b + strength)) for q, a, b in some]
            assert gain / lm._GAIN_STEPS == pytest.approx(sum(each), rel=1e-4, abs=1e-3)


def test_all_training_tokens_decide_what_counts_weigh(spark, monkeypatch):
    rng = np.random.default_rng(13)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 500) % 9000)) for i in range(700)]
    seen, strengths = [], lm.strengths
    monkeypatch.setattr(lm, "strengths", lambda *args: seen.append(args) or strengths(*args))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    lm.score(docs, ~lm.held_out(F.col("doc_id")))
    one, two = Counter(), Counter()
    for doc_id, text in rows:
        own = [None, None, *text.split()]
        if not is_held_out(doc_id):
            one.update(own[1:])
            two.update(zip(own, own[1:], strict=False))
    for (gain,), context in zip(seen, (one, two), strict=True):
        assert sum(context.values()) > 270_000  # more than a sample of 2**18
        assert gain[:, -1].sum() == sum(n for n in context.values() if n > 1)


def test_packed_tokens_come_back():
    rng = np.random.default_rng(14)
    chunk, expected = lm._Chunk(), Counter()
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 20, size)) for size in (0, 50, 3, 400)]
    frequent = words.Words(np.arange(0, 8, 2), np.arange(2, 10, 2), np.array([0, 4]))
    head = np.unique(words.hash_words(np.frombuffer(b"w1w2w3w4", np.uint8), frequent))
    vocabulary = lm.Vocabulary(head, np.arange(4) + 1, np.full(1 << 16, 30), np.empty(0, np.uint64))
    for piece, data in lm._pieces(pa.record_batch({"text": pa.array(texts)})):
        t = lm.tokens(data, piece.offsets, vocabulary)
        c = lm.contexts(t, vocabulary)
        c.two_place = np.where((c.one_place >= 0) & (c.two % np.uint64(2) == 0), 5, -1)
        logs = -rng.integers(1, 2048 * 20, len(t.cls)) / 2048
        learn = np.array([True, False, True, True])
        chunk.add(pa.array([7, None, 9, 10]), np.arange(4), learn, t, c, logs)
        for x in zip(t.row, t.cls, learn[t.row], logs, c.one_place, strict=True):
            expected[tuple(float(y) for y in x)] += 1
    rows = [SimpleNamespace(**r) for b in chunk.packed("a", 5) for r in b.to_pylist()]
    got = Counter()
    for part in range(5):
        tokens, _ = lm._in_order(r for r in rows if r.part == part)
        kinds, slots = lm._kinds(tokens)
        doc = np.concatenate([d for _, d in slots] or [np.empty(0)])
        for t in kinds:
            for x in zip(doc[t.slot], t.cls, t.learn, np.log(t.p), t.cls * 0 - 1 if t.one is None else t.one, strict=True):
                got[tuple(round(float(y) * 2048) / 2048 for y in x)] += 1
    assert got == expected
    (docs,) = [r for r in rows if r.kind == 3]
    assert docs.n == sum(expected.values()) and np.frombuffer(docs.keys, np.int64).tolist() == [7, 0, 9, 10]


def test_tokens_stay_as_python_packed_them(spark, monkeypatch):
    """The shuffle of tokens, which is read three times, has what Python wrote; texts may be no valid UTF-8."""
    seen, plain_shuffle = [], RDD.partitionBy
    monkeypatch.setattr(RDD, "partitionBy", lambda self, n, *args: seen.append(n) or plain_shuffle(self, n, *args))
    texts = [b"a b c \xff\xfe b", b"\xc3 a b", b"", b"a b a b", b"c \xff\xfe"]
    docs = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts * 4)], "doc_id long, text binary")
    rows = lm.score(docs.withColumn("text", F.col("text").cast("string")), ~lm.held_out(F.col("doc_id"))).collect()
    assert seen[0] == spark.sparkContext.defaultParallelism
    tokens = {i: [*t.split(), None] for i, t in enumerate(texts * 4)}
    counts = Counter(t for i, own in tokens.items() if not is_held_out(i) for t in own)
    total, distinct = sum(counts.values()), len(counts)
    assert len(rows) == len(tokens) and all(r["score"] < 0 for r in rows)
    for r in rows:
        own = tokens[r["doc_id"]]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        assert (r["n_tokens"], r["base_score"]) == (len(own), pytest.approx(base, rel=1e-9))


def test_batches_have_all_rows(monkeypatch):
    monkeypatch.setattr(lm, "_BATCH_BYTES", 40)
    monkeypatch.setattr(lm, "_BATCH_ROWS", 3)
    rows = [(None if i == 4 else i, b"x" * (i * i % 50), i % 2 == 0) for i in range(30)]
    batches = list(lm._batches(iter(rows)))
    got = [(a, b.encode(), c) for x in batches for a, b, c in zip(*(c.to_pylist() for c in x.columns), strict=True)]
    assert got == rows and max(len(b) for b in batches) == 3 and min(len(b) for b in batches) < 3


def test_a_step_follows_the_gradient():
    """Over more tokens and rows than are worked on at once."""
    rng = np.random.default_rng(15)
    n = 2 * lm._CACHED + 100
    weight, bias = (rng.normal(size=s).astype(np.float32) for s in ((lm.CONTEXTS, lm.CLASSES), lm.CLASSES))
    rows = np.stack([np.where(rng.random(n) < 0.5, rng.integers(0, 9, n), rng.integers(9, 9000, n)) + 10_000 * k for k in range(4)])
    cls = rng.integers(0, lm.CLASSES, n)
    learner = lm.Learner(weight, bias)
    learner.step(rows.astype(np.uint16), cls)
    z = weight[rows].sum(0, dtype=np.float64) + bias
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    assert lm.class_log_probabilities(weight, bias, rows.astype(np.uint16), cls) == pytest.approx(np.log(p[np.arange(n), cls]), abs=1e-4)
    p[np.arange(n), cls] -= 1
    for own in rows:
        used, times = np.unique(own, return_counts=True)
        slope = np.zeros((lm.CONTEXTS, lm.CLASSES))
        np.add.at(slope, own, p)
        assert np.abs(learner.weight[used] - (weight[used] - slope[used] / times[:, None])).max() < 1e-4
        assert (learner.used[used] == times).all()


def test_sorts_of_single_numbers():
    rng = np.random.default_rng(16)
    route, other, rest = rng.integers(-50, 50, 3000) << 40, rng.integers(0, 1 << 32, 40)[rng.integers(0, 40, 3000)], rng.integers(0, 128, 3000)
    key = route << 7 | rest
    order = lm._by_route(key, other)
    assert sorted(order.tolist()) == list(range(3000))
    rows = list(zip(key[order] >> 7, other[order], key[order] & 127, strict=True))
    assert rows == sorted(rows)
    keys = rng.integers(0, 500, 2000).astype(np.uint64)
    some, at, n = lm._distinct(keys)
    assert (some == np.unique(keys)).all() and (keys[at] == some).all() and (n == np.unique(keys, return_counts=True)[1]).all()
    assert [len(x) for x in lm._distinct(keys[:0])] == [0, 0, 0]
