"""Token counts against the library on whole texts."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from watchfold.llm import token_counts

FILE = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "It's we'll THE o'clock, don't!! 12345 x9y",
    "<|startoftext|>a<|endoftext|> <|STARTOFTEXT|> <|endoftext|",
    "é ́leading  nbsp em\u0085nel\x1cfs ΣΑΣ Σ İ ŉ ﬁ 😀😀 中文 का",
    "tab\tnew\nline\r\n  spaces   ",
    "",
    None,
    "x" * 20_000,
    "word " * 30_000,
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(FILE)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False))


def test_counts_agree_with_the_library(spark, small, odd, plain, monkeypatch):
    monkeypatch.setattr(token_counts, "HEAD", 64)  # so that most pre-tokens take the way of rare ones
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    docs = texts.unionByName(texts).unionByName(small.select("doc_id", "text")).unionByName(odd.select("doc_id", "text"))
    got = sorted(
        ((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in token_counts.token_counts(docs, FILE).collect())
    )
    assert got == sorted(
        (r[0] is None, r[0] or 0, len((r[1] or "").encode()), plain(r[1])) for r in docs.collect()
    )


def test_no_rows(none):
    assert token_counts.token_counts(none, FILE).collect() == []
