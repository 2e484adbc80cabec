"""Tokens per document, counted through distinct pre-tokens.

A pre-token is a run between ASCII white space: the tokenizer never joins across it, so
that the tokens of a text are the sum over its pre-tokens. Pieces are counted once per
distinct pre-token and summed by the frequencies of each document; ids are not kept.

The most frequent pre-tokens, at most ``HEAD`` many, are counted first and sent to all
tasks. The occurrences of the others, which are none too frequent each, meet their
pre-token in one shuffle as (document, pre-token, frequency) and come back as sums.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import repeat

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from watchfold.llm.graphs import most_frequent, stored
from watchfold.session import ship

#: Most pre-tokens whose piece counts are sent to all tasks.
HEAD = 1 << 19
#: A task forgets its rarest pre-tokens beyond so many while it looks for frequent ones.
_HELD = 1 << 20

_WORK = "doc_id long, text_hash long, pretoken binary, n long, bytes long, copies int"

_tokenizers: dict[str, Tokenizer] = {}


def _tokenizer(definition: Broadcast) -> Tokenizer:
    text = definition.value
    if text not in _tokenizers:
        _tokenizers[text] = Tokenizer.from_str(text)
    return _tokenizers[text]


def piece_counts(tokenizer: Tokenizer, pretokens: list[bytes]) -> list[int]:
    """Number of pieces of each pre-token."""
    encoded = tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in pretokens], add_special_tokens=False)
    return [len(x) for x in encoded]


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in pc.fill_null(batch.column("text").cast(pa.large_binary()), b""):
        yield text.as_py()


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pre-tokens that may be among the most frequent: in some task they are one of four
    times HEAD occurrences. Missing one costs time and changes no count."""
    counts: Counter[bytes] = Counter()
    total, floor = 0, 1
    for batch in batches:
        for text in _texts(batch):
            found = text.split()
            total += len(found)
            counts.update(found)
            while len(counts) > _HELD:
                floor += 1
                counts = Counter({k: n for k, n in counts.items() if n >= floor})
    least = max(2, total // (4 * HEAD))
    often = [(k, n) for k, n in counts.items() if n >= least]
    yield pa.record_batch(
        {"pretoken": pa.array([k for k, _ in often], pa.binary()), "n": pa.array([n for _, n in often], pa.int64())}
    )


def _pieces(batches: Iterator[pa.RecordBatch], definition: Broadcast) -> Iterator[pa.RecordBatch]:
    tokenizer = _tokenizer(definition)
    for batch in batches:
        counts = piece_counts(tokenizer, batch.column("pretoken").to_pylist())
        yield pa.record_batch({"pretoken": batch.column("pretoken"), "pieces": pa.array(counts, pa.int64())})


def _frequencies(batches: Iterator[pa.RecordBatch], head: Broadcast) -> Iterator[pa.RecordBatch]:
    """A row per document with the pieces of its frequent pre-tokens, and a row for each
    other distinct pre-token of the document."""
    known = head.value
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        columns: list[list] = [[] for _ in range(6)]

        def flush(columns=columns) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
            names = [x.split()[0] for x in _WORK.split(", ")]
            out = pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
            for c in columns:
                c.clear()
            return out

        for doc_id, text in zip(ids, _texts(batch), strict=True):
            counts = Counter(text.split())
            rest = [x for x in counts if x not in known]
            pieces = sum(n * known[x] for x, n in counts.items() if x in known)
            text_hash = xxhash.xxh32_intdigest(text)  # tells texts of one doc_id apart
            size = len(rest)
            row = [
                [doc_id, *repeat(doc_id, size)],
                [text_hash, *repeat(text_hash, size)],
                [None, *rest],
                [pieces, *(counts[x] for x in rest)],
                [len(text), *repeat(0, size)],
                [1, *repeat(0, size)],
            ]
            for column, values in zip(columns, row, strict=True):
                column.extend(values)
            if len(columns[0]) > 100_000:
                yield flush()
        if columns[0]:
            yield flush()


def _counted(batches: Iterator[pa.RecordBatch], definition: Broadcast) -> Iterator[pa.RecordBatch]:
    """Frequencies times pieces; equal pre-tokens follow one another."""
    tokenizer = _tokenizer(definition)
    for batch in batches:
        pretokens = batch.column("pretoken").dictionary_encode()
        pieces = pa.array(piece_counts(tokenizer, pretokens.dictionary.to_pylist()), pa.int64())
        each = pc.fill_null(pieces.take(pretokens.indices), 1) if len(pieces) else pa.array([1] * len(batch), pa.int64())
        out = batch.drop_columns(["pretoken", "n"])
        yield out.append_column("tokens", pc.multiply(batch.column("n"), each))


def token_counts(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` for every row of ``docs`` (doc_id, text).

    ``tokenizer_file`` is a definition of the tokenizers library that splits at white
    space; begin, end and padding are not added, and special strings inside texts are
    single tokens. Null counts as the empty text: no bytes and no tokens. Equal rows get
    equal results; rows that share a doc_id but not the text are counted each for itself.
    Extra columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark, "watchfold")
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seen = docs.select("text").mapInArrow(_frequent, "pretoken binary, n long")
    seen = stored(seen.groupBy("pretoken").agg(F.sum("n").alias("n")), "pretokens")
    often = most_frequent(seen, HEAD).select("pretoken")
    table = often.mapInArrow(partial(_pieces, definition=definition), "pretoken binary, pieces long").toArrow()
    head = spark.sparkContext.broadcast(dict(zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True)))
    work = docs.mapInArrow(partial(_frequencies, head=head), _WORK)
    # a document's own row may go anywhere: copies of one text to different tasks
    own = F.col("pretoken").isNull()
    place = F.when(own, F.xxhash64("doc_id", "text_hash")).otherwise(F.xxhash64("pretoken"))
    work = work.repartition(place).sortWithinPartitions("pretoken")
    counted = work.mapInArrow(
        partial(_counted, definition=definition), "doc_id long, text_hash long, bytes long, copies int, tokens long"
    )
    found = counted.groupBy("doc_id", "text_hash").agg(
        F.sum("copies").cast("int").alias("copies"), F.max("bytes").alias("n_bytes"), F.sum("tokens").alias("tokens")
    )
    # equal rows have added up their equal tokens
    found = found.select("doc_id", "n_bytes", F.expr("tokens div copies").alias("n_tokens"), "copies")
    return found.select("doc_id", "n_bytes", "n_tokens", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")
