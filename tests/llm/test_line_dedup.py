"""Repeated passages against a plain walk over all windows."""

import pytest

from watchfold.llm import line_dedup


def brute(rows):
    """(doc_id, text) rows in order -> texts without later windows of three lines."""
    seen, out = set(), {}
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [i for i, x in enumerate(lines) if x.encode().strip()]
        gone = set()
        for a, b, c in zip(kept, kept[1:], kept[2:], strict=False):
            window = tuple(lines[i].encode().strip() for i in (a, b, c))
            if window in seen:
                gone.update(range(a, c + 1))
            seen.add(window)
        out[doc_id] = (None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    return out


ROWS = [
    (1, "a\nb\nc\nd\ne"),
    (2, "x\nb\n c \n\nd\ny"),
    (3, "a\nb\nc\nd\ne"),
    (4, "q\nq\nq\nq\nq"),
    (5, "q\nq"),
    (6, None),
    (7, ""),
    (8, "\n\n\n"),
    (9, "z\na\nb\nc\nnew\nb\nc\nd\nend"),
    (10, "\n".join(f"line {i % 700}" for i in range(5000))),
]


@pytest.mark.parametrize("partitions", [1, 4])
def test_texts_agree_with_brute_force(spark, partitions):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(partitions)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.without_repeated_lines(docs).collect()}
    assert got == brute(ROWS)


def test_given_documents_agree_with_brute_force(small):
    rows = sorted((r[0], r[1]) for r in small.select("doc_id", "text").collect())
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.without_repeated_lines(small).collect()}
    assert got == brute(rows)


def test_odd_rows(odd, none):
    rows = line_dedup.without_repeated_lines(odd).collect()
    assert len(rows) == 13
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["text"] is None and by_id[3]["n_lines"] == 0
    assert by_id[10]["n_removed"] == 0 and by_id[11]["text"] == "or\nless" and by_id[11]["n_removed"] == 3
    assert [r["n_removed"] for r in rows if r["doc_id"] == 1] == [0, 0]
    assert line_dedup.without_repeated_lines(none).collect() == []
