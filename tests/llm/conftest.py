import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small(spark):
    """Documents of sf0.001."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns."""
    long = " ".join(f"w{i % 977}x{i // 977}" for i in range(60_000))
    rows = [
        (1, "One two three four five six seven eight nine ten.", "en", "a", 1),
        (1, "One two three four five six seven eight nine ten.", "en", "a", 1),
        (2, "one two three four five six seven eight nine ten.", "en", None, None),
        (3, None, "en", "b", 0),
        (4, "", None, "b", 0),
        (5, " \n\t ", "xx", "", 3),
        (6, "short", "en", "a", 5),
        (7, long, "en", "b", len(long)),
        (8, long + " end", "en", "b", len(long)),
        (None, "A row without an id has a text all the same, é😀.", None, "c", None),
        (9, "x" * 50_000, "en", "c", 50_000),
        (10, "same\nlines\nhere\nand\nmore", "en", "c", 1),
        (11, "same\nlines\nhere\nor\nless", "en", "c", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("kept", "shard", "slot", "score", "size", "count", "copies", "number", "spans", "component_id", "place", "n"):
        docs = docs.selectExpr("*", f"'extra' as {name}")
    return docs


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
