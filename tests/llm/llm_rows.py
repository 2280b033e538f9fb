import pytest

LONG = "lorem ipsum dolor sit amet " * 4000


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with nulls in every column, empty and long texts, repeated rows, and columns named like internal ones."""
    words = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs away", "en", "a", 1),
        (1, "The quick brown fox jumps over the lazy dog and runs away", "en", "a", 1),
        (2, words, "en", None, 2),
        (3, words, "de", "b", None),
        (None, words + " tail", None, "b", 4),
        (4, None, "en", "a", 5),
        (5, "", "en", "a", 6),
        (None, None, None, None, None),
        (6, " \n\t ", "de", "a", 7),
        (7, "12345 !!! ???", "de", "a", 8),
        (8, LONG, "en", "a", 9),
        (-9, "ein kurzer Satz über nichts", "de", "c", 10),
        (1 << 62, "é", "de", "c", 11),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in ("_k1", "_k2", "node", "root", "row", "rank", "_bucket", "shard", "slot", "hits", "item_id", "_text"):
        docs = docs.selectExpr("*", f"'x' as {name}")
    return docs


@pytest.fixture(scope="module")
def none(spark, odd):
    return odd.limit(0)
