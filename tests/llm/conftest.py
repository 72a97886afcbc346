from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
#: Columns that operators or queries make, or use on the way.
CLASHES = ["_k1", "_k2", "_row", "_text", "_key", "size", "target", "times", "count", "score", "_words", "_lines", "_hash", "class_id", "_spans", "n_links"]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [tuple(r) for r in documents.select("doc_id", "text").orderBy("doc_id").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows and ties, and extra columns with clashing names."""
    line = "a shared line with several words in it"
    rows = [
        (1, None, "en", "b", 0), (2, "", "en", "b", 0), (3, " \t\n\x0b ", None, None, None), (None, "a text without an id\nand two lines", "en", "a", 37),
        (None, None, None, None, None), (4, line, "en", "a", 8), (4, line, "en", "a", 8), (5, line + "\n" + line, "de", None, 8),
        (6, "\n".join(f"word{i} word{i + 1} and more of it {i % 7}" for i in range(4000)), "en", "c", 1), (7, "é" * 900 + "x", "fr", "c", 901),
        (8, "7" * 3000 + "@" + "+" * 50, "xx", "c", None), (9, "single", "en", "d", 6), (10, "single", "en", "d", 6), (11, "one two three four", "en", "a", 18)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)}).cache()
