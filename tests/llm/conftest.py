import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["fp", "size", "taken", "row", "id", "words", "n", "score", "group", "line", "key", "label", "range", "node",
            "pos", "first", "kind", "row_id", "row_hash", "predicted", "text_hash", "component_id", "kept_0", "rest", "class"]


def with_clashing_columns(df):
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING if c not in df.columns])


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, extra columns."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000)) + "\n" + "z" * 50_000 + "\n" + "a b\n" * 3000
    rows = [(1, "one two three four five six\nsame line of several words here", "en", "a", 10),
            (2, None, "en", "a", None), (3, "", None, "b", 0), (4, "   \n\t \n", "de", None, 6),
            (5, long_text, "en", "b", len(long_text)), (None, "text without an id but words enough", "en", "c", 3),
            (None, None, None, None, None), (6, "same line of several words here", "fr", "c", 1),
            (6, "same line of several words here", "fr", "c", 1), (7, "same line of several words there", "fr", "c", 1),
            (8, "mail a.b@example.com, +1 (974) 555-3436 and 10.0.0.255 \U0001f600 4111 1111 1111 1111", "es", "a", 9)]
    return with_clashing_columns(spark.createDataFrame(rows, DOCS))


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)


@pytest.fixture(scope="session")
def some_labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (5, 1, 0), (6, 0, 1), (8, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
