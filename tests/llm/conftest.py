import pytest
from pyspark.sql import functions as F


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns that clash with results."""
    rows = [
        (1, "a plain text of several words that say very little about it", "en"),
        (1, "a plain text of several words that say very little about it", "en"),
        (2, None, None),
        (3, "", "x"),
        (None, "another text without any key", "en"),
        (4, " \n\t ", "de"),
        (5, "w" * 100_000, "en"),
        (6, "word " * 40_000, "en"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    clash = ("score", "predicted", "fp", "root", "component_id", "fingerprint", "n_words", "_text", "_items", "_hits", "_w_fp", "key")
    return df.select("*", *[F.lit("clash").alias(c) for c in clash])
