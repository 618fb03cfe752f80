import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LINE = "The quick brown fox jumps over the lazy dog near the river bank today."


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"word{i} runs on." for i in range(60_000))
    rows = [
        (1, None, None, None, None),
        (None, LINE + "\n" + LINE.upper() + "\nmore text.", "en", "a", 10),
        (None, LINE + "\n" + LINE.upper() + "\nmore text.", "en", "a", 10),
        (2, "", "en", "a", 0),
        (3, " \n\t\n", "en", "b", 4),
        (4, long, "en", "b", len(long)),
        (5, LINE + "\n" + LINE.upper() + "\nother end.", "de", "b", 12),
        (6, LINE + "\n" + LINE.upper() + "\nother end.", None, None, 12),
        (6, LINE + "\n" + LINE.upper() + "\nother end.", None, None, 12),
        (7, "1234567 890 !!! ???", "fr", "c", 19),
    ]
    docs = frame(spark, rows)
    for extra in ("id", "h", "key", "fp", "gone", "chunk", "kept", "score", "__key", "__h", "__nth", "mix_slot", "skey", "bid"):
        docs = docs.withColumn(extra, F.lit("x"))
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
