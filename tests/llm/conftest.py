import pytest


@pytest.fixture(scope="session")
def documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()
    return sorted((r["doc_id"], r["text"], r["source"]) for r in rows)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _text string, size int, label string, `_key` int"


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, long and repeated texts, null columns, and extra columns with names that operators use inside."""
    words = " ".join(f"w{i % 97}x{i * i % 89}" for i in range(30_000))
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, words, "en", "b", len(words)),
        (5, passage, "en", "a", 1), (5, passage, "en", "a", 1), (6, "x " + passage + " y", "en", None, 1), (None, passage, None, "b", None),
        (7, "Ünïcödé é 　   word", "de", "c", 9), (8, "one", "en", "c", 3), (9, "one", "en", "c", 3), (10, "a " * 200, "en", "c", 400),
    ]
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
