import pytest

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"wörd{i % 977}" for i in range(60_000))
SPEECH = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix jugs of liquid oxygen "

# Nulls everywhere, empty, blank and very long texts, ties, repeated rows.
ODD = [
    (1, SPEECH * 8, "en", "a", 800),
    (2, SPEECH * 8, "en", None, 800),
    (2, SPEECH * 8, "en", None, 800),
    (3, None, "de", "b", 0),
    (4, "", None, "b", 0),
    (5, " \t\n\x0b\x0c\r ", None, None, 7),
    (None, None, None, None, None),
    (None, "short", "en", "a", 5),
    (6, LONG, "de", "b", len(LONG)),
    (7, LONG[:200_000] + " end", "de", "b", 200_004),
    (8, "Ünïcödé 漢字 🙂 123 " * 3, "fr", "ß", 54),
    (9, "x" * 300_000, "fr", "\U0001f642", 300_000),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOC).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")
