import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, shard int"


@pytest.fixture(scope="session")
def sf(spark):
    """Tables of the smallest data set."""
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, an empty and a very long text, equal and repeated rows, and columns with clashing names."""
    long = " ".join(f"wort{i % 997} satz{i}." for i in range(30000))
    same = "One two three four five six seven eight nine ten. Eleven twelve."
    rows = [(1, same, "en", "a", 3, "x", 9), (2, same, "en", "a", 3, "x", 9), (2, same, "en", "a", 3, "x", 9), (3, "", "en", None, 0, None, None), (4, None, None, "b", None, None, None), (None, "no id here", "de", "b", 5, "x", 1), (None, None, None, None, None, None, None), (5, long, "de", "b", len(long), "x", 1), (6, "!!! 123 é中\U0001f600", "fr", "c", 1, "x", 1), (7, "\t\n ", "fr", "c", 1, "x", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
