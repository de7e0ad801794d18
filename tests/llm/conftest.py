import duckdb
import pytest

TABLES = ("documents", "benchmark", "pages", "labels")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def odd_rows():
    """Nulls, empty and long texts, repeated rows and ids, and copies of each."""
    long = " ".join(f"word{i % 997} and the" for i in range(9000))
    clean = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen."
    return [
        (1, clean, "en"),
        (2, clean, "en"),
        (2, clean, "en"),
        (3, clean.replace(" ", "\n "), None),
        (4, None, None),
        (5, "", "en"),
        (6, " \t\n", "en"),
        (None, clean, "en"),
        (None, None, None),
        (7, long, "en"),
        (8, long + " end", "en"),
        (9, "short", "en"),
        (10, "a b c d", "en"),
        (11, "été Été 語彙 👍 one two", "fr"),
    ]


@pytest.fixture
def odd(spark):
    """``odd_rows`` with columns whose names the operators use inside."""
    schema = "doc_id long, text string, lang string"
    df = spark.createDataFrame(odd_rows(), schema)
    for name in ("id", "key", "h", "n", "words", "path", "token", "size", "_sha", "_node", "_key", "_id", "rid", "shard"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture
def empty(odd):
    return odd.limit(0)
