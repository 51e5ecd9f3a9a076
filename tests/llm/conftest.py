import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"}
    session = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    import pyarrow.parquet as pq

    return pq.read_table(f"{SMALL}/documents.parquet").to_pylist()


ODD = [
    (1, None, None, None, None, 0),
    (2, "", "en", "s1", 0, 0),
    (3, " \t\r\n ", "en", "s1", 4, 0),
    (4, "one", "en", None, 3, 0),
    (5, "One two three", "en", "s1", 13, 0),
    (6, "one  two\tthree", "en", "s1", 13, 0),
    (7, "äé ÄÉ 漢字 \U0001f600 x y", "xx", "s2", 14, 0),
    (8, "word " * 30000, "en", "s2", 150000, 0),
    (9, "tail\nhead\n\ntail\n### !!", "en", "s2", 20, 0),
    (9, "tail\nhead\n\ntail\n### !!", "en", "s2", 20, 0),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank, short and long texts, a repeated row, and an extra column."""
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long, a long")


@pytest.fixture(scope="session")
def empty(spark, odd):
    return spark.createDataFrame([], odd.schema)
