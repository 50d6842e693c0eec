import duckdb
import pytest
from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Stored steps go below pytest's own folder."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def tables(sf_dir):
    """Rows of a table as Python dicts."""

    def read(name):
        found = duckdb.sql(f"SELECT * FROM '{sf_dir}/{name}.parquet'")
        return [dict(zip(found.columns, row)) for row in found.fetchall()]

    return read


@pytest.fixture
def make_docs(spark):
    """documents with an extra column named like an operator's own, from (doc_id, text, lang, source)."""

    def make(rows, extra="fp"):
        full = [(i, t, lang, source, None if t is None else len(t), "x") for i, t, lang, source in rows]
        return spark.createDataFrame(full, f"{DOCS}, {extra} string")

    return make


EDGES = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, "one two three four five six", None, None),
    (3, "one two three four five six", None, None),
    (4, "One  two\tthree\nfour five SIX", "de", "b"),
    (None, "no id here at all, just words", "fr", None),
    (5, "tail " * 30_000, "en", "a"),
    (6, "one two three four five six", "en", "b"),
]


@pytest.fixture
def edge_docs(make_docs):
    """Null and empty texts, a very long one, repeated rows, nulls in every column."""
    return make_docs(EDGES)


@pytest.fixture
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([Row(doc_id=i, quality=int(i != 5), toxic=int(i == 6)) for i in range(1, 7)])
