import duckdb
import pytest

from tallyloom.llm.tables import ship_package

DATA = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "conversations")
#: Names that the operators use inside, as columns of the input.
CLASHES = {
    "id": 1, "node": 2, "own": 3, "words": "w", "label": "l", "score": 0.5, "component": 4, "low": 5, "kept": True,
    "lang_pred": "p", "__source": "mine", "__id": 6, "__text": "t", "n_sentences": 7, "of": 8, "repeated": "r", "rank": 9, "weight": 1.5,
}


@pytest.fixture(scope="session")
def shipped(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def second():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


@pytest.fixture(scope="session")
def docs(shipped):
    """Documents from (doc_id, text[, lang, source]) with columns of clashing names."""
    from pyspark.sql import functions as F

    def build(*rows):
        whole = [(*row, *(None,) * (4 - len(row))) for row in rows]
        frame = shipped.createDataFrame(whole, "doc_id long, text string, lang string, source string")
        return frame.repartition(3).withColumns({name: F.lit(value) for name, value in CLASHES.items()})

    return build


@pytest.fixture(scope="session")
def stored(second):
    """Whole texts of the smallest table by id."""
    return dict(second.sql("SELECT doc_id, text FROM documents").fetchall())
