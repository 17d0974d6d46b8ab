import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__sql__adaptive__coalescePartitions__initialPartitionNum="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tallyloom-tests-"),
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="tallyloom-tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """DataFrame from a schema text and tuples, spread over several partitions."""

    def build(schema, data):
        return spark.createDataFrame(data, schema).repartition(3)

    return build


@pytest.fixture(scope="session")
def raw(rows):
    """Raw table of an entity; columns that are not named are empty text."""
    from tallyloom.schemas import RAW_COLUMNS

    def build(entity, *data):
        columns = RAW_COLUMNS[entity]
        schema = ", ".join(f"{c} string" for c in columns)
        return rows(schema, [tuple(d.get(c, "") for c in columns) for d in data])

    return build
