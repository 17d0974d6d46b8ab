"""How Parquet files of the store are written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StringType


def plain_ids(df: DataFrame) -> dict[str, str]:
    """Writer options for ids and amounts without a dictionary: nearly each value is another one, and each would
    be looked up before the writer gives up the dictionary."""
    return {
        f"parquet.enable.dictionary#{field.name}": "false"
        for field in df.schema.fields
        if field.dataType == DoubleType() or (field.dataType == StringType() and field.name.endswith("_id"))
    }
