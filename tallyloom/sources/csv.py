"""The CSV scan of landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.schemas import RAW_COLUMNS, raw_schema

# The declared CSV format. Columns are matched by position; landed
# files have no header, delivered ones have.
CSV_FORMAT = {"header": "false", "sep": ",", "quote": '"', "escape": "\\"}

#: Text that is packed: lines of ids and times shrink to a fifth, of amounts to less than a half. Packed files are read as a
#: whole by one task, so their rows are bounded.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000}


def empty_for_null(df: DataFrame) -> DataFrame:
    """Empty fields as empty text; the CSV reader reports them as NULL."""
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns])


def read_raw(spark: SparkSession, bronze: str, entity: str, **options: str) -> DataFrame:
    """All columns of an entity as text; ``options`` override the CSV format."""
    scan = spark.read.schema(raw_schema(entity)).options(**{**CSV_FORMAT, **options})
    return empty_for_null(scan.csv(f"{bronze.rstrip('/')}/{entity}"))


def write_raw(df: DataFrame, path: str, **options: object) -> None:
    """Export text columns in the same format with a header, blanks and empty fields as they are.

    ``options`` are those of the writer, such as ``PACKED``.
    """
    exact = {
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    df.write.options(**{**CSV_FORMAT, "header": "true"}, **exact, **options).csv(path)


def read_bronze(spark: SparkSession, bronze: str) -> dict[str, DataFrame]:
    return {entity: read_raw(spark, bronze, entity) for entity in RAW_COLUMNS}
