"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def dedupe(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """First row per key by ``order``, then by the remaining columns, NULLs first.

    The remaining columns make the survivor reproducible where the order alone
    leaves it open. The filter on row number 1 lets Spark apply the group limit
    before the shuffle as well, so a key that fills a third of the table
    reaches the shuffle as one row per map task.
    """
    leading = order or []
    trailing = [c for c in df.columns if c not in keys and c not in leading]
    ranked = Window.partitionBy(*keys).orderBy(
        *[F.col(c).asc_nulls_first() for c in (*leading, *trailing)]
    )
    return (
        df.withColumn("_row", F.row_number().over(ranked)).where("_row = 1").drop("_row")
    )
