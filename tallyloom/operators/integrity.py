"""Keys across tables: duplicates and references that lead nowhere."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
    )


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent, with the child rows that hold them.

    A NULL key matches nothing and is an orphan. Child rows are counted per key
    before the anti join, on the same key, so a frequent key is one row there.
    """
    return (
        child.groupBy(key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .join(parent.select(key), key, "left_anti")
    )


def key_profile(holders: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows per key and table: one column per entry of ``holders``.

    One shuffle with map-side combining answers every duplicate and orphan
    question about the key, in place of one aggregate and two sides of a join
    for each.
    """
    names = list(holders)
    tagged = [
        df.select(key, *[F.lit(int(n == name)).cast("long").alias(n) for n in names])
        for name, df in holders.items()
    ]
    together = reduce(DataFrame.unionByName, tagged)
    return together.groupBy(key).agg(*[F.sum(n).alias(n) for n in names])


def profile_duplicates(name: str) -> Column:
    """Aggregate over ``key_profile``: keys the table holds more than once."""
    return F.count_if(F.col(name) > 1)


def profile_orphans(child: str, parent: str, key: str) -> Column:
    """Aggregate over ``key_profile``: child rows without a parent row."""
    unmatched = F.col(key).isNull() | (F.col(parent) == 0)
    return F.coalesce(F.sum(F.when(unmatched, F.col(child))), F.lit(0).cast("long"))
