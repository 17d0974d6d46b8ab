"""Equality joins in which a few keys hold a large part of one side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key with more than this share of all rows is cut into pieces of the share; one with fewer
#: rows than the number is not.
SHARE, LEAST_ROWS = 1e-4, 1_000


def hot_keys(
    rows: DataFrame, on: list[str], share: float = SHARE, least: int = LEAST_ROWS
) -> DataFrame:
    """The keys with more than ``share`` of all rows, and the pieces to cut each into (``_pieces``).

    There are fewer than 1 / ``share`` of them, and fewer than twice as many pieces, whatever the size of
    the table and however its keys are spread: that bound lets the list be broadcast. Null keys join
    nothing and are left out.
    """
    return pieces(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")), on, "_rows", share, least)


def pieces(
    counted: DataFrame, on: list[str], rows: str, share: float = SHARE, least: int = LEAST_ROWS
) -> DataFrame:
    """As ``hot_keys``, of keys that are counted already in the column ``rows``; it is read twice."""
    part = F.greatest(counted.agg(F.sum(rows)).scalar() * share, F.lit(least))
    return (
        counted.dropna(subset=on)
        .select(*on, F.ceil(F.col(rows) / part).cast("int").alias("_pieces"))
        .where(F.col("_pieces") > 1)
    )


def hot_key_join(
    large: DataFrame,
    small: DataFrame,
    on: list[str],
    hot: DataFrame,
    apart: list[str],
    how: str = "inner",
) -> DataFrame:
    """``large.join(small, on, how)`` for how ``inner`` or ``left``, with the keys of ``hot`` cut into pieces.

    Rows of a hot key of ``large`` are dealt by the columns ``apart``, which should tell rows of one key
    apart; the rows of ``small`` with that key are repeated for each piece, and no others are. All
    other keys have one piece. A row's piece depends on its values alone, so a task that runs again
    deals alike. Neither adaptive execution nor a size on disk is needed.
    """
    if how not in ("inner", "left"):
        raise ValueError("rows of the small side are repeated: the join must be inner or left")
    hot = F.broadcast(hot)
    count = F.coalesce("_pieces", F.lit(1))
    dealt = large.join(hot, on, "left").withColumn(
        "_piece", F.when(F.col("_pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64(*apart), count)).cast("int")
    )
    repeated = small.join(hot, on, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), count - 1))
    )
    joined = dealt.drop("_pieces").join(repeated.drop("_pieces"), [*on, "_piece"], how)
    return joined.drop("_piece")
