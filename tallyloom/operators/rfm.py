"""Recency, frequency and monetary value of customers, scores and segments."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.text import to_date
from tallyloom.functions.money import money_avg, money_merge, money_value
from tallyloom.operators.ranking import Ranking, global_ntile
from tallyloom.schemas import GOLD, conform

# Segment rules as (label, R scores, F scores, M scores), each an
# inclusive range of 1 to 5. The first rule that fits decides. "Cannot Lose
# Them" is always preceded by "At Risk" and never reached; it is kept because
# the order of the rules is part of their definition.
SEGMENT_RULES = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (4, 5), (2, 5), (1, 5)),
    ("Potential Loyalists", (3, 5), (3, 5), (1, 5)),
    ("New Customers", (4, 5), (1, 1), (1, 5)),
    ("Promising", (3, 5), (1, 2), (3, 5)),
    ("Customers Needing Attention", (2, 2), (2, 5), (1, 5)),
    ("About to Sleep", (2, 2), (1, 2), (1, 5)),
    ("At Risk", (1, 2), (4, 5), (1, 5)),
    ("Cannot Lose Them", (1, 1), (4, 5), (1, 5)),
    ("Hibernating", (1, 2), (1, 2), (1, 5)),
]
OTHER_SEGMENT = "Lost"


def _day() -> Column:
    return to_date("dt")


def last_order_day(orders: DataFrame) -> Column:
    """Latest day over orders of every status, as a scalar subquery."""
    return orders.select(F.max(_day())).scalar()


def rfm_base(
    totals: DataFrame,
    customers: DataFrame,
    orders: DataFrame,
    reference_date: datetime.date | None = None,
) -> DataFrame:
    """Per customer: recency, order count, spend, first and last day.

    ``totals`` is ``order_totals``. Its rows are added up per customer_id before
    the join, on the join's key, which costs no shuffle of its own and keeps a
    customer_id shared by many orders from piling up in one task.
    """
    per_id = totals.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("frequency"),
        F.min(_day()).alias("first_order_date"),
        F.max(_day()).alias("last_order_date"),
        *money_merge("price"),
    )
    per_customer = (
        per_id.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.sum("frequency").alias("frequency"),
            F.min("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date"),
            *money_merge("price"),
        )
    )
    today = last_order_day(orders) if reference_date is None else F.lit(reference_date)
    spend = money_value("price")
    return per_customer.select(
        "customer_unique_id",
        F.datediff(today, F.col("last_order_date")).alias("recency_days"),
        F.col("frequency").cast("int").alias("frequency"),
        spend.alias("monetary"),
        "first_order_date",
        "last_order_date",
        (spend / F.col("frequency")).alias("avg_order_value"),
    )


def rfm_segment(r: str = "r_score", f: str = "f_score", m: str = "m_score") -> Column:
    label = F
    for name, *ranges in SEGMENT_RULES:
        fits = F.lit(True)
        for column, (low, high) in zip((r, f, m), ranges):
            if (low, high) != (1, 5):
                fits = fits & F.col(column).between(low, high)
        label = label.when(fits, name)
    return label.otherwise(OTHER_SEGMENT)


def rfm_scores(base: DataFrame, **limits: int) -> DataFrame:
    """Fifths by recency, frequency and spend, ties broken by customer.

    ``base`` is read several times and should be stored. ``limits`` are passed
    to ``global_ntile``.
    """
    tie = "customer_unique_id"
    return global_ntile(
        base,
        {
            "r_score": Ranking("recency_days", tie, descending=True),
            "f_score": Ranking("frequency", tie),
            "m_score": Ranking("monetary", tie),
        },
        k=5,
        **limits,
    )


def rfm_features(base: DataFrame, **limits: int) -> DataFrame:
    """Scores and segment per customer; ``base`` should be stored."""
    scored = rfm_scores(base, **limits)
    return conform(scored.withColumn("rfm_segment", rfm_segment()), GOLD["rfm_features"])


def segment_distribution(features: DataFrame) -> DataFrame:
    return (
        features.groupBy("rfm_segment")
        .agg(F.count(F.lit(1)).alias("customer_count"))
        .orderBy(F.desc("customer_count"), "rfm_segment")
    )


def segment_spend(features: DataFrame) -> DataFrame:
    """Customers and mean spend per segment."""
    return (
        features.groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.round(money_avg(F.col("monetary")), 2).alias("avg_spend"),
        )
        .orderBy(F.desc("customers"), "rfm_segment")
    )
