"""Rule-based churn labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.money import money_avg
from tallyloom.schemas import GOLD, conform

# Days of inactivity.
CHURN_DAYS = 60
RISK_LEVELS = [(30, "Low"), (60, "Medium"), (90, "High")]
TOP_RISK = "Critical"


def customer_churn_labels(
    features: DataFrame,
    churn_days: int = CHURN_DAYS,
    risk_levels: list[tuple[int, str]] = RISK_LEVELS,
    top_risk: str = TOP_RISK,
) -> DataFrame:
    days = F.col("recency_days")
    risk = F
    for limit, label in risk_levels:
        risk = risk.when(days <= limit, label)
    return conform(
        features.select(
            "customer_unique_id",
            "last_order_date",
            days.alias("days_since_last_order"),
            F.when(days > churn_days, 1).otherwise(0).alias("is_churned"),
            risk.otherwise(top_risk).alias("churn_risk_level"),
            F.col("frequency").alias("total_orders"),
            F.col("monetary").alias("total_spend"),
        ),
        GOLD["customer_churn_labels"],
    )


def share_of_total(df: DataFrame, key: str, count_name: str = "customer_count") -> DataFrame:
    """Rows per key and their percentage of all rows.

    The total is a subquery of one row, so keys may have any number of values.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    share = F.col(count_name) * F.lit(100.0) / total
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias(count_name))
        .withColumn("percentage", F.round(share, 2))
    )


def churn_rate(labels: DataFrame) -> DataFrame:
    return share_of_total(labels, "is_churned")


def churn_value(labels: DataFrame) -> DataFrame:
    """Customers and mean lifetime spend by churn flag."""
    return labels.groupBy("is_churned").agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(money_avg(F.col("total_spend")), 2).alias("avg_lifetime_value"),
    )
