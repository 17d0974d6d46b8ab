"""Monthly cohorts: when customers first bought and when they came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.text import month_of, months_between
from tallyloom.operators.kpi import DELIVERED
from tallyloom.schemas import GOLD, conform


def monthly_activity(
    orders: DataFrame, customers: DataFrame, status: str = DELIVERED
) -> DataFrame:
    """Distinct (customer, month) pairs with an order of the status.

    Orders are reduced to a set of months per customer_id before the join, and
    to one per customer after it. The sets are combined before each shuffle and
    hold a month once, so they stay small for a customer of any size. Both the
    join and what follows per customer find the rows where they already are.
    """
    months = (
        orders.where(F.col("order_status") == status)
        .select("customer_id", month_of("dt").alias("month"))
        .groupBy("customer_id")
        .agg(_month_set("month"))
    )
    people = customers.select("customer_id", "customer_unique_id")
    return (
        months.join(people, "customer_id")
        .select("customer_unique_id", F.explode_outer("months").alias("month"))
        .groupBy("customer_unique_id")
        .agg(_month_set("month"))
        .select("customer_unique_id", F.explode_outer("months").alias("activity_month"))
    )


def _month_set(name: str) -> Column:
    """Distinct months; a set leaves NULL out, so an order without a month is one of its own."""
    whole = F.collect_set(name)
    missing = F.array(F.lit(None).cast("string"))
    return F.when(F.count_if(F.col(name).isNull()) > 0, F.concat(whole, missing)).otherwise(
        whole
    ).alias("months")


def customer_cohorts(activity: DataFrame) -> DataFrame:
    """First active month of each customer."""
    return activity.groupBy("customer_unique_id").agg(
        F.min("activity_month").alias("cohort_month")
    )


def cohort_retention(activity: DataFrame) -> DataFrame:
    """Active customers per cohort and month, from ``monthly_activity``.

    A customer's cohort is the minimum over their own months, a window over at
    most one row per month. Every customer is active in their cohort month, so
    the cohort's size is the count of that month and needs neither a second
    aggregate of the customers nor a join. A customer without an id counts
    towards the size but never as active, as an equality join would have it.
    """
    own_months = Window.partitionBy("customer_unique_id")
    own_cohort = Window.partitionBy("cohort_month")
    counted = (
        activity.withColumn("cohort_month", F.min("activity_month").over(own_months))
        .groupBy("cohort_month", "activity_month")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.count("customer_unique_id").alias("active_customers"),
        )
    )
    first_month = F.col("activity_month") == F.col("cohort_month")
    sized = counted.withColumn(
        "cohort_size", F.max(F.when(first_month, F.col("members"))).over(own_cohort)
    )
    return conform(
        sized.where("active_customers > 0")
        .withColumn("months_since_cohort", months_between("cohort_month", "activity_month"))
        .withColumn("retention_rate", F.col("active_customers") / F.col("cohort_size")),
        GOLD["cohort_retention"],
    )


def cohort_curve(retention: DataFrame, cohort_month: str) -> DataFrame:
    """Retention in percent of one cohort by months since its start."""
    return (
        retention.where(F.col("cohort_month") == cohort_month)
        .select(
            "cohort_month",
            "months_since_cohort",
            F.round(F.col("retention_rate") * 100, 1).alias("retention_pct"),
        )
        .orderBy("months_since_cohort")
    )
