"""Row counts and headline numbers of a layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def layer_row_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """(layer, table_name, row_count), one row per table of every layer."""
    parts = [
        row_counts(tables).select(F.lit(layer).alias("layer"), "table_name", "row_count")
        for layer, tables in layers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def gold_headlines(
    daily_kpi: DataFrame, retention: DataFrame, features: DataFrame, labels: DataFrame
) -> DataFrame:
    """Days, cohorts, customers and churned customers as (metric, days)."""
    figures = [
        ("Daily KPIs", daily_kpi, F.count(F.lit(1))),
        ("Total Cohorts", retention, F.count_distinct("cohort_month")),
        ("RFM Customers", features, F.count(F.lit(1))),
        ("Churned Customers", labels, F.sum("is_churned")),
    ]
    parts = [
        df.agg(figure.alias("days")).select(F.lit(name).alias("metric"), "days")
        for name, df, figure in figures
    ]
    return reduce(DataFrame.unionByName, parts)


def date_range(orders: DataFrame) -> DataFrame:
    """First day, last day and number of distinct days of the orders."""
    return orders.agg(
        F.min("dt").alias("min_date"),
        F.max("dt").alias("max_date"),
        F.count_distinct("dt").alias("distinct_days"),
    )
