"""Daily sales figures over delivered orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.money import money_merge, money_parts, money_value
from tallyloom.operators.hot_join import LEAST_ROWS, SHARE, hot_key_join, hot_keys
from tallyloom.schemas import GOLD, conform

DELIVERED = "delivered"


def order_totals(
    orders: DataFrame, order_items: DataFrame, status: str = DELIVERED
) -> DataFrame:
    """One row per order of the status that has items, with its item sums.

    Items are added up per order before the join, on the join's own key: the
    aggregate and the join share one shuffle, and an order holding a large part
    of all items is combined on the map side.
    """
    per_order = order_items.groupBy("order_id").agg(
        F.count("order_item_id").alias("item_count"),
        *money_parts(F.col("price"), "price"),
        *money_parts(F.col("freight_value"), "freight"),
    )
    return (
        orders.where(F.col("order_status") == status)
        .select("order_id", "customer_id", "dt")
        .join(per_order, "order_id")
    )


def daily_kpi(totals: DataFrame, unique_by: str = "customer_id") -> DataFrame:
    """Figures per day from ``order_totals``.

    Orders are unique there, so the order count is a plain count and the only
    distinct count left is that of ``unique_by``, which avoids the row
    expansion of two distinct counts in one group.
    """
    daily = totals.groupBy("dt").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_distinct(unique_by).alias("unique_customers"),
        F.sum("item_count").alias("total_items"),
        *money_merge("price"),
        *money_merge("freight"),
    )
    return conform(
        daily.select(
            "dt",
            "order_count",
            money_value("price").alias("gmv"),
            (money_value("price") / F.col("order_count")).alias("avg_order_value"),
            "unique_customers",
            "total_items",
            (F.col("total_items") / F.col("order_count")).alias("avg_items_per_order"),
            money_value("freight").alias("total_freight"),
        ),
        GOLD["daily_kpi"],
    )


def daily_kpi_by_category(
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    status: str = DELIVERED,
    unknown: str = "unknown",
    share: float = SHARE,
    least: int = LEAST_ROWS,
) -> DataFrame:
    """Figures per day and category; an order counts once in each of its categories.

    The category is looked up first. Best-selling products, those of more than ``share``
    of all items and ``least`` of them, are counted and cut into pieces, so that no task gets all items of one,
    with or without adaptive execution. Items are
    then combined per order and category, so neither the join to orders nor the
    daily aggregate sees more than one row per pair.
    """
    category = F.coalesce("product_category_english", F.lit(unknown))
    items = order_items.select("order_id", "product_id", "order_item_id", "price")
    best_sellers = hot_keys(items.select("product_id"), ["product_id"], share, least)
    catalogue = products.select("product_id", "product_category_english")
    per_order = (
        hot_key_join(items, catalogue, ["product_id"], best_sellers, ["order_id", "order_item_id"], "left")
        .groupBy("order_id", category.alias("category"))
        .agg(
            F.count("order_item_id").alias("item_count"),
            *money_parts(F.col("price"), "price"),
        )
    )
    daily = (
        orders.where(F.col("order_status") == status)
        .select("order_id", "dt")
        .join(per_order, "order_id")
        .groupBy("dt", "category")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("item_count").alias("item_count"),
            *money_merge("price"),
        )
    )
    return conform(
        daily.withColumn("gmv", money_value("price")), GOLD["daily_kpi_by_category"]
    )


def orders_of_days(orders: DataFrame, days: DataFrame) -> DataFrame:
    """Orders of the days in a table of days (``dt``).

    Of orders stored by day only the partitions of these days are read, although no day is known when the
    query is planned: a small table of days is broadcast, and its values prune the scan.
    """
    return orders.join(days.select("dt"), "dt", "left_semi")


def month_ends(orders: DataFrame) -> DataFrame:
    """A table of the days with orders: dt, month and last_dt, the last such day of the month.

    ``dt = last_dt`` picks the last days. A comparison, unlike a flag, tells Spark that the filter is
    worth pruning another table by.
    """
    days = orders.select("dt").distinct().withColumn("month", F.substring("dt", 1, 7))
    return days.withColumn("last_dt", F.max("dt").over(Window.partitionBy("month")))


def kpi_range(kpi: DataFrame, first: str, last: str) -> DataFrame:
    """Daily figures from ``first`` to ``last``, both included, in order."""
    return (
        kpi.where(F.col("dt").between(first, last))
        .select("dt", "order_count", "gmv", "avg_order_value")
        .orderBy("dt")
    )
