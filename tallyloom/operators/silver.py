"""Cleaned tables: keys required, text normalised, values typed, copies removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.money import money_sum
from tallyloom.functions.text import (
    day_of,
    has_key,
    lower_trim,
    to_date,
    to_double,
    to_int,
    to_timestamp,
    upper_trim,
)
from tallyloom.operators.dedupe import dedupe
from tallyloom.schemas import SILVER, conform


def silver_customers(customers_raw: DataFrame) -> DataFrame:
    kept = dedupe(customers_raw.where(has_key("customer_id")), ["customer_id"])
    return conform(
        kept.select(
            "customer_id",
            "customer_unique_id",
            to_int("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
            lower_trim("customer_city").alias("customer_city"),
            upper_trim("customer_state").alias("customer_state"),
        ),
        SILVER["customers"],
    )


def silver_orders(orders_raw: DataFrame) -> DataFrame:
    """One row per order: the one with the earliest purchase text."""
    kept = dedupe(
        orders_raw.where(has_key("order_id", "order_purchase_timestamp")),
        ["order_id"],
        ["order_purchase_timestamp"],
    )
    times = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
    ]
    return conform(
        kept.select(
            "order_id",
            "customer_id",
            lower_trim("order_status").alias("order_status"),
            *[to_timestamp(name).alias(name) for name in times],
            to_date("order_estimated_delivery_date").alias("order_estimated_delivery_date"),
            day_of("order_purchase_timestamp").alias("dt"),
        ),
        SILVER["orders"],
    )


def silver_order_items(order_items_raw: DataFrame) -> DataFrame:
    """Typed items. Equal rows are kept: an order may hold the same item twice."""
    typed = order_items_raw.where(has_key("order_id", "product_id")).select(
        "order_id",
        to_int("order_item_id").alias("order_item_id"),
        "product_id",
        "seller_id",
        to_timestamp("shipping_limit_date").alias("shipping_limit_date"),
        to_double("price").alias("price"),
        to_double("freight_value").alias("freight_value"),
    )
    return conform(
        typed.withColumn("total_value", F.col("price") + F.col("freight_value")),
        SILVER["order_items"],
    )


def silver_products(
    products_raw: DataFrame, category_translation_raw: DataFrame, unknown: str = "unknown"
) -> DataFrame:
    """One row per product and matching translation.

    Translations are taken as they come: two for one category give two rows per
    product, which the duplicate check then reports. No broadcast is forced:
    Spark broadcasts the translations when their measured size allows it.
    """
    kept = dedupe(products_raw.where(has_key("product_id")), ["product_id"])
    translations = category_translation_raw.select(
        lower_trim("product_category_name").alias("_category"),
        lower_trim("product_category_name_english").alias("_english"),
    )
    measures = {
        "product_name_length": "product_name_lenght",
        "product_description_length": "product_description_lenght",
        "product_photos_qty": "product_photos_qty",
        "product_weight_g": "product_weight_g",
        "product_length_cm": "product_length_cm",
        "product_height_cm": "product_height_cm",
        "product_width_cm": "product_width_cm",
    }
    typed = kept.select(
        "product_id",
        lower_trim("product_category_name").alias("product_category_name"),
        *[to_int(source).alias(target) for target, source in measures.items()],
    )
    joined = typed.join(
        translations, F.col("product_category_name") == F.col("_category"), "left"
    )
    return conform(
        joined.withColumn(
            "product_category_english", F.coalesce("_english", F.lit(unknown))
        ),
        SILVER["products"],
    )


def silver_payments(payments_raw: DataFrame) -> DataFrame:
    """Payments added up per order.

    The primary type is the lexicographic maximum, not the most frequent one.
    """
    return conform(
        payments_raw.where(has_key("order_id"))
        .groupBy("order_id")
        .agg(
            money_sum(to_double("payment_value")).alias("total_payment_value"),
            F.count(F.lit(1)).alias("payment_count"),
            F.max("payment_type").alias("primary_payment_type"),
            F.avg(to_double("payment_installments")).alias("avg_installments"),
        ),
        SILVER["payments"],
    )
