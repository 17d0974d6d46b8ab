"""Declared schemas of every layer. Nothing is inferred and nothing evolves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Column names and their order are the contract with the CSV
# files, which are matched by position. "lenght" is the source's spelling.
RAW_COLUMNS = {
    "orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "customers": [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ],
    "order_items": [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ],
    "products": [
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "payments": [
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ],
    "category_translation": [
        "product_category_name",
        "product_category_name_english",
    ],
}

# Entity -> name of the raw table and the file-name ending it is delivered
# under. Publishers put their own prefix in front of the ending.
RAW_TABLES = {entity: f"{entity}_raw" for entity in RAW_COLUMNS}
RAW_FILE_ENDINGS = {
    "orders": "orders_dataset.csv",
    "customers": "customers_dataset.csv",
    "order_items": "order_items_dataset.csv",
    "products": "products_dataset.csv",
    "payments": "order_payments_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}


def raw_schema(entity: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in RAW_COLUMNS[entity]])


def _table(*columns: tuple) -> StructType:
    return StructType(
        [StructField(name, kind, True, {"comment": note}) for name, kind, note in columns]
    )


_S, _I, _L, _D = StringType(), IntegerType(), LongType(), DoubleType()
_TS, _DATE = TimestampNTZType(), DateType()

SILVER = {
    "customers": _table(
        ("customer_id", _S, "Customer id, one per order"),
        ("customer_unique_id", _S, "The person behind the per-order ids"),
        ("customer_zip_code_prefix", _I, "ZIP prefix, leading zeros dropped"),
        ("customer_city", _S, "City, lower case"),
        ("customer_state", _S, "State code, upper case"),
    ),
    "orders": _table(
        ("order_id", _S, "Unique order id"),
        ("customer_id", _S, "References customers"),
        ("order_status", _S, "Status, lower case"),
        ("order_purchase_timestamp", _TS, "Time of purchase"),
        ("order_approved_at", _TS, "Time of payment approval"),
        ("order_delivered_carrier_date", _TS, "Time of carrier pickup"),
        ("order_delivered_customer_date", _TS, "Time of delivery"),
        ("order_estimated_delivery_date", _DATE, "Promised delivery day"),
        ("dt", _S, "Purchase day, YYYY-MM-DD, the partition"),
    ),
    "order_items": _table(
        ("order_id", _S, "References orders"),
        ("order_item_id", _I, "Position within the order"),
        ("product_id", _S, "References products"),
        ("seller_id", _S, "Seller"),
        ("shipping_limit_date", _TS, "Shipping deadline of the seller"),
        ("price", _D, "Item price"),
        ("freight_value", _D, "Freight cost"),
        ("total_value", _D, "Price plus freight"),
    ),
    "products": _table(
        ("product_id", _S, "Unique product id"),
        ("product_category_name", _S, "Category, source language"),
        ("product_category_english", _S, "Category, English"),
        ("product_name_length", _I, "Characters in the name"),
        ("product_description_length", _I, "Characters in the description"),
        ("product_photos_qty", _I, "Number of photos"),
        ("product_weight_g", _I, "Weight in grams"),
        ("product_length_cm", _I, "Length in cm"),
        ("product_height_cm", _I, "Height in cm"),
        ("product_width_cm", _I, "Width in cm"),
    ),
    "payments": _table(
        ("order_id", _S, "References orders"),
        ("total_payment_value", _D, "Sum paid for the order"),
        ("payment_count", _I, "Number of payments"),
        ("primary_payment_type", _S, "Lexicographically last payment type"),
        ("avg_installments", _D, "Mean number of installments"),
    ),
}

GOLD = {
    "daily_kpi": _table(
        ("dt", _S, "Day"),
        ("order_count", _L, "Delivered orders with items"),
        ("gmv", _D, "Sum of item prices"),
        ("avg_order_value", _D, "gmv per order"),
        ("unique_customers", _L, "Distinct customer_id"),
        ("total_items", _L, "Items sold"),
        ("avg_items_per_order", _D, "Items per order"),
        ("total_freight", _D, "Sum of freight"),
    ),
    "daily_kpi_by_category": _table(
        ("dt", _S, "Day"),
        ("category", _S, "English category"),
        ("order_count", _L, "Orders with an item of the category, not additive"),
        ("gmv", _D, "Sum of item prices"),
        ("item_count", _L, "Items sold"),
    ),
    "cohort_retention": _table(
        ("cohort_month", _S, "Month of the first delivered order"),
        ("activity_month", _S, "Month of activity"),
        ("months_since_cohort", _I, "Months between the two"),
        ("cohort_size", _L, "Customers in the cohort"),
        ("active_customers", _L, "Customers active in the month"),
        ("retention_rate", _D, "Active over size, 0 to 1"),
    ),
    "rfm_features": _table(
        ("customer_unique_id", _S, "Customer"),
        ("recency_days", _I, "Days since the last delivered order"),
        ("frequency", _I, "Delivered orders with items"),
        ("monetary", _D, "Sum of item prices"),
        ("first_order_date", _DATE, "First delivered order"),
        ("last_order_date", _DATE, "Last delivered order"),
        ("avg_order_value", _D, "monetary per order"),
        ("r_score", _I, "Recency fifth, 5 is the most recent"),
        ("f_score", _I, "Frequency fifth, 5 is the most frequent"),
        ("m_score", _I, "Monetary fifth, 5 is the highest"),
        ("rfm_segment", _S, "Segment label"),
    ),
    "customer_churn_labels": _table(
        ("customer_unique_id", _S, "Customer"),
        ("last_order_date", _DATE, "Last delivered order"),
        ("days_since_last_order", _I, "Days since then"),
        ("is_churned", _I, "1 past the inactivity limit, else 0"),
        ("churn_risk_level", _S, "Low, Medium, High or Critical"),
        ("total_orders", _I, "Delivered orders with items"),
        ("total_spend", _D, "Sum of item prices"),
    ),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in order, with their types and comments."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema]
    )
