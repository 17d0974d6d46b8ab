"""The six raw tables, derived from a star schema of sales.

Every value becomes text, as in a CSV export, so cleaning has real work to do:
mixed case and blanks, empty and malformed fields, repeated and keyless rows,
references that lead nowhere, untranslated categories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.schemas import RAW_COLUMNS


def read_star(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _time(name: str, shift: str = "INTERVAL 0 HOURS") -> Column:
    """Zone-free timestamp text, moved by an interval."""
    return (F.col(name).cast("timestamp_ntz") + F.expr(shift)).cast("string")


def _copies(**extra: Column) -> Column:
    """One entry for the row itself and one per further copy that applies."""
    return F.explode(
        F.array_compact(
            F.array(F.lit("base"), *[F.when(applies, name) for name, applies in extra.items()])
        )
    ).alias("copy")


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; those in progress also as a later, a keyless and a dateless row.

    Small open orders have another id than their items and payments.
    """
    status, priority, copy = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("copy")
    done, open_, running = status == "F", status == "O", status == "P"
    orders = (
        read_star(spark, sf_dir, "orders")
        .select(
            "*",
            _copies(
                later=running,
                keyless=running & (priority == "5-LOW"),
                dateless=running & (priority == "4-NOT SPECIFIED"),
            ),
        )
    )
    base, blank = copy == "base", F.lit("")
    return orders.select(
        F.when(copy == "keyless", "")
        .when(copy == "dateless", F.concat(_text("o_orderkey"), F.lit("-draft")))
        .when(open_ & (F.col("o_totalprice") < 5000), F.concat(F.lit("#lost-"), _text("o_orderkey")))
        .otherwise(_text("o_orderkey"))
        .alias("order_id"),
        _text("o_orderkey").alias("customer_id"),
        F.when(~base, "created")
        .when(done & (priority == "1-URGENT"), " DELIVERED ")
        .when(done, "delivered")
        .when(open_, " Shipped ")
        .otherwise("PROCESSING")
        .alias("order_status"),
        F.when(copy == "dateless", "")
        .when(copy == "later", _time("o_orderdate", "INTERVAL 1 DAY"))
        .otherwise(_time("o_orderdate"))
        .alias("order_purchase_timestamp"),
        F.when(base & ~running, _time("o_orderdate", "INTERVAL 1 HOUR"))
        .otherwise(blank)
        .alias("order_approved_at"),
        F.when(done, _time("o_orderdate", "INTERVAL 2 DAYS"))
        .otherwise(blank)
        .alias("order_delivered_carrier_date"),
        F.when(done & (priority == "5-LOW"), _time("o_orderdate", "INTERVAL -1 DAYS"))
        .when(done, _time("o_orderdate", "INTERVAL 7 DAYS"))
        .otherwise(blank)
        .alias("order_delivered_customer_date"),
        F.when(base, _time("o_orderdate", "INTERVAL 14 DAYS"))
        .otherwise(blank)
        .alias("order_estimated_delivery_date"),
    )


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer row per order; those of urgent running orders have another id."""
    status, priority, copy = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("copy")
    places = (
        read_star(spark, sf_dir, "nation")
        .join(
            read_star(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        .select("n_nationkey", "n_name", "r_name")
    )
    people = (
        read_star(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "n_name", "r_name")
    )
    rows = (
        read_star(spark, sf_dir, "orders")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "*",
            _copies(
                again=(status == "O") & (priority == "5-LOW"),
                keyless=(status == "P") & (priority == "2-HIGH"),
            ),
        )
    )
    return rows.select(
        F.when(copy == "keyless", "")
        .when((status == "P") & (priority == "1-URGENT"), F.concat(F.lit("lost-"), _text("o_orderkey")))
        .otherwise(_text("o_orderkey"))
        .alias("customer_id"),
        F.when(copy == "again", F.concat(F.lit("x"), _text("o_custkey")))
        .otherwise(_text("o_custkey"))
        .alias("customer_unique_id"),
        F.lpad(_text("o_custkey"), 5, "0").alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("customer_city"),
        F.lower(F.substring("r_name", 1, 2)).alias("customer_state"),
    )


def order_items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items; the largest discounts carry the malformed fields."""
    discount, tax = F.col("l_discount"), F.col("l_tax")
    most = discount == 0.1
    return read_star(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        F.when(most & (tax == 0.01), "")
        .otherwise(_text("l_linenumber"))
        .alias("order_item_id"),
        F.when(most & (tax == 0.0), "").otherwise(_text("l_partkey")).alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        F.when(F.col("l_returnflag") == "N", "")
        .otherwise(_time("l_shipdate"))
        .alias("shipping_limit_date"),
        F.when(most & (tax == 0.08), "n/a")
        .when((discount == 0.0) & (tax == 0.0), F.concat(F.lit("-"), _text("l_extendedprice")))
        .otherwise(_text("l_extendedprice"))
        .alias("price"),
        _text("l_quantity").alias("freight_value"),
    )


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, the largest economy ones under another id; small standard parts twice."""
    kind, size, copy = F.col("p_type"), F.col("p_size"), F.col("copy")
    name = F.length("p_name")
    parts = (
        read_star(spark, sf_dir, "part")
        .select("*", _copies(again=(kind == "STANDARD") & (size <= 10)))
    )
    return parts.select(
        F.when((kind == "ECONOMY") & (size > 45), F.concat(F.lit("lost-"), _text("p_partkey")))
        .otherwise(_text("p_partkey"))
        .alias("product_id"),
        F.when(copy == "again", "zzz")
        .when((kind == "PROMO") & (size < 3), "")
        .when(kind == "SMALL", F.upper("p_brand"))
        .when(kind == "LARGE", F.concat(F.lit(" "), F.col("p_brand"), F.lit(" ")))
        .otherwise(F.col("p_brand"))
        .alias("product_category_name"),
        name.cast("string").alias("product_name_lenght"),
        F.concat((name * 10).cast("string"), F.lit(".5")).alias("product_description_lenght"),
        F.when(size > 40, "").otherwise(_text("p_size")).alias("product_photos_qty"),
        (size * 100).cast("string").alias("product_weight_g"),
        _text("p_size").alias("product_length_cm"),
        (size + 1).cast("string").alias("product_height_cm"),
        (size + 2).cast("string").alias("product_width_cm"),
    )


def payments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per line item; untaxed ones are worth nothing."""
    flag = F.col("l_returnflag")
    return read_star(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        _text("l_linenumber").alias("payment_sequential"),
        F.when(flag == "R", "credit_card")
        .when(flag == "A", "boleto")
        .otherwise("voucher")
        .alias("payment_type"),
        _text("l_quantity").alias("payment_installments"),
        F.when(F.col("l_tax") == 0.0, "0")
        .otherwise(_text("l_extendedprice"))
        .alias("payment_value"),
    )


def category_translation_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations of all brands; one has two, and brands with one-digit numbers a spoilt key."""
    brands = (
        read_star(spark, sf_dir, "part")
        .select("p_brand")
        .distinct()
        .select("p_brand", _copies(other=F.col("p_brand") == "Brand#25"))
    )
    return brands.select(
        F.when(F.length("p_brand") == 8, F.col("p_brand"))
        .otherwise(F.concat(F.lit("lost-"), F.col("p_brand")))
        .alias("product_category_name"),
        F.when(F.col("copy") == "other", "Second Label")
        .otherwise(F.concat(F.lit(" LABEL "), F.substring("p_brand", 7, 2)))
        .alias("product_category_name_english"),
    )


_BUILDERS = {
    "orders": orders_raw,
    "customers": customers_raw,
    "order_items": order_items_raw,
    "products": products_raw,
    "payments": payments_raw,
    "category_translation": category_translation_raw,
}


def raw_table(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return _BUILDERS[entity](spark, sf_dir).select(*RAW_COLUMNS[entity])


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {entity: raw_table(spark, sf_dir, entity) for entity in RAW_COLUMNS}
