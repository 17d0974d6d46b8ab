"""One key holds a third of the rows; the plans must not send it to one task."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import integrity, kpi
from tallyloom.operators.cohort import monthly_activity
from tallyloom.plans.explain import plan_rows
from tallyloom.sinks.scratch import materialize

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield spark
    for key in SKEW:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _hot(name):
    return F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(name)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_best_seller_is_split_in_the_category_lookup(skewed):
    ids = skewed.range(0, 60_000, 1, 16)
    orders = materialize(
        ids.select(
            F.col("id").cast("string").alias("order_id"),
            F.lit("delivered").alias("order_status"),
            F.lit("2018-01-01").alias("dt"),
        ),
        "orders",
    )
    items = materialize(
        ids.select(
            F.col("id").cast("string").alias("order_id"),
            _hot("product_id"),
            F.lit(1).alias("order_item_id"),
            F.lit(2.5).alias("price"),
        ),
        "items",
    )
    products = materialize(
        ids.select(_hot("product_id")).distinct().select(
            "product_id",
            F.when(F.col("product_id") == "hot", "top").otherwise("rest").alias(
                "product_category_english"
            ),
        ),
        "products",
    )
    df = kpi.daily_kpi_by_category(orders, items, products)
    got = {r.category: (r.order_count, r.gmv, r.item_count) for r in df.collect()}
    assert got == {"top": (20_000, 50_000.0, 20_000), "rest": (40_000, 100_000.0, 40_000)}
    dealt = plan_rows(kpi.daily_kpi_by_category(orders, items, products)).where("node = 'Exchange'").collect()
    assert any(r.dealt_by.startswith("hashpartitioning(product_id, _piece") for r in dealt)
    skewed.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = kpi.daily_kpi_by_category(orders, items, products)
        assert {r.category: (r.order_count, r.gmv, r.item_count) for r in plain.collect()} == got
    finally:
        skewed.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_keys_are_combined_before_the_shuffle(skewed):
    ids = skewed.range(0, 30_000, 1, 4)
    items = ids.select(
        _hot("order_id"),
        F.lit(1).alias("order_item_id"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("freight_value"),
    )
    orders = ids.select(
        _hot("order_id"),
        _hot("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.lit("2018-01-01").alias("dt"),
    ).distinct()
    totals = kpi.order_totals(orders, items)
    hot = totals.where("order_id = 'hot'").first()
    assert (hot.item_count, hot.price_units) == (10_000, 100_000_000)
    plan = _plan(kpi.order_totals(orders, items))
    items_side = plan[plan.rindex("HashAggregate(keys=[order_id") :]
    assert "partial_sum" in items_side and "Exchange" not in items_side

    activity = monthly_activity(
        orders, skewed.createDataFrame([("hot", "ann")], "customer_id string, customer_unique_id string")
    )
    assert [tuple(r) for r in activity.collect()] == [("ann", "2018-01")]

    lost = integrity.orphan_keys(items, orders.where("order_id != 'hot'"), "order_id")
    assert [tuple(r) for r in lost.collect()] == [("hot", 10_000)]
    text = _plan(integrity.orphan_keys(items, orders, "order_id"))
    assert "LeftAnti" in text


def test_no_mart_moves_its_customers_into_one_task(spark):
    from tallyloom.plans.registry import QUERIES

    for name in ("rfm_base", "rfm_features", "cohort_retention", "customer_churn_labels"):
        plan = _plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
        main = plan.split("Subquery")[0]
        assert "SinglePartition" not in main, name
