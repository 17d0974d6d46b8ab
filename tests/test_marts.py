import datetime
import math
from itertools import product as triples

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import churn, cohort, kpi, rfm, summaries
from tallyloom.operators.cohort import cohort_retention, customer_cohorts, monthly_activity

ORDERS = "order_id string, customer_id string, order_status string, dt string"
CUSTOMERS = "customer_id string, customer_unique_id string"
ITEMS = (
    "order_id string, order_item_id int, product_id string, price double, freight_value double"
)
PRODUCTS = "product_id string, product_category_english string"
DAY = datetime.date


@pytest.fixture(scope="module")
def shop(rows):
    """Ann buys in 2017-12 and 2018-02, Bob once; the last order is not delivered."""
    return {
        "orders": rows(ORDERS, [
            ("o1", "c1", "delivered", "2017-12-30"),
            ("o2", "c2", "delivered", "2018-02-01"),
            ("o3", "c3", "delivered", "2017-12-30"),
            ("o4", "c4", "shipped", "2018-03-03"),
            ("o5", "c5", "delivered", "2018-01-15"),
            ("o6", "lost", "delivered", "2018-01-16"),
        ]),
        "customers": rows(CUSTOMERS, [
            ("c1", "ann"), ("c2", "ann"), ("c3", "bob"), ("c4", "bob"), ("c5", "cy"),
        ]),
        "order_items": rows(ITEMS, [
            ("o1", 1, "p1", 10.10, 1.0),
            ("o1", 1, "p1", 10.10, 1.0),
            ("o1", 2, "p2", 0.20, None),
            ("o2", 1, "p3", 5.0, 2.0),
            ("o3", None, "p1", 1.0, 1.0),
            ("o4", 1, "p1", 99.0, 9.0),
            ("o6", 1, "p2", None, None),
            ("none", 1, "p1", 7.0, 7.0),
        ]),
        "products": rows(PRODUCTS, [("p1", "art"), ("p2", "toys"), ("p3", None)]),
    }


def test_daily_kpi(shop):
    got = kpi.daily_kpi(kpi.order_totals(shop["orders"], shop["order_items"])).collect()
    assert {r.dt: tuple(r)[1:] for r in got} == {
        "2017-12-30": (2, 21.4, 10.7, 2, 3, 1.5, 3.0),
        "2018-02-01": (1, 5.0, 5.0, 1, 1, 1.0, 2.0),
        "2018-01-16": (1, None, None, 1, 1, 1.0, None),
    }


def test_daily_kpi_by_category_counts_an_order_in_each_category(shop):
    got = kpi.daily_kpi_by_category(shop["orders"], shop["order_items"], shop["products"])
    assert sorted(map(tuple, got.collect())) == [
        ("2017-12-30", "art", 2, 21.2, 2),
        ("2017-12-30", "toys", 1, 0.2, 1),
        ("2018-01-16", "toys", 1, None, 1),
        ("2018-02-01", "unknown", 1, 5.0, 1),
    ]


def test_kpi_range_is_inclusive_and_ordered(shop):
    daily = kpi.daily_kpi(kpi.order_totals(shop["orders"], shop["order_items"]))
    got = kpi.kpi_range(daily, "2018-01-16", "2018-02-01").collect()
    assert [r.dt for r in got] == ["2018-01-16", "2018-02-01"]


def test_cohorts_skip_inactive_months_and_cross_the_year(shop):
    activity = monthly_activity(shop["orders"], shop["customers"])
    assert sorted(map(tuple, activity.collect())) == [
        ("ann", "2017-12"), ("ann", "2018-02"), ("bob", "2017-12"), ("cy", "2018-01"),
    ]
    cohorts = {r.customer_unique_id: r.cohort_month for r in customer_cohorts(activity).collect()}
    assert cohorts == {"ann": "2017-12", "bob": "2017-12", "cy": "2018-01"}
    assert sorted(map(tuple, cohort_retention(activity).collect())) == [
        ("2017-12", "2017-12", 0, 2, 2, 1.0),
        ("2017-12", "2018-02", 2, 2, 1, 0.5),
        ("2018-01", "2018-01", 0, 1, 1, 1.0),
    ]


def test_a_customer_without_id_is_in_the_size_only(rows):
    activity = rows(
        "customer_unique_id string, activity_month string",
        [(None, "2018-01"), ("a", "2018-01"), (None, "2018-02"), (None, "2018-03")],
    )
    assert [tuple(r) for r in cohort_retention(activity).collect()] == [
        ("2018-01", "2018-01", 0, 2, 1, 0.5)
    ]


def test_cohort_curve(shop):
    retention = cohort_retention(monthly_activity(shop["orders"], shop["customers"]))
    got = cohort.cohort_curve(retention, "2017-12").collect()
    assert [tuple(r) for r in got] == [("2017-12", 0, 100.0), ("2017-12", 2, 50.0)]


def test_rfm_base_measures_from_the_last_order_of_any_status(shop):
    totals = kpi.order_totals(shop["orders"], shop["order_items"])
    base = rfm.rfm_base(totals, shop["customers"], shop["orders"])
    assert {r.customer_unique_id: tuple(r)[1:] for r in base.collect()} == {
        "ann": (30, 2, 25.4, DAY(2017, 12, 30), DAY(2018, 2, 1), 12.7),
        "bob": (63, 1, 1.0, DAY(2017, 12, 30), DAY(2017, 12, 30), 1.0),
    }
    fixed = rfm.rfm_base(totals, shop["customers"], shop["orders"], DAY(2018, 2, 2))
    assert {r.customer_unique_id: r.recency_days for r in fixed.collect()} == {
        "ann": 1,
        "bob": 34,
    }


def _label(r, f, m):
    """Segments by what the scores mean, cell by cell."""
    if r >= 4:
        if f == 1:
            return "New Customers"
        return "Champions" if f >= 4 and m >= 4 else "Loyal Customers"
    if r == 3:
        if f >= 3:
            return "Potential Loyalists"
        return "Promising" if m >= 3 else "Lost"
    if r == 2:
        return "About to Sleep" if f == 1 else "Customers Needing Attention"
    return {1: "Hibernating", 2: "Hibernating", 3: "Lost"}.get(f, "At Risk")


def test_segments_of_all_score_triples(rows):
    scores = list(triples(range(1, 6), repeat=3))
    df = rows("r_score int, f_score int, m_score int", scores)
    got = df.withColumn("segment", rfm.rfm_segment()).collect()
    assert {tuple(r)[:3]: r.segment for r in got} == {s: _label(*s) for s in scores}
    sizes = {}
    for row in got:
        sizes[row.segment] = sizes.get(row.segment, 0) + 1
    assert sizes == {
        "Champions": 8,
        "Loyal Customers": 32,
        "Potential Loyalists": 15,
        "New Customers": 10,
        "Promising": 6,
        "Customers Needing Attention": 20,
        "About to Sleep": 5,
        "At Risk": 10,
        "Hibernating": 10,
        "Lost": 9,
    }


def test_churn_limits(rows):
    df = rows(
        "customer_unique_id string, last_order_date date, recency_days int, frequency int, "
        "monetary double",
        [(str(d), DAY(2018, 1, 1), d, 1, 2.0) for d in (0, 30, 31, 60, 61, 90, 91)],
    )
    labels = churn.customer_churn_labels(df)
    assert {r.days_since_last_order: (r.is_churned, r.churn_risk_level) for r in labels.collect()} == {
        0: (0, "Low"), 30: (0, "Low"), 31: (0, "Medium"), 60: (0, "Medium"),
        61: (1, "High"), 90: (1, "High"), 91: (1, "Critical"),
    }
    assert {tuple(r) for r in churn.churn_rate(labels).collect()} == {
        (0, 4, 57.14),
        (1, 3, 42.86),
    }
    assert {tuple(r) for r in churn.churn_value(labels).collect()} == {(0, 4, 2.0), (1, 3, 2.0)}


def test_features_add_up(spark):
    customers = spark.range(103).select(
        F.concat(F.lit("c"), "id").alias("customer_unique_id"),
        (F.col("id") % 40).cast("int").alias("recency_days"),
        (F.col("id") % 3).cast("int").alias("frequency"),
        (F.col("id") % 7).cast("double").alias("monetary"),
        F.lit(DAY(2018, 1, 1)).alias("first_order_date"),
        F.lit(DAY(2018, 1, 1)).alias("last_order_date"),
        F.lit(1.0).alias("avg_order_value"),
    )
    features = rfm.rfm_features(customers)
    for score in ("r_score", "f_score", "m_score"):
        sizes = {r[0]: r[1] for r in features.groupBy(score).count().collect()}
        assert sizes == {1: 21, 2: 21, 3: 21, 4: 20, 5: 20}
    best = features.agg(F.max("recency_days").alias("d")).first().d
    assert features.where(f"recency_days = {best}").first().r_score == 1
    segments = rfm.segment_distribution(features).collect()
    assert sum(r.customer_count for r in segments) == 103
    assert [r.customer_count for r in segments] == sorted(
        (r.customer_count for r in segments), reverse=True
    )
    spend = {r.rfm_segment: r.customers for r in rfm.segment_spend(features).collect()}
    assert spend == {r.rfm_segment: r.customer_count for r in segments}


def test_date_range_and_counts(shop):
    assert tuple(summaries.date_range(shop["orders"]).first()) == (
        "2017-12-30",
        "2018-03-03",
        5,
    )
    counts = summaries.row_counts({"orders": shop["orders"], "items": shop["order_items"]})
    assert {tuple(r) for r in counts.collect()} == {("orders", 6), ("items", 8)}


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_money_does_not_depend_on_the_partitioning(spark, parts):
    from tallyloom.functions.money import money_merge, money_parts, money_sum, money_value

    values = [(i % 3, i * 0.01 + 0.1) for i in range(5_000)]
    values += [(0, 1e15), (1, None), (7, None), (8, math.inf)]
    df = spark.createDataFrame(values, "k int, x double").repartition(parts)
    direct = {r.k: r.v for r in df.groupBy("k").agg(money_sum(F.col("x")).alias("v")).collect()}
    exact = {
        k: sum(round(v * 10_000) for g, v in values[:5_000] if g == k) / 10_000 for k in range(3)
    }
    assert direct == {0: exact[0] + 1e15, 1: exact[1], 2: exact[2], 7: None, 8: math.inf}
    half = df.withColumn("h", F.rand(1) > 0.5).groupBy("k", "h")
    merged = half.agg(*money_parts(F.col("x"), "m")).groupBy("k").agg(*money_merge("m"))
    assert {r.k: r.v for r in merged.select("k", money_value("m").alias("v")).collect()} == direct


def test_retention_needs_five_exchanges_at_most(spark, tmp_path):
    """From stored tables, with every join shuffled."""
    from tallyloom.operators import cohort

    orders = spark.range(1000).selectExpr(
        "cast(id as string) as order_id", "cast(id % 300 as string) as customer_id", "'delivered' as order_status",
        "concat('2018-0', 1 + id % 9, '-01') as dt",
    )
    people = spark.range(300).selectExpr(
        "cast(id as string) as customer_id", "cast(id % 100 as string) as customer_unique_id"
    )
    for name, df in (("orders", orders), ("people", people)):
        df.write.parquet(f"{tmp_path}/{name}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        activity = cohort.monthly_activity(
            spark.read.parquet(f"{tmp_path}/orders"), spark.read.parquet(f"{tmp_path}/people")
        )
        plan = cohort.cohort_retention(activity)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert 0 < plan.count("Exchange hashpartitioning") <= 5


def test_orders_without_a_month_are_active_in_none(rows):
    from tallyloom.operators import cohort

    orders = rows("customer_id string, order_status string, dt string", [("a", "delivered", None), ("a", "delivered", "2018-01-02")])
    people = rows("customer_id string, customer_unique_id string", [("a", "x")])
    assert sorted(map(tuple, cohort.monthly_activity(orders, people).collect()), key=repr) == [("x", "2018-01"), ("x", None)]
