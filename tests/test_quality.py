import datetime
from zoneinfo import ZoneInfo

import pytest

from tallyloom.operators import integrity, quality

ITEMS = "order_id string, product_id string, price double, freight_value double"
ORDERS = (
    "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, dt string"
)


def _at(text):
    return datetime.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def layers(rows, raw):
    bronze = {
        "orders": raw("orders", dict(order_id=""), dict(order_id=None), dict(order_id="1")),
        "customers": raw("customers", dict(customer_id=""), dict(customer_id="c")),
        "order_items": raw("order_items", dict(product_id="p"), dict(product_id="")),
        "products": raw("products", dict(product_id="p")),
        "payments": raw("payments", dict(order_id="1")),
    }
    silver = {
        "orders": rows(ORDERS, [
            ("1", "c", _at("2018-01-02"), _at("2018-01-01"), "2018-01-02"),
            ("1", "c", _at("2018-01-02"), None, "2018-01-02"),
            ("2", None, _at("2018-01-03"), _at("2018-01-04"), "2017/01/01"),
            ("3", "gone", None, None, "2017-99-99"),
            (None, "c", None, None, None),
        ]),
        "customers": rows("customer_id string", [("c",), ("c",), ("d",)]),
        "order_items": rows(ITEMS, [
            ("1", "p", -1.0, 0.0),
            ("9", "p", 1.0, -0.5),
            ("9", "q", None, None),
            (None, "p", 1.0, 1.0),
        ]),
        "products": rows("product_id string", [("p",), ("p",), ("p",)]),
        "payments": rows("order_id string, total_payment_value double", [
            ("1", 0.0), ("2", -3.0), ("8", 5.0), ("7", None),
        ]),
    }
    gold = {
        "daily_kpi": rows("dt string, gmv double", [("2018-01-01", -1.0), ("x", None)]),
        "cohort_retention": rows("cohort_month string", [("2018-01",)]),
        "rfm_features": rows("rfm_segment string", [("Lost",), ("",), (None,)]),
        "customer_churn_labels": rows("is_churned int", [(0,), (1,), (2,), (None,)]),
    }
    return bronze, silver, gold


EXPECTED = {
    "bronze.orders_raw - null order_id": (2, "FAIL"),
    "bronze.customers_raw - null customer_id": (1, "FAIL"),
    "bronze.order_items_raw - null product_id": (1, "FAIL"),
    "silver.orders - null order_id": (1, "FAIL"),
    "silver.orders - duplicate order_id": (1, "FAIL"),
    "silver.customers - duplicate customer_id": (1, "FAIL"),
    "silver.products - duplicate product_id": (1, "FAIL"),
    "silver.orders - future order dates": (1, "WARN"),
    "silver.orders - delivery before purchase": (1, "WARN"),
    "silver.orders - invalid dt partitions": (1, "FAIL"),
    "silver.order_items - negative prices": (1, "FAIL"),
    "silver.order_items - negative freight": (1, "FAIL"),
    "silver.payments - non-positive payment": (2, "WARN"),
    "silver.orders - orphan customer_id": (2, "WARN"),
    "silver.order_items - orphan order_id": (3, "WARN"),
    "silver.order_items - orphan product_id": (1, "WARN"),
    "silver.payments - orphan order_id": (2, "WARN"),
    "gold.rfm_features - missing segments": (2, "WARN"),
    "gold.customer_churn_labels - invalid is_churned": (1, "FAIL"),
    "gold.daily_kpi - negative GMV": (1, "FAIL"),
}
AS_OF = _at("2018-01-02T12:00:00")


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_every_check_counts_its_bad_rows(spark, layers, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        report = quality.quality_report(*layers, as_of=AS_OF).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r.check_name: (r.violations, r.status) for r in report} == EXPECTED
    assert all(r.severity == r.status for r in report)


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Kiritimati", "Pacific/Pago_Pago"])
def test_without_a_time_the_clock_decides_what_is_future(spark, rows, layers, zone):
    """An order of tomorrow is one, an order of yesterday is none, by the clock of the session's zone."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        now = datetime.datetime.now(ZoneInfo(zone)).replace(tzinfo=None)
        day = datetime.timedelta(days=1)
        bronze, silver, gold = layers
        bought = [(f"o{i}", "c", now + i * day, None, "2018-01-01") for i in (-1, 1, 2)]
        report = quality.quality_report(bronze, {**silver, "orders": rows(ORDERS, bought)}, gold).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r.violations for r in report if r.check_name == "silver.orders - future order dates"} == {2}


def test_the_audit_holds_report_and_row_counts(layers):
    audited = quality.audit(*layers, as_of=AS_OF).cache()
    report = quality.audit_report(audited).collect()
    assert {r.check_name: (r.violations, r.status) for r in report} == EXPECTED
    counts = quality.audit_row_counts(audited).collect()
    assert len(counts) == 14
    assert ("silver", "orders", 5) in {tuple(r) for r in counts}
    assert ("bronze", "order_items", 2) in {tuple(r) for r in counts}
    audited.unpersist()


def test_clean_tables_pass(rows):
    checks = [quality.Check("S", "none", "FAIL", quality.F.count_if(quality.F.col("x") < 0))]
    for data in ([(1,)], []):
        got = quality.run_checks(rows("x int", data), checks).collect()
        assert [tuple(r) for r in got] == [("S", "none", 0, "PASS", "FAIL")]


def test_enforce_raises_only_for_the_named_status(rows):
    schema = "section string, check_name string, violations long, status string, severity string"
    report = rows(schema, [("s", "late", 3, "WARN", "WARN")])
    assert quality.enforce(report) is report
    with pytest.raises(quality.QualityError, match="late: 3"):
        quality.enforce(report, "WARN")


def test_orphans_and_duplicates_with_their_rows(layers):
    silver = layers[1]
    orphans = integrity.orphan_keys(silver["order_items"], silver["orders"], "order_id")
    assert {tuple(r) for r in orphans.collect()} == {("9", 2), (None, 1)}
    doubles = integrity.duplicate_keys(silver["products"], "product_id")
    assert [tuple(r) for r in doubles.collect()] == [("p", 3)]


def test_without_a_time_the_clock_decides(spark, layers):
    bronze, cleaned, gold = layers
    now = datetime.datetime.now()
    schema = cleaned["orders"].schema
    days = [datetime.timedelta(days=d) for d in (-1, 1)]
    orders = [
        tuple(
            {"order_id": str(i), "order_purchase_timestamp": now + day, "dt": "2018-01-01"}.get(f.name)
            for f in schema.fields
        )
        for i, day in enumerate(days)
    ]
    cleaned = {**cleaned, "orders": spark.createDataFrame(orders, schema)}
    report = quality.quality_report(bronze, cleaned, gold).collect()
    found = {r.check_name: r.violations for r in report}
    assert found["silver.orders - future order dates"] == 1
