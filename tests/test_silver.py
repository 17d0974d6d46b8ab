import datetime

from tallyloom.operators import silver
from tallyloom.operators.dedupe import dedupe


def test_customers_are_cleaned_and_unique(raw):
    df = raw(
        "customers",
        dict(customer_id="a", customer_unique_id="p2", customer_city="Zz"),
        dict(
            customer_id="a",
            customer_unique_id="p1",
            customer_zip_code_prefix="01151",
            customer_city="  São PAULO ",
            customer_state=" sp",
        ),
        dict(customer_id="", customer_unique_id="p3"),
        dict(customer_id=None, customer_unique_id="p4"),
        dict(customer_id="b", customer_zip_code_prefix="12.9", customer_unique_id="p5"),
        dict(customer_id="c", customer_zip_code_prefix="12x", customer_unique_id="p6"),
    )
    got = {r.customer_id: tuple(r)[1:] for r in silver.silver_customers(df).collect()}
    assert got == {
        "a": ("p1", 1151, "são paulo", "SP"),
        "b": ("p5", 12, "", ""),
        "c": ("p6", None, "", ""),
    }


def test_orders_keep_the_earliest_text(raw):
    df = raw(
        "orders",
        dict(order_id="1", order_purchase_timestamp="2018-01-02 00:00:01", order_status="x"),
        dict(
            order_id="1",
            customer_id=" c ",
            order_purchase_timestamp="2018-01-01 23:59:59",
            order_status=" Delivered ",
            order_estimated_delivery_date="2018-01-20 00:00:00",
            order_approved_at="not a time",
        ),
        dict(order_id="2", order_purchase_timestamp=""),
        dict(order_id="", order_purchase_timestamp="2018-01-01 00:00:00"),
        dict(order_id="3", order_purchase_timestamp="2017/01/01 bad"),
    )
    got = {r.order_id: r for r in silver.silver_orders(df).collect()}
    assert sorted(got) == ["1", "3"]
    first = got["1"]
    assert first.customer_id == " c "
    assert first.order_status == "delivered"
    assert first.order_purchase_timestamp == datetime.datetime(2018, 1, 1, 23, 59, 59)
    assert first.order_approved_at is None
    assert first.order_delivered_customer_date is None
    assert first.order_estimated_delivery_date == datetime.date(2018, 1, 20)
    assert first.dt == "2018-01-01"
    assert got["3"].order_purchase_timestamp is None
    assert got["3"].dt == "2017/01/01"


def test_items_keep_copies_and_null_totals(raw):
    item = dict(order_id="1", order_item_id="1", product_id="p", price="10.50")
    df = raw(
        "order_items",
        dict(item, freight_value="1.25", shipping_limit_date="2018-01-01 10:00:00"),
        dict(item, freight_value="1.25", shipping_limit_date="2018-01-01 10:00:00"),
        dict(item, freight_value="free"),
        dict(item, product_id=""),
        dict(item, order_id=""),
    )
    got = sorted(
        (r.price, r.freight_value, r.total_value)
        for r in silver.silver_order_items(df).collect()
        if r.freight_value is not None
    )
    assert got == [(10.5, 1.25, 11.75)] * 2
    rest = [r for r in silver.silver_order_items(df).collect() if r.freight_value is None]
    assert [(r.price, r.total_value) for r in rest] == [(10.5, None)]


def test_products_are_translated(raw):
    products = raw(
        "products",
        dict(
            product_id="1",
            product_category_name=" Perfumaria ",
            product_name_lenght="40",
            product_photos_qty="",
            product_weight_g="225.7",
        ),
        dict(product_id="1", product_category_name="zzz"),
        dict(product_id="2", product_category_name="artes"),
        dict(product_id="3", product_category_name=""),
        dict(product_id="4", product_category_name="blank"),
        dict(product_id="", product_category_name="artes"),
    )
    names = raw(
        "category_translation",
        dict(product_category_name="PERFUMARIA", product_category_name_english=" Perfumery"),
        dict(product_category_name="artes", product_category_name_english="art"),
        dict(product_category_name="artes", product_category_name_english="arts"),
        dict(product_category_name="blank", product_category_name_english=""),
    )
    got = sorted(
        (r.product_id, r.product_category_name, r.product_category_english)
        for r in silver.silver_products(products, names).collect()
    )
    assert got == [
        ("1", "perfumaria", "perfumery"),
        ("2", "artes", "art"),
        ("2", "artes", "arts"),
        ("3", "", "unknown"),
        ("4", "blank", ""),
    ]
    one = silver.silver_products(products, names).where("product_id = '1'").first()
    assert (one.product_name_length, one.product_photos_qty, one.product_weight_g) == (
        40,
        None,
        225,
    )


def test_payments_are_added_up(raw):
    df = raw(
        "payments",
        dict(order_id="1", payment_type="credit_card", payment_installments="3",
             payment_value="0.10"),
        dict(order_id="1", payment_type="voucher", payment_installments="1",
             payment_value="0.20"),
        dict(order_id="2", payment_type="boleto", payment_installments="x",
             payment_value="none"),
        dict(order_id="", payment_type="boleto", payment_value="5"),
    )
    got = {r.order_id: tuple(r)[1:] for r in silver.silver_payments(df).collect()}
    assert got == {"1": (0.3, 2, "voucher", 2.0), "2": (None, 1, "boleto", None)}


def test_dedupe_is_reproducible_and_limits_before_the_shuffle(spark, rows):
    df = rows("k string, a string, b int", [("x", "2", 1), ("x", "1", 9), ("x", "1", None)])
    kept = dedupe(df, ["k"], ["a"])
    assert [tuple(r) for r in kept.collect()] == [("x", "1", None)]
    plan = dedupe(df, ["k"], ["a"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning(k") :]
    assert plan.count("WindowGroupLimit") == 2
    assert before_shuffle.count("WindowGroupLimit") == 1


def test_one_key_holding_most_rows_is_deduplicated(spark):
    df = spark.range(90_000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) as k", "cast(id as string) as v"
    )
    assert dedupe(df, ["k"]).count() == 60_001
