"""Independent SQL for the registered queries, for a second engine to run.

The statements are written from the definitions of the results, table by table,
and share no code with the DataFrame operators.
"""

from __future__ import annotations

_FORMAT = "'%Y-%m-%d %H:%M:%S'"


def _time(expression: str) -> str:
    return f"strftime({expression}, {_FORMAT})"


_RAW = {
    "orders_raw": f"""
        SELECT CASE WHEN o_orderstatus = 'O' AND o_totalprice < 5000 THEN '#lost-' ELSE '' END
                   || CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(o_orderkey AS VARCHAR) AS customer_id,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN ' DELIVERED '
                    WHEN o_orderstatus = 'F' THEN 'delivered'
                    WHEN o_orderstatus = 'O' THEN ' Shipped '
                    ELSE 'PROCESSING' END AS order_status,
               {_time("o_orderdate")} AS order_purchase_timestamp,
               CASE WHEN o_orderstatus = 'P' THEN ''
                    ELSE {_time("o_orderdate + INTERVAL 1 HOUR")} END AS order_approved_at,
               CASE WHEN o_orderstatus = 'F' THEN {_time("o_orderdate + INTERVAL 2 DAY")}
                    ELSE '' END AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus <> 'F' THEN ''
                    WHEN o_orderpriority = '5-LOW' THEN {_time("o_orderdate - INTERVAL 1 DAY")}
                    ELSE {_time("o_orderdate + INTERVAL 7 DAY")}
               END AS order_delivered_customer_date,
               {_time("o_orderdate + INTERVAL 14 DAY")} AS order_estimated_delivery_date
        FROM orders
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), 'created',
               {_time("o_orderdate + INTERVAL 1 DAY")}, '', '', '', ''
        FROM orders WHERE o_orderstatus = 'P'
        UNION ALL
        SELECT '', CAST(o_orderkey AS VARCHAR), 'created', {_time("o_orderdate")}, '', '', '', ''
        FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR) || '-draft', CAST(o_orderkey AS VARCHAR), 'created',
               '', '', '', '', ''
        FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'""",
    "people": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, n_name, r_name
        FROM orders
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "people_rows": """
        SELECT *, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'lost-'
                       ELSE '' END || CAST(o_orderkey AS VARCHAR) AS cid,
               CAST(o_custkey AS VARCHAR) AS uid
        FROM people
        UNION ALL
        SELECT *, CAST(o_orderkey AS VARCHAR), 'x' || CAST(o_custkey AS VARCHAR)
        FROM people WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'
        UNION ALL
        SELECT *, '', CAST(o_custkey AS VARCHAR)
        FROM people WHERE o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'""",
    "customers_raw": """
        SELECT cid AS customer_id, uid AS customer_unique_id,
               CASE WHEN o_custkey < 10000 THEN lpad(CAST(o_custkey AS VARCHAR), 5, '0')
                    ELSE substr(CAST(o_custkey AS VARCHAR), 1, 5)
               END AS customer_zip_code_prefix,
               ' ' || n_name || ' ' AS customer_city,
               lower(substr(r_name, 1, 2)) AS customer_state
        FROM people_rows""",
    "order_items_raw": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CASE WHEN l_discount = 0.1::DOUBLE AND l_tax = 0.01::DOUBLE THEN ''
                    ELSE CAST(l_linenumber AS VARCHAR) END AS order_item_id,
               CASE WHEN l_discount = 0.1::DOUBLE AND l_tax = 0 THEN ''
                    ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
               CAST(l_suppkey AS VARCHAR) AS seller_id,
               CASE WHEN l_returnflag = 'N' THEN '' ELSE {_time("l_shipdate")}
               END AS shipping_limit_date,
               CASE WHEN l_discount = 0.1::DOUBLE AND l_tax = 0.08::DOUBLE THEN 'n/a'
                    WHEN l_discount = 0 AND l_tax = 0
                    THEN '-' || CAST(l_extendedprice AS VARCHAR)
                    ELSE CAST(l_extendedprice AS VARCHAR) END AS price,
               CAST(l_quantity AS VARCHAR) AS freight_value
        FROM lineitem""",
    "products_raw": """
        SELECT CASE WHEN p_type = 'ECONOMY' AND p_size > 45 THEN 'lost-' ELSE '' END
                   || CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN again THEN 'zzz'
                    WHEN p_type = 'PROMO' AND p_size < 3 THEN ''
                    WHEN p_type = 'SMALL' THEN upper(p_brand)
                    WHEN p_type = 'LARGE' THEN ' ' || p_brand || ' '
                    ELSE p_brand END AS product_category_name,
               CAST(length(p_name) AS VARCHAR) AS product_name_lenght,
               CAST(length(p_name) * 10 AS VARCHAR) || '.5' AS product_description_lenght,
               CASE WHEN p_size > 40 THEN '' ELSE CAST(p_size AS VARCHAR)
               END AS product_photos_qty,
               CAST(p_size * 100 AS VARCHAR) AS product_weight_g,
               CAST(p_size AS VARCHAR) AS product_length_cm,
               CAST(p_size + 1 AS VARCHAR) AS product_height_cm,
               CAST(p_size + 2 AS VARCHAR) AS product_width_cm
        FROM (SELECT *, FALSE AS again FROM part
              UNION ALL
              SELECT *, TRUE FROM part WHERE p_type = 'STANDARD' AND p_size <= 10) AS parts""",
    "payments_raw": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_linenumber AS VARCHAR) AS payment_sequential,
               CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto'
                    ELSE 'voucher' END AS payment_type,
               CAST(l_quantity AS VARCHAR) AS payment_installments,
               CASE WHEN l_tax = 0 THEN '0' ELSE CAST(l_extendedprice AS VARCHAR)
               END AS payment_value
        FROM lineitem""",
    "category_translation_raw": """
        SELECT DISTINCT CASE WHEN length(p_brand) = 8 THEN '' ELSE 'lost-' END || p_brand
                   AS product_category_name,
               ' LABEL ' || substr(p_brand, 7, 2) AS product_category_name_english
        FROM part
        UNION ALL
        SELECT DISTINCT p_brand, 'Second Label' FROM part WHERE p_brand = 'Brand#25'""",
}

_SILVER = {
    "s_customers": """
        SELECT customer_id, customer_unique_id,
               TRY_CAST(customer_zip_code_prefix AS INTEGER) AS customer_zip_code_prefix,
               lower(trim(customer_city)) AS customer_city,
               upper(trim(customer_state)) AS customer_state
        FROM customers_raw WHERE customer_id <> ''
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id,
            customers_raw.customer_zip_code_prefix, customers_raw.customer_city,
            customers_raw.customer_state) = 1""",
    "first_orders": """
        SELECT * FROM orders_raw WHERE order_id <> '' AND order_purchase_timestamp <> ''
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_purchase_timestamp,
            customer_id, order_status, order_approved_at, order_delivered_carrier_date,
            order_delivered_customer_date, order_estimated_delivery_date) = 1""",
    "s_orders": """
        SELECT order_id, customer_id, lower(trim(order_status)) AS order_status,
               TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
               TRY_CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
               TRY_CAST(order_delivered_carrier_date AS TIMESTAMP)
                   AS order_delivered_carrier_date,
               TRY_CAST(order_delivered_customer_date AS TIMESTAMP)
                   AS order_delivered_customer_date,
               CAST(TRY_CAST(order_estimated_delivery_date AS TIMESTAMP) AS DATE)
                   AS order_estimated_delivery_date,
               substr(first_orders.order_purchase_timestamp, 1, 10) AS dt
        FROM first_orders""",
    "s_order_items": """
        SELECT order_id, TRY_CAST(order_item_id AS INTEGER) AS order_item_id, product_id,
               seller_id, TRY_CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date,
               TRY_CAST(order_items_raw.price AS DOUBLE) AS price,
               TRY_CAST(order_items_raw.freight_value AS DOUBLE) AS freight_value,
               TRY_CAST(order_items_raw.price AS DOUBLE)
                   + TRY_CAST(order_items_raw.freight_value AS DOUBLE) AS total_value
        FROM order_items_raw WHERE order_id <> '' AND product_id <> ''""",
    "first_products": """
        SELECT * FROM products_raw WHERE product_id <> ''
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_category_name,
            product_name_lenght, product_description_lenght, product_photos_qty,
            product_weight_g, product_length_cm, product_height_cm, product_width_cm) = 1""",
    "s_products": """
        SELECT p.product_id, lower(trim(p.product_category_name)) AS product_category_name,
               COALESCE(lower(trim(t.product_category_name_english)), 'unknown')
                   AS product_category_english,
               TRY_CAST(p.product_name_lenght AS INTEGER) AS product_name_length,
               CAST(floor(TRY_CAST(p.product_description_lenght AS DOUBLE)) AS INTEGER)
                   AS product_description_length,
               TRY_CAST(p.product_photos_qty AS INTEGER) AS product_photos_qty,
               TRY_CAST(p.product_weight_g AS INTEGER) AS product_weight_g,
               TRY_CAST(p.product_length_cm AS INTEGER) AS product_length_cm,
               TRY_CAST(p.product_height_cm AS INTEGER) AS product_height_cm,
               TRY_CAST(p.product_width_cm AS INTEGER) AS product_width_cm
        FROM first_products p LEFT JOIN category_translation_raw t
          ON lower(trim(p.product_category_name)) = lower(trim(t.product_category_name))""",
    "s_payments": """
        SELECT order_id,
               CAST(SUM(CAST(TRY_CAST(payment_value AS DOUBLE) AS DECIMAL(18, 4))) AS DOUBLE)
                   AS total_payment_value,
               CAST(COUNT(*) AS INTEGER) AS payment_count,
               MAX(payment_type) AS primary_payment_type,
               AVG(TRY_CAST(payment_installments AS DOUBLE)) AS avg_installments
        FROM payments_raw WHERE order_id <> '' GROUP BY order_id""",
}

_GOLD = {
    "g_daily_kpi": """
        SELECT o.dt, COUNT(DISTINCT o.order_id) AS order_count,
               CAST(SUM(CAST(i.price AS DECIMAL(18, 4))) AS DOUBLE) AS gmv,
               CAST(SUM(CAST(i.price AS DECIMAL(18, 4))) AS DOUBLE)
                   / COUNT(DISTINCT o.order_id) AS avg_order_value,
               COUNT(DISTINCT o.customer_id) AS unique_customers,
               COUNT(i.order_item_id) AS total_items,
               COUNT(i.order_item_id) / COUNT(DISTINCT o.order_id) AS avg_items_per_order,
               CAST(SUM(CAST(i.freight_value AS DECIMAL(18, 4))) AS DOUBLE) AS total_freight
        FROM s_orders o JOIN s_order_items i ON o.order_id = i.order_id
        WHERE o.order_status = 'delivered' GROUP BY o.dt""",
    "g_daily_kpi_by_category": """
        SELECT o.dt, COALESCE(p.product_category_english, 'unknown') AS category,
               COUNT(DISTINCT o.order_id) AS order_count,
               CAST(SUM(CAST(i.price AS DECIMAL(18, 4))) AS DOUBLE) AS gmv,
               COUNT(i.order_item_id) AS item_count
        FROM s_orders o JOIN s_order_items i ON o.order_id = i.order_id
        LEFT JOIN s_products p ON i.product_id = p.product_id
        WHERE o.order_status = 'delivered' GROUP BY ALL""",
    "g_activity": """
        SELECT DISTINCT c.customer_unique_id, substr(o.dt, 1, 7) AS activity_month
        FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id
        WHERE o.order_status = 'delivered'""",
    "g_cohorts": """
        SELECT c.customer_unique_id, MIN(substr(o.dt, 1, 7)) AS cohort_month
        FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id
        WHERE o.order_status = 'delivered' GROUP BY c.customer_unique_id""",
    "g_cohort_sizes": """
        SELECT cohort_month, COUNT(*) AS cohort_size FROM g_cohorts GROUP BY cohort_month""",
    "g_cohort_retention": """
        SELECT cohort_month, activity_month,
               CAST(date_diff('month', CAST(cohort_month || '-01' AS DATE),
                              CAST(activity_month || '-01' AS DATE)) AS INTEGER)
                   AS months_since_cohort,
               cohort_size, COUNT(DISTINCT customer_unique_id) AS active_customers,
               CAST(COUNT(DISTINCT customer_unique_id) AS DOUBLE) / cohort_size
                   AS retention_rate
        FROM g_cohorts JOIN g_activity USING (customer_unique_id)
        JOIN g_cohort_sizes USING (cohort_month)
        GROUP BY cohort_month, activity_month, cohort_size""",
    "g_rfm_base": """
        SELECT c.customer_unique_id,
               CAST(date_diff('day', MAX(CAST(o.dt AS DATE)),
                    (SELECT MAX(TRY_CAST(dt AS DATE)) FROM s_orders)) AS INTEGER)
                   AS recency_days,
               CAST(COUNT(DISTINCT o.order_id) AS INTEGER) AS frequency,
               CAST(SUM(CAST(i.price AS DECIMAL(18, 4))) AS DOUBLE) AS monetary,
               MIN(CAST(o.dt AS DATE)) AS first_order_date,
               MAX(CAST(o.dt AS DATE)) AS last_order_date,
               CAST(SUM(CAST(i.price AS DECIMAL(18, 4))) AS DOUBLE)
                   / COUNT(DISTINCT o.order_id) AS avg_order_value
        FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id
        JOIN s_order_items i ON o.order_id = i.order_id
        WHERE o.order_status = 'delivered' GROUP BY c.customer_unique_id""",
    "g_scores": """
        SELECT *,
               CAST(ntile(5) OVER (ORDER BY recency_days DESC NULLS LAST,
                    customer_unique_id NULLS FIRST) AS INTEGER) AS r_score,
               CAST(ntile(5) OVER (ORDER BY frequency NULLS FIRST,
                    customer_unique_id NULLS FIRST) AS INTEGER) AS f_score,
               CAST(ntile(5) OVER (ORDER BY monetary NULLS FIRST,
                    customer_unique_id NULLS FIRST) AS INTEGER) AS m_score
        FROM g_rfm_base""",
    "g_rfm_features": """
        SELECT *,
               CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                    WHEN r_score >= 4 THEN if(f_score >= 2, 'Loyal Customers', 'New Customers')
                    WHEN r_score = 3 AND f_score >= 3 THEN 'Potential Loyalists'
                    WHEN r_score = 3 THEN if(m_score >= 3, 'Promising', 'Lost')
                    WHEN r_score = 2 AND f_score = 1 THEN 'About to Sleep'
                    WHEN r_score = 2 THEN 'Customers Needing Attention'
                    WHEN f_score >= 4 THEN 'At Risk'
                    WHEN f_score = 3 THEN 'Lost'
                    ELSE 'Hibernating' END AS rfm_segment
        FROM g_scores""",
    "g_churn_labels": """
        SELECT customer_unique_id, last_order_date, recency_days AS days_since_last_order,
               CAST(recency_days > 60 AS INTEGER) AS is_churned,
               CASE WHEN recency_days > 90 THEN 'Critical' WHEN recency_days > 60 THEN 'High'
                    WHEN recency_days > 30 THEN 'Medium' ELSE 'Low' END AS churn_risk_level,
               frequency AS total_orders, monetary AS total_spend
        FROM g_rfm_features""",
}

_CTES = {**_RAW, **_SILVER, **_GOLD}


def _statement(body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in _CTES.items())
    return f"WITH {ctes}\n{body}"


def _counts(rows: list[tuple[str, ...]], names: list[str]) -> str:
    """UNION ALL of row counts; each entry is labels and then the table."""
    selects = []
    for *labels, table in rows:
        columns = ", ".join(f"'{label}' AS {name}" for label, name in zip(labels, names))
        selects.append(f"SELECT {columns}, COUNT(*) AS row_count FROM {table}")
    return "\nUNION ALL ".join(selects)


def _orphans(child: str, parent: str, key: str) -> str:
    return f"""SELECT c.{key}, COUNT(*) AS row_count
        FROM {child} c LEFT JOIN (SELECT DISTINCT {key} FROM {parent}) p ON c.{key} = p.{key}
        WHERE p.{key} IS NULL GROUP BY c.{key}"""


def _duplicates(table: str, key: str) -> str:
    return f"""SELECT {key}, COUNT(*) AS row_count FROM {table}
        GROUP BY {key} HAVING COUNT(*) > 1"""


def _check(section: str, name: str, severity: str, violations: str) -> str:
    return f"""SELECT '{section}' AS section, '{name}' AS check_name, violations,
        CASE WHEN violations > 0 THEN '{severity}' ELSE 'PASS' END AS status,
        '{severity}' AS severity
        FROM (SELECT CAST(COALESCE(({violations}), 0) AS BIGINT) AS violations) AS counted"""


def _count_where(table: str, condition: str) -> str:
    return f"SELECT COUNT(*) FROM {table} WHERE {condition}"


def _report(as_of: str) -> str:
    nulls, dates, amounts = "NULL CHECKS", "DATE VALIDATION", "AMOUNT VALIDATION"
    copies, refs, marts = "DUPLICATE CHECKS", "REFERENTIAL INTEGRITY", "GOLD LAYER VALIDATION"

    def copied(table: str, key: str) -> str:
        return f"SELECT COUNT(*) FROM ({_duplicates(table, key)}) AS d"

    def lost(child: str, parent: str, key: str) -> str:
        return f"SELECT SUM(row_count) FROM ({_orphans(child, parent, key)}) AS d"

    checks = [
        (nulls, "bronze.orders_raw - null order_id", "FAIL",
         _count_where("orders_raw", "order_id = ''")),
        (nulls, "bronze.customers_raw - null customer_id", "FAIL",
         _count_where("customers_raw", "customer_id = ''")),
        (nulls, "bronze.order_items_raw - null product_id", "FAIL",
         _count_where("order_items_raw", "product_id = ''")),
        (nulls, "silver.orders - null order_id", "FAIL",
         _count_where("s_orders", "order_id IS NULL")),
        (copies, "silver.orders - duplicate order_id", "FAIL",
         copied("s_orders", "order_id")),
        (copies, "silver.customers - duplicate customer_id", "FAIL",
         copied("s_customers", "customer_id")),
        (copies, "silver.products - duplicate product_id", "FAIL",
         copied("s_products", "product_id")),
        (dates, "silver.orders - future order dates", "WARN",
         _count_where("s_orders", f"order_purchase_timestamp > TIMESTAMP '{as_of}'")),
        (dates, "silver.orders - delivery before purchase", "WARN",
         _count_where("s_orders", "order_delivered_customer_date < order_purchase_timestamp")),
        (dates, "silver.orders - invalid dt partitions", "FAIL",
         _count_where("s_orders", "NOT regexp_full_match(dt, '[0-9]{4}-[0-9]{2}-[0-9]{2}')")),
        (amounts, "silver.order_items - negative prices", "FAIL",
         _count_where("s_order_items", "price < 0")),
        (amounts, "silver.order_items - negative freight", "FAIL",
         _count_where("s_order_items", "freight_value < 0")),
        (amounts, "silver.payments - non-positive payment", "WARN",
         _count_where("s_payments", "total_payment_value <= 0")),
        (refs, "silver.orders - orphan customer_id", "WARN",
         lost("s_orders", "s_customers", "customer_id")),
        (refs, "silver.order_items - orphan order_id", "WARN",
         lost("s_order_items", "s_orders", "order_id")),
        (refs, "silver.order_items - orphan product_id", "WARN",
         lost("s_order_items", "s_products", "product_id")),
        (refs, "silver.payments - orphan order_id", "WARN",
         lost("s_payments", "s_orders", "order_id")),
        (marts, "gold.rfm_features - missing segments", "WARN",
         _count_where("g_rfm_features", "rfm_segment IS NULL OR rfm_segment = ''")),
        (marts, "gold.customer_churn_labels - invalid is_churned", "FAIL",
         _count_where("g_churn_labels", "is_churned NOT IN (0, 1)")),
        (marts, "gold.daily_kpi - negative GMV", "FAIL",
         _count_where("g_daily_kpi", "gmv < 0")),
    ]
    return "\nUNION ALL ".join(_check(*check) for check in checks)


_MONEY_MEAN = "CAST(SUM(CAST({0} AS DECIMAL(18, 4))) AS DOUBLE) / COUNT({0})"

_SILVER_TABLES = ["customers", "orders", "order_items", "products", "payments"]
_GOLD_TABLES = {
    "daily_kpi": "g_daily_kpi",
    "cohort_retention": "g_cohort_retention",
    "rfm_features": "g_rfm_features",
    "customer_churn_labels": "g_churn_labels",
}


def statements(parameters: dict) -> dict[str, str]:
    """One statement per registered query; ``parameters`` are the registry's."""
    p = parameters
    bodies = {
        **{f"scan_{name}": f"SELECT * FROM {name}" for name in _RAW if name.endswith("_raw")},
        "bronze_row_counts": _counts(
            [(name.removesuffix("_raw"), name) for name in _RAW if name.endswith("_raw")],
            ["table_name"],
        ),
        "landing_manifest": _counts(
            [(name.removesuffix("_raw"), name) for name in _RAW if name.endswith("_raw")],
            ["target"],
        ).replace("AS row_count", "AS record_count"),
        **{f"silver_{name}": f"SELECT * FROM s_{name}" for name in _SILVER_TABLES},
        "orders_one_day": f"SELECT * FROM s_orders WHERE dt = '{p['day']}'",
        "orders_backfill": f"""
            SELECT order_id, order_status, dt FROM s_orders
            WHERE dt NOT BETWEEN '{p['first_day']}' AND '{p['last_day']}'
            UNION ALL
            SELECT order_id, 'backfilled', dt FROM s_orders
            WHERE dt BETWEEN '{p['first_day']}' AND '{p['last_day']}'""",
        "silver_row_counts": _counts([(n, f"s_{n}") for n in _SILVER_TABLES], ["table_name"]),
        "daily_kpi": "SELECT * FROM g_daily_kpi",
        "daily_kpi_by_person": """
            SELECT o.dt, COUNT(DISTINCT o.order_id) AS order_count,
                   COUNT(DISTINCT c.customer_unique_id) AS unique_customers
            FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id
            WHERE o.order_status = 'delivered'
              AND o.order_id IN (SELECT order_id FROM s_order_items)
            GROUP BY o.dt""",
        "daily_kpi_by_category": "SELECT * FROM g_daily_kpi_by_category",
        "kpi_range": f"""SELECT dt, order_count, gmv, avg_order_value FROM g_daily_kpi
            WHERE dt BETWEEN '{p['first_day']}' AND '{p['last_day']}'""",
        "monthly_activity": "SELECT * FROM g_activity",
        "customer_cohorts": "SELECT * FROM g_cohorts",
        "cohort_retention": "SELECT * FROM g_cohort_retention",
        "cohort_curve": f"""SELECT cohort_month, months_since_cohort,
                round(retention_rate * 100, 1) AS retention_pct
            FROM g_cohort_retention WHERE cohort_month = '{p['cohort']}'""",
        "rfm_base": "SELECT * FROM g_rfm_base",
        "rfm_scores": """SELECT customer_unique_id, recency_days, frequency, monetary,
            r_score, f_score, m_score FROM g_scores""",
        "rfm_features": "SELECT * FROM g_rfm_features",
        "segment_distribution": """SELECT rfm_segment, COUNT(*) AS customer_count
            FROM g_rfm_features GROUP BY rfm_segment""",
        "segment_spend": f"""SELECT rfm_segment, COUNT(*) AS customers,
                round({_MONEY_MEAN.format('monetary')}, 2) AS avg_spend
            FROM g_rfm_features GROUP BY rfm_segment""",
        "customer_churn_labels": "SELECT * FROM g_churn_labels",
        "churn_rate": """SELECT is_churned, customer_count,
                round(customer_count * 100::DOUBLE
                      / CAST(SUM(customer_count) OVER () AS DOUBLE), 2) AS percentage
            FROM (SELECT is_churned, COUNT(*) AS customer_count
                  FROM g_churn_labels GROUP BY is_churned) AS flags""",
        "churn_value": f"""SELECT is_churned, COUNT(*) AS customers,
                round({_MONEY_MEAN.format('total_spend')}, 2) AS avg_lifetime_value
            FROM g_churn_labels GROUP BY is_churned""",
        "gold_headlines": """
            SELECT 'Daily KPIs' AS metric, CAST(COUNT(*) AS BIGINT) AS days FROM g_daily_kpi
            UNION ALL SELECT 'Total Cohorts', COUNT(DISTINCT cohort_month)
            FROM g_cohort_retention
            UNION ALL SELECT 'RFM Customers', COUNT(*) FROM g_rfm_features
            UNION ALL SELECT 'Churned Customers', CAST(SUM(is_churned) AS BIGINT)
            FROM g_churn_labels""",
        "duplicate_orders_raw": _duplicates("orders_raw", "order_id"),
        "duplicate_products": _duplicates("s_products", "product_id"),
        "orphan_order_customers": _orphans("s_orders", "s_customers", "customer_id"),
        "orphan_item_orders": _orphans("s_order_items", "s_orders", "order_id"),
        "orphan_item_products": _orphans("s_order_items", "s_products", "product_id"),
        "orphan_payment_orders": _orphans("s_payments", "s_orders", "order_id"),
        "quality_report": _report(p["as_of"]),
        "completeness": _counts(
            [
                ("bronze", n, f"{n}_raw")
                for n in ("orders", "customers", "order_items", "products", "payments")
            ]
            + [("silver", n, f"s_{n}") for n in _SILVER_TABLES]
            + [("gold", n, t) for n, t in _GOLD_TABLES.items()],
            ["layer", "table_name"],
        ),
        "date_range": """SELECT MIN(dt) AS min_date, MAX(dt) AS max_date,
            COUNT(DISTINCT dt) AS distinct_days FROM s_orders""",
    }
    bodies["landing_manifest_files"] = " UNION ALL ".join(
        f"SELECT '{entity}' AS target, '{ending}' AS entry, COUNT(*) AS record_count,"
        f" TRUE AS each_file_once FROM {entity}_raw"
        for entity, ending in p["endings"].items()
    )
    bodies["rfm_scores_narrowed"] = bodies["rfm_scores"]
    bodies["money_sums"] = """
        SELECT l_returnflag, l_linestatus,
               round(CAST(SUM(amount) AS DOUBLE), 5) AS amount,
               round(CAST(SUM(amount) AS DOUBLE) / COUNT(*), 5) AS mean
        FROM (SELECT *, CAST(l_extendedprice * (1 - l_discount) / 7000 AS DECIMAL(38, 10)) AS amount
              FROM lineitem) AS amounts
        GROUP BY l_returnflag, l_linestatus"""
    bodies["rfm_scores_ties"] = " UNION ALL ".join(
        f"""SELECT '{name}' AS ranked_by, CAST(tile AS INTEGER) AS tile, CAST(value AS DOUBLE) AS value,
                   COUNT(*) AS customers
            FROM (SELECT {name} AS value, ntile(5) OVER (ORDER BY {name} {order}) AS tile
                  FROM g_rfm_base) AS tiles GROUP BY ALL"""
        for name, order in (
            ("recency_days", "DESC NULLS LAST"),
            ("frequency", "NULLS FIRST"),
            ("monetary", "NULLS FIRST"),
        )
    )
    bodies["backfill_table"] = f"""
        SELECT order_id, CASE WHEN dt = '{p['day']}' THEN 'backfilled' ELSE order_status END AS order_status, dt
        FROM s_orders
        UNION ALL
        SELECT 'new-' || order_id, 'backfilled', '{p['new_day']}' FROM s_orders WHERE dt = '{p['day']}'"""
    bodies["backfill_partitions"] = f"""
        SELECT DISTINCT 'dt=' || dt AS "partition" FROM s_orders
        UNION ALL SELECT 'dt={p['new_day']}' WHERE EXISTS (FROM s_orders WHERE dt = '{p['day']}')"""
    bodies["partition_statistics"] = f"""
        SELECT unnest(['{p['day']}', '{p['new_day']}']) AS dt, COUNT(*) AS row_count
        FROM s_orders WHERE dt = '{p['day']}' HAVING COUNT(*) > 0"""
    bodies["column_statistics"] = " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, COUNT(DISTINCT {name}) AS distinct_count,
                   COUNT(*) - COUNT({name}) AS null_count, TRUE AS estimate_holds FROM s_orders"""
        for name in p["order_columns"]
    )
    bodies["stored_order"] = " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, COUNT(*) AS row_count, CAST(0 AS BIGINT) AS out_of_order,
                   TRUE AS several_files FROM g_{name}"""
        for name in ("daily_kpi", "daily_kpi_by_category", "cohort_retention")
    )
    bodies["kpi_of_days"] = """SELECT * FROM g_daily_kpi
        WHERE dt IN (SELECT MAX(dt) FROM s_orders GROUP BY substr(dt, 1, 7))"""
    bodies["plan_orders_one_day"] = f"""
        SELECT 'Scan orc' AS node, '[isnotnull(dt), (dt = {p['day']})]' AS partition_filters,
               '[]' AS pushed_filters, CAST(0 AS BIGINT) AS exchanges, COUNT(DISTINCT dt) AS days
        FROM s_orders WHERE dt = '{p['day']}'"""
    bodies["full_run_databases"] = f"""
        SELECT 'bronze' AS layer, 'Raw text as delivered' AS comment,
               CAST({sum(name.endswith('_raw') for name in _RAW)} AS BIGINT) AS table_count, TRUE AS in_own_folder
        UNION ALL SELECT 'silver', 'Typed and deduplicated tables', {len(_SILVER_TABLES)}, TRUE
        UNION ALL SELECT 'gold', 'Marts', {len(_GOLD_TABLES) + 1}, TRUE"""
    bodies["full_run_tables"] = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name"
        for layer, names in (
            ("bronze", [name for name in _RAW if name.endswith("_raw")]),
            ("silver", _SILVER_TABLES),
            ("gold", [*_GOLD_TABLES, "daily_kpi_by_category"]),
        )
        for name in names
    )
    bodies["full_run_statistics"] = _counts(
        [(n, f"s_{n}") for n in _SILVER_TABLES]
        + [(n, t) for n, t in _GOLD_TABLES.items()]
        + [("daily_kpi_by_category", "g_daily_kpi_by_category")],
        ["table_name"],
    )
    bodies["rerun_orders"] = f"""SELECT dt, COUNT(*) AS order_count FROM (
            SELECT substr(order_purchase_timestamp, 1, 10) AS dt, order_id FROM orders_raw
            WHERE order_id NOT IN ('', '{p['lost_order']}')
              AND order_purchase_timestamp <> ''
              AND NOT starts_with(order_purchase_timestamp, '{p['day']}')
            QUALIFY row_number() OVER (PARTITION BY order_id
                                       ORDER BY order_purchase_timestamp) = 1) AS kept
        GROUP BY dt"""
    for name, same_as in {
        **{f"full_run_silver_{name}": f"silver_{name}" for name in _SILVER_TABLES},
        "full_run_daily_kpi": "daily_kpi",
        "full_run_cohort_retention": "cohort_retention",
        "full_run_customer_churn_labels": "customer_churn_labels",
        "full_run_report": "quality_report",
        "full_run_row_counts": "completeness",
        "full_run_rfm_features": "rfm_features",
        "full_run_kpi_by_category": "daily_kpi_by_category",
    }.items():
        bodies[name] = bodies[same_as]
    return {name: _statement(body) for name, body in bodies.items()}
