"""The data-quality report: twenty checks over all layers.

Every check counts rows that should not exist. Checks on one table share one
scan of it; the checks on keys share one aggregate per key. A failed check is a
row of the report; ``enforce`` turns it into an error where that is wanted.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.text import has_key
from tallyloom.operators.integrity import (
    key_profile,
    profile_duplicates,
    profile_orphans,
)

# The report's sections, check names and severities.
NULLS = "NULL CHECKS"
DUPLICATES = "DUPLICATE CHECKS"
DATES = "DATE VALIDATION"
AMOUNTS = "AMOUNT VALIDATION"
REFERENCES = "REFERENTIAL INTEGRITY"
MARTS = "GOLD LAYER VALIDATION"
ROWS = "DATA COMPLETENESS"
DAY_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


@dataclass(frozen=True)
class Check:
    section: str
    name: str
    severity: str
    violations: Column


class QualityError(Exception):
    """Raised by ``enforce``; the message lists the failed checks."""


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks of one table in a single aggregate, one row per check."""
    counted = df.agg(*[c.violations.alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c.section).alias("section"),
                F.lit(c.name).alias("check_name"),
                F.col(f"c{i}").alias("violations"),
                F.when(F.col(f"c{i}") > 0, c.severity).otherwise("PASS").alias("status"),
                F.lit(c.severity).alias("severity"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows))


def _future_limit(as_of: datetime.datetime | None) -> Column:
    """Wall-clock time; as text, so that no session time zone shifts it."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def _table_plan(
    bronze: dict[str, DataFrame],
    silver: dict[str, DataFrame],
    gold: dict[str, DataFrame],
    as_of: datetime.datetime | None,
) -> list[tuple[str, DataFrame, list[Check]]]:
    """Tables with the checks that look at their own rows alone."""
    bought, delivered = (
        F.col(c) for c in ("order_purchase_timestamp", "order_delivered_customer_date")
    )
    segment = F.col("rfm_segment")
    return [
        ("bronze.orders", bronze["orders"], [
            Check(NULLS, "bronze.orders_raw - null order_id", "FAIL",
                  F.count_if(~has_key("order_id"))),
        ]),
        ("bronze.customers", bronze["customers"], [
            Check(NULLS, "bronze.customers_raw - null customer_id", "FAIL",
                  F.count_if(~has_key("customer_id"))),
        ]),
        ("bronze.order_items", bronze["order_items"], [
            Check(NULLS, "bronze.order_items_raw - null product_id", "FAIL",
                  F.count_if(~has_key("product_id"))),
        ]),
        ("bronze.products", bronze["products"], []),
        ("bronze.payments", bronze["payments"], []),
        ("silver.orders", silver["orders"], [
            Check(NULLS, "silver.orders - null order_id", "FAIL",
                  F.count_if(F.col("order_id").isNull())),
            Check(DATES, "silver.orders - future order dates", "WARN",
                  F.count_if(bought > _future_limit(as_of))),
            Check(DATES, "silver.orders - delivery before purchase", "WARN",
                  F.count_if(delivered < bought)),
            Check(DATES, "silver.orders - invalid dt partitions", "FAIL",
                  F.count_if(~F.col("dt").rlike(DAY_PATTERN))),
        ]),
        ("silver.customers", silver["customers"], []),
        ("silver.order_items", silver["order_items"], [
            Check(AMOUNTS, "silver.order_items - negative prices", "FAIL",
                  F.count_if(F.col("price") < 0)),
            Check(AMOUNTS, "silver.order_items - negative freight", "FAIL",
                  F.count_if(F.col("freight_value") < 0)),
        ]),
        ("silver.products", silver["products"], []),
        ("silver.payments", silver["payments"], [
            Check(AMOUNTS, "silver.payments - non-positive payment", "WARN",
                  F.count_if(F.col("total_payment_value") <= 0)),
        ]),
        ("gold.daily_kpi", gold["daily_kpi"], [
            Check(MARTS, "gold.daily_kpi - negative GMV", "FAIL",
                  F.count_if(F.col("gmv") < 0)),
        ]),
        ("gold.cohort_retention", gold["cohort_retention"], []),
        ("gold.rfm_features", gold["rfm_features"], [
            Check(MARTS, "gold.rfm_features - missing segments", "WARN",
                  F.count_if(segment.isNull() | (segment == ""))),
        ]),
        ("gold.customer_churn_labels", gold["customer_churn_labels"], [
            Check(MARTS, "gold.customer_churn_labels - invalid is_churned", "FAIL",
                  F.count_if(~F.col("is_churned").isin(0, 1))),
        ]),
    ]


def key_checks(silver: dict[str, DataFrame]) -> DataFrame:
    """Duplicate keys and orphans, one shuffle per key."""
    plan = [
        ("order_id", ["orders", "order_items", "payments"], [
            Check(DUPLICATES, "silver.orders - duplicate order_id", "FAIL",
                  profile_duplicates("orders")),
            Check(REFERENCES, "silver.order_items - orphan order_id", "WARN",
                  profile_orphans("order_items", "orders", "order_id")),
            Check(REFERENCES, "silver.payments - orphan order_id", "WARN",
                  profile_orphans("payments", "orders", "order_id")),
        ]),
        ("customer_id", ["customers", "orders"], [
            Check(DUPLICATES, "silver.customers - duplicate customer_id", "FAIL",
                  profile_duplicates("customers")),
            Check(REFERENCES, "silver.orders - orphan customer_id", "WARN",
                  profile_orphans("orders", "customers", "customer_id")),
        ]),
        ("product_id", ["products", "order_items"], [
            Check(DUPLICATES, "silver.products - duplicate product_id", "FAIL",
                  profile_duplicates("products")),
            Check(REFERENCES, "silver.order_items - orphan product_id", "WARN",
                  profile_orphans("order_items", "products", "product_id")),
        ]),
    ]
    return reduce(
        DataFrame.unionByName,
        [
            run_checks(key_profile({name: silver[name] for name in names}, key), checks)
            for key, names, checks in plan
        ],
    )


def quality_report(
    bronze: dict[str, DataFrame],
    silver: dict[str, DataFrame],
    gold: dict[str, DataFrame],
    as_of: datetime.datetime | None = None,
) -> DataFrame:
    """All checks as (section, check_name, violations, status, severity).

    ``as_of`` replaces the current time in the check for future orders.
    """
    checked = [
        run_checks(df, checks)
        for _, df, checks in _table_plan(bronze, silver, gold, as_of)
        if checks
    ]
    return reduce(DataFrame.unionByName, [*checked, key_checks(silver)])


def audit(
    bronze: dict[str, DataFrame],
    silver: dict[str, DataFrame],
    gold: dict[str, DataFrame],
    as_of: datetime.datetime | None = None,
) -> DataFrame:
    """The report and the row counts of all tables from one scan of each.

    Store it and take it apart with ``audit_report`` and ``audit_row_counts``.
    """
    counted = [
        run_checks(df, [Check(ROWS, name, "", F.count(F.lit(1))), *checks])
        for name, df, checks in _table_plan(bronze, silver, gold, as_of)
    ]
    return reduce(DataFrame.unionByName, [*counted, key_checks(silver)])


def audit_report(audited: DataFrame) -> DataFrame:
    return audited.where(F.col("section") != ROWS)


def audit_row_counts(audited: DataFrame) -> DataFrame:
    """Completeness: (layer, table_name, row_count)."""
    return audited.where(F.col("section") == ROWS).select(
        F.substring_index("check_name", ".", 1).alias("layer"),
        F.substring_index("check_name", ".", -1).alias("table_name"),
        F.col("violations").alias("row_count"),
    )


def enforce(report: DataFrame, fail_on: str = "FAIL") -> DataFrame:
    """Raise if a check has the given status; otherwise return the report."""
    failed = report.where(F.col("status") == fail_on).collect()
    if failed:
        lines = [f"{row.check_name}: {row.violations}" for row in failed]
        raise QualityError("\n".join(lines))
    return report
