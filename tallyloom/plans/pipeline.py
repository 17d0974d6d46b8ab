"""The full run: land, register, clean, derive, check."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators import churn, cohort, kpi, quality, rfm, silver, summaries
from tallyloom.schemas import RAW_COLUMNS, RAW_TABLES
from tallyloom.session import together
from tallyloom.sinks.scratch import temporary_table, work_database
from tallyloom.sinks.tables import (
    analyze,
    create_database,
    create_raw_table,
    quick_listing,
    small_splits,
    write_table,
)
from tallyloom.sources.csv import PACKED, empty_for_null
from tallyloom.sources.landing import land_raw, landing_manifest, source_paths

_COMMENTS = {
    "bronze": "Raw text as delivered",
    "silver": "Typed and deduplicated tables",
    "gold": "Marts",
}


def mart_order(mart: str) -> tuple:
    """Columns by which a mart is stored in order."""
    orders = {
        "daily_kpi": lambda: ("dt",),
        "daily_kpi_by_category": lambda: ("dt", F.desc("gmv"), "category"),
        "cohort_retention": lambda: ("cohort_month", "activity_month"),
    }
    return orders[mart]() if mart in orders else ()


@dataclass(frozen=True)
class Warehouse:
    """Three databases below one folder; ``prefix`` goes before their names."""

    spark: SparkSession
    root: str
    prefix: str = ""

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def location(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}"

    def create(self, layer: str) -> None:
        create_database(
            self.spark, self.database(layer), _COMMENTS[layer], self.location(layer)
        )

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def write(self, layer: str, name: str, df: DataFrame, **layout) -> DataFrame:
        location = f"{self.location(layer)}/{name}"
        return write_table(df, self.table(layer, name), location, **layout)


@dataclass
class Run:
    """What a run leaves behind, as DataFrames over the written tables."""

    manifest: DataFrame
    databases: dict[str, str] = field(default_factory=dict)
    bronze: dict[str, DataFrame] = field(default_factory=dict)
    silver: dict[str, DataFrame] = field(default_factory=dict)
    gold: dict[str, DataFrame] = field(default_factory=dict)
    summaries: dict[str, DataFrame] = field(default_factory=dict)
    report: DataFrame | None = None


def land(warehouse: Warehouse, source: str, entities: Iterable[str] = RAW_COLUMNS) -> DataFrame:
    """Land the files of the entities, packed; the manifest is stored, so showing it reads no source again."""
    paths = source_paths(warehouse.spark, source, entities=entities)
    manifest = landing_manifest(warehouse.spark, paths)
    path = f"{warehouse.location('work')}/manifest"
    steps = {
        "lines": lambda: land_raw(warehouse.spark, paths, warehouse.location("bronze"), **PACKED),
        "manifest": lambda: manifest.coalesce(1).write.mode("overwrite").parquet(path),
    }
    together(lambda step: steps[step](), steps)
    return warehouse.spark.read.schema(manifest.schema).parquet(path)


def build_bronze(
    warehouse: Warehouse, entities: Iterable[str] = RAW_COLUMNS
) -> dict[str, DataFrame]:
    warehouse.create("bronze")
    tables = {}
    for entity in entities:
        table = warehouse.table("bronze", RAW_TABLES[entity])
        create_raw_table(
            warehouse.spark, table, entity, f"{warehouse.location('bronze')}/{entity}"
        )
        tables[entity] = empty_for_null(warehouse.spark.table(table))
    return tables


def build_orders(warehouse: Warehouse, raw: DataFrame) -> DataFrame:
    """The one cleaned table that is partitioned, with statistics of its columns."""
    warehouse.create("silver")
    orders = silver.silver_orders(raw)
    with small_splits(warehouse.spark):
        table = warehouse.write("silver", "orders", orders, partition_by=("dt",))
    analyze(warehouse.spark, warehouse.table("silver", "orders"), columns=True)
    return table


def build_silver(warehouse: Warehouse, bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    warehouse.create("silver")
    rows = {
        "customers": silver.silver_customers(bronze["customers"]),
        "order_items": silver.silver_order_items(bronze["order_items"]),
        "products": silver.silver_products(
            bronze["products"], bronze["category_translation"]
        ),
        "payments": silver.silver_payments(bronze["payments"]),
    }
    def store(name: str) -> DataFrame:
        table = warehouse.write("silver", name, rows[name])
        analyze(warehouse.spark, warehouse.table("silver", name))
        return table

    # Orders go alone, since their write changes settings; the others share the cluster.
    orders = build_orders(warehouse, bronze["orders"])
    with small_splits(warehouse.spark):
        return {"orders": orders, **together(store, list(rows))}


def build_gold(warehouse: Warehouse, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five marts. Order totals are stored once and serve two of them."""
    warehouse.create("gold")
    spark = warehouse.spark
    orders, items, customers = (tables[n] for n in ("orders", "order_items", "customers"))
    with work_database(spark, warehouse.database("work")) as work:
        totals = temporary_table(kpi.order_totals(orders, items), work, "order_totals")
        base = temporary_table(rfm.rfm_base(totals, customers, orders), work, "rfm_base")
        marts = {
            "daily_kpi": kpi.daily_kpi(totals),
            "daily_kpi_by_category": kpi.daily_kpi_by_category(orders, items, tables["products"]),
            "cohort_retention": cohort.cohort_retention(cohort.monthly_activity(orders, customers)),
            "rfm_features": rfm.rfm_features(base),
        }

        def store(name: str) -> DataFrame:
            table = warehouse.write("gold", name, marts[name], order_by=mart_order(name))
            analyze(spark, warehouse.table("gold", name))
            return table

        gold = together(store, list(marts))
    gold["customer_churn_labels"] = warehouse.write(
        "gold", "customer_churn_labels", churn.customer_churn_labels(gold["rfm_features"])
    )
    analyze(spark, warehouse.table("gold", "customer_churn_labels"))
    return gold


def summarize(run: Run) -> dict[str, DataFrame]:
    """The figures shown at the end of each layer."""
    gold = run.gold
    return {
        "silver_row_counts": summaries.row_counts(run.silver),
        "gold_headlines": summaries.gold_headlines(
            gold["daily_kpi"],
            gold["cohort_retention"],
            gold["rfm_features"],
            gold["customer_churn_labels"],
        ),
        "segment_distribution": rfm.segment_distribution(gold["rfm_features"]),
        "churn_rate": churn.churn_rate(gold["customer_churn_labels"]),
        "date_range": summaries.date_range(run.silver["orders"]),
    }


def store_audit(warehouse: Warehouse, audit: DataFrame) -> DataFrame:
    """The audit's rows below the warehouse, in place of those of the run before."""
    path = f"{warehouse.location('work')}/audit"
    audit.write.mode("overwrite").parquet(path)
    return warehouse.spark.read.schema(audit.schema).parquet(path)


def run_pipeline(
    spark: SparkSession,
    source: str,
    root: str,
    prefix: str = "",
    as_of: datetime.datetime | None = None,
    fail_on: str | None = None,
) -> Run:
    """Rebuild everything from the raw files. Running it again changes nothing.

    A failed check is a row of the report unless ``fail_on`` names the status
    that shall raise.
    """
    warehouse = Warehouse(spark, root, prefix)
    with quick_listing(spark):
        layers = {layer: warehouse.database(layer) for layer in _COMMENTS}
        run = Run(land(warehouse, source), layers)
        run.bronze = build_bronze(warehouse)
        run.silver = build_silver(warehouse, run.bronze)
        run.gold = build_gold(warehouse, run.silver)
        run.summaries = summarize(run)
        audited = store_audit(warehouse, quality.audit(run.bronze, run.silver, run.gold, as_of))
    run.report = quality.audit_report(audited)
    run.summaries["completeness"] = quality.audit_row_counts(audited)
    if fail_on:
        quality.enforce(run.report, fail_on)
    return run
