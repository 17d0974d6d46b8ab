"""Every query by name, over the star tables of a folder."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.functions.money import money_avg, money_sum
from tallyloom.operators import churn, cohort, integrity, kpi, quality, rfm, silver, summaries
from tallyloom.plans import oracle
from tallyloom.plans.explain import plan_rows
from tallyloom.plans.pipeline import (
    Run,
    Warehouse,
    build_bronze,
    build_orders,
    land,
    mart_order,
    run_pipeline,
)
from tallyloom.schemas import RAW_COLUMNS, RAW_FILE_ENDINGS, RAW_TABLES, SILVER
from tallyloom.operators.ranking import Ranking, global_ntile
from tallyloom.sinks.parquet import plain_ids
from tallyloom.sinks.scratch import Scope, materialize, new_scratch_path, owned_by
from tallyloom.session import scoped, together
from tallyloom.sinks.tables import (
    column_statistics,
    create_database,
    database_list,
    insert_partitions,
    partition_list,
    partition_row_counts,
    read_partitions,
    row_count_statistic,
    small_splits,
    stored_order,
    table_list,
    write_partitions,
    write_table,
)
from tallyloom.sources import landing
from tallyloom.sources.csv import PACKED, read_raw, write_raw
from tallyloom.sources.star import raw_table, raw_tables, read_star

Query = Callable[[SparkSession, str], DataFrame]

PARAMETERS = {
    "day": "1998-01-15",
    "new_day": "2031-01-01",
    "first_day": "1998-01-01",
    "last_day": "1998-01-31",
    "cohort": "1995-01",
    "as_of": "2001-07-01 00:00:00",
    "lost_order": "7",
}


class Store:
    """Tables that several queries read, built on first use and kept until ``close``.

    The warehouse keeps its cleaned tables and two intermediate results on
    disk; marts and checks read those instead of cleaning the raw data again.
    """

    _kept: dict[tuple[str, str, str], object] = {}
    _scopes: dict[tuple[str, str], Scope] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    @property
    def scope(self) -> Scope:
        """Owner of all files and databases that are built over this folder."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        return self._scopes.setdefault(key, Scope(self.spark))

    def _keep(self, name: str, build: Callable[[], object]):
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in self._kept:
            with owned_by(self.scope):
                self._kept[key] = build()
        return self._kept[key]

    def _databases(self, name: str) -> str:
        """A prefix of database names, for databases that go with the scope."""
        prefix = f"{name}_{uuid4().hex[:8]}_"
        self.scope.databases += [f"{prefix}{layer}" for layer in ("bronze", "silver", "gold")]
        return prefix

    def _table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A stored table. A task reads so little that what it sorts and combines stays in memory, however large
        the input is."""

        def write() -> DataFrame:
            with small_splits(self.spark):
                df = build()
                return materialize(df, name, **plain_ids(df))

        return self._keep(name, write)

    def close(self) -> None:
        """Forget what was built over this folder; drop its databases and delete its files."""
        application = self.spark.sparkContext.applicationId
        for key in [k for k in self._kept if k[:2] == (application, self.sf_dir)]:
            del self._kept[key]
        self.scope.close()

    def silver(self, name: str) -> DataFrame:
        return self._table(f"silver_{name}", lambda: clean(self.spark, self.sf_dir, name))

    def silver_tables(self) -> dict[str, DataFrame]:
        return {name: self.silver(name) for name in SILVER}

    def totals(self) -> DataFrame:
        return self._table(
            "order_totals",
            lambda: kpi.order_totals(self.silver("orders"), self.silver("order_items")),
        )

    def activity(self) -> DataFrame:
        return cohort.monthly_activity(self.silver("orders"), self.silver("customers"))

    def rfm_base(self) -> DataFrame:
        return self._table(
            "rfm_base",
            lambda: rfm.rfm_base(
                self.totals(), self.silver("customers"), self.silver("orders")
            ),
        )

    def daily_kpi(self) -> DataFrame:
        return kpi.daily_kpi(self.totals())

    def retention(self) -> DataFrame:
        return cohort.cohort_retention(self.activity())

    def features(self) -> DataFrame:
        return self._table("rfm_features", lambda: rfm.rfm_features(self.rfm_base()))

    def labels(self) -> DataFrame:
        return churn.customer_churn_labels(self.features())

    def gold_tables(self) -> dict[str, DataFrame]:
        return {
            "daily_kpi": self.daily_kpi(),
            "cohort_retention": self.retention(),
            "rfm_features": self.features(),
            "customer_churn_labels": self.labels(),
        }

    def exported(self, entities: Iterable[str] = RAW_COLUMNS) -> str:
        """Folder with the raw tables as CSV, as a publisher would deliver them; of the entities, and of others
        that were asked for before."""
        path = self._keep("delivery", lambda: new_scratch_path(self.spark, "delivery"))

        def export(entity: str) -> None:
            df = raw_table(self.spark, self.sf_dir, entity)
            write_raw(df, f"{path}/{RAW_FILE_ENDINGS[entity]}", **PACKED)

        together(lambda entity: self._keep(f"delivery_{entity}", partial(export, entity)), entities)
        return path

    def landed(self, entities: Iterable[str] = RAW_COLUMNS) -> str:
        """Folder with the landed lines of the entities."""
        path = self._keep("bronze", lambda: new_scratch_path(self.spark, "bronze"))

        def land(entity: str) -> None:
            source = landing.source_paths(self.spark, self.exported([entity]), entities=[entity])
            landing.land_raw(self.spark, source, path, **PACKED)

        for entity in entities:
            self._keep(f"bronze_{entity}", partial(land, entity))
        return path

    def partitioned_orders(self) -> str:
        """Location of the orders, partitioned by day."""

        def write() -> str:
            path = new_scratch_path(self.spark, "orders_by_day")
            write_partitions(self.silver("orders"), path, ("dt",))
            return path

        return self._keep("orders_by_day", write)

    def smaller_delivery(self) -> str:
        """The orders as delivered, but without those of one day and one further order."""

        def export() -> str:
            path = new_scratch_path(self.spark, "delivery")
            day = F.col("order_purchase_timestamp").startswith(PARAMETERS["day"])
            orders = raw_table(self.spark, self.sf_dir, "orders")
            kept = orders.where(~day & (F.col("order_id") != PARAMETERS["lost_order"]))
            write_raw(kept, f"{path}/{RAW_FILE_ENDINGS['orders']}", **PACKED)
            return path

        return self._keep("smaller_delivery", export)

    def rebuilt_orders(self) -> DataFrame:
        """Orders after a run and a second one over the smaller delivery, in a session
        that replaces single partitions by default."""

        def rebuild() -> DataFrame:
            name = self._databases("rerun")
            warehouse = Warehouse(self.spark, new_scratch_path(self.spark, name), name)
            with scoped(self.spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
                for source in (self.exported(["orders"]), self.smaller_delivery()):
                    land(warehouse, source, ["orders"])
                    orders = build_bronze(warehouse, ["orders"])["orders"]
                    orders = build_orders(warehouse, orders)
            return orders

        return self._keep("rebuilt_orders", rebuild)

    def full_run(self) -> Run:
        """A run from the delivered CSV files to the checks, in its own databases."""

        def run() -> Run:
            name = self._databases("run")
            root = new_scratch_path(self.spark, name)
            return run_pipeline(self.spark, self.exported(), root, name, as_of())

        return self._keep("full_run", run)

    def backfilled(self) -> tuple[str, list[tuple]]:
        """A table of the orders by day after a backfill of one day it has and one it has not; the
        days that were written."""

        def build() -> tuple[str, list[tuple]]:
            name = f"{self._databases('backfill')}silver"
            path = new_scratch_path(self.spark, name)
            create_database(self.spark, name, "Orders by day, corrected", path)
            table = f"{name}.orders"
            write_table(self.silver("orders"), table, f"{path}/orders", ("dt",))
            day = self.silver("orders").where(F.col("dt") == PARAMETERS["day"])
            later = day.withColumns(
                {"order_id": F.concat(F.lit("new-"), "order_id"), "dt": F.lit(PARAMETERS["new_day"])}
            )
            corrected = day.unionByName(later).withColumn("order_status", F.lit("backfilled"))
            return table, insert_partitions(corrected, table)

        return self._keep("backfilled", build)

    def ordered_marts(self) -> dict[str, tuple[DataFrame, Column]]:
        """Three marts written in order, as many files as shuffle partitions, and the keys of their orders."""
        keys = {
            "daily_kpi": F.struct("dt"),
            "daily_kpi_by_category": F.struct("dt", F.isnull("gmv"), -F.col("gmv"), "category"),
            "cohort_retention": F.struct("cohort_month", "activity_month"),
        }

        def build() -> dict[str, DataFrame]:
            run = self.full_run()
            name = f"{self._databases('ordered')}gold"
            path = new_scratch_path(self.spark, name)
            create_database(self.spark, name, "Marts in order", path)
            with scoped(self.spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
                return {
                    mart: write_table(
                        run.gold[mart], f"{name}.{mart}", f"{path}/{mart}", order_by=mart_order(mart)
                    )
                    for mart in keys
                }

        written = self._keep("ordered_marts", build)
        return {mart: (written[mart], keys[mart]) for mart in keys}


def as_of() -> datetime.datetime:
    return datetime.datetime.fromisoformat(PARAMETERS["as_of"])


def clean(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A cleaned table straight from the raw rows."""
    raw = partial(raw_table, spark, sf_dir)
    builders = {
        "customers": lambda: silver.silver_customers(raw("customers")),
        "orders": lambda: silver.silver_orders(raw("orders")),
        "order_items": lambda: silver.silver_order_items(raw("order_items")),
        "products": lambda: silver.silver_products(
            raw("products"), raw("category_translation")
        ),
        "payments": lambda: silver.silver_payments(raw("payments")),
    }
    return builders[name]()


def _query(build: Callable[[Store], DataFrame]) -> Query:
    """A query whose intermediate files belong to the store of its folder."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = Store(spark, sf_dir)
        with owned_by(store.scope):
            return build(store)

    return query


def _scan(entity: str) -> Query:
    return _query(lambda s: read_raw(s.spark, s.landed([entity]), entity))


def _clean(name: str) -> Query:
    return lambda spark, sf_dir: clean(spark, sf_dir, name)


def _orphans(child: str, parent: str, key: str) -> Query:
    return _query(lambda s: integrity.orphan_keys(s.silver(child), s.silver(parent), key))


def _one_day(s: Store) -> DataFrame:
    orders = read_partitions(s.spark, s.partitioned_orders(), SILVER["orders"])
    return orders.where(F.col("dt") == PARAMETERS["day"])


def _backfill(s: Store) -> DataFrame:
    """Rewrite the days of one month in place; all other days stay as they are."""

    def write() -> str:
        path = new_scratch_path(s.spark, "orders_backfill")
        write_partitions(s.silver("orders"), path, ("dt",))
        return path

    path = s._keep("orders_backfill", write)
    month = F.col("dt").between(PARAMETERS["first_day"], PARAMETERS["last_day"])
    corrected = s.silver("orders").where(month).withColumn("order_status", F.lit("backfilled"))
    write_partitions(corrected, path, ("dt",))
    return read_partitions(s.spark, path, SILVER["orders"]).select(
        "order_id", "order_status", "dt"
    )


def _kpi_by_person(s: Store) -> DataFrame:
    people = s.silver("customers").select("customer_id", "customer_unique_id")
    daily = kpi.daily_kpi(s.totals().join(people, "customer_id"), "customer_unique_id")
    return daily.select("dt", "order_count", "unique_customers")


def _manifest_by_entry(s: Store) -> DataFrame:
    """Files of each delivered folder as they are named, with their counts added up.

    How many part files a folder has depends on the cores; its rows do not.
    """
    files = landing.landing_manifest(s.spark, s.exported()).withColumn(
        "entry", F.element_at(F.split("file", "/"), -2)
    )
    return files.groupBy("target", "entry").agg(
        F.sum("record_count").alias("record_count"),
        (F.count("file") == F.count_distinct("file")).alias("each_file_once"),
    )


def _money_sums(s: Store) -> DataFrame:
    """Sums of amounts with more than four decimals, rounded for comparison alone."""
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount")) / 7000
    summed = read_star(s.spark, s.sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus")
    return summed.agg(
        F.round(money_sum(amount), 5).alias("amount"),
        F.round(money_avg(amount), 5).alias("mean"),
    )


def _kpi_of_days(s: Store) -> DataFrame:
    """Figures of the last day of each month, from orders that are stored by day."""
    orders = read_partitions(s.spark, s.partitioned_orders(), SILVER["orders"])
    days = s._table("days", lambda: kpi.month_ends(s.silver("orders"))).where("dt = last_dt")
    return kpi.daily_kpi(kpi.order_totals(kpi.orders_of_days(orders, days), s.silver("order_items")))


def _plan_one_day(s: Store) -> DataFrame:
    """The scan of one day: its filters, the exchanges of its plan and the days that it finds."""
    day = _one_day(s)
    rows = plan_rows(day)
    exchanges = rows.agg(F.count_if(F.col("node").endswith("Exchange"))).scalar()
    return rows.where(F.col("node").startswith("Scan")).select(
        "node",
        "partition_filters",
        "pushed_filters",
        exchanges.alias("exchanges"),
        day.agg(F.count_distinct("dt")).scalar().alias("days"),
    )


def _rfm_scores_ties(s: Store) -> DataFrame:
    """Customers per score and value where values alone rank them: equal ones are shared out."""
    rankings = {
        "recency_days": Ranking("recency_days", descending=True),
        "frequency": Ranking("frequency"),
        "monetary": Ranking("monetary"),
    }
    tiles = {name: f"{name}_tile" for name in rankings}
    scored = global_ntile(s.rfm_base(), {tiles[name]: ranking for name, ranking in rankings.items()})
    return reduce(
        DataFrame.unionByName,
        [
            scored.groupBy(F.col(tile).alias("tile"), F.col(name).cast("double").alias("value"))
            .agg(F.count(F.lit(1)).alias("customers"))
            .select(F.lit(name).alias("ranked_by"), "tile", "value", "customers")
            for name, tile in tiles.items()
        ],
    )


def _backfill_table(s: Store) -> DataFrame:
    return s.spark.table(s.backfilled()[0]).select("order_id", "order_status", "dt")


def _partition_statistics(s: Store) -> DataFrame:
    return partition_row_counts(s.spark, *s.backfilled())


def _column_statistics(s: Store) -> DataFrame:
    """Stored statistics of the orders' columns, the estimated distinct counts held against the exact ones."""
    run = s.full_run()
    kept = column_statistics(s.spark, f"{run.databases['silver']}.orders")
    orders = run.silver["orders"]
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in orders.columns]).unpivot(
        [], orders.columns, "column_name", "exact"
    )
    error = F.abs(F.col("distinct_count") - F.col("exact"))
    return kept.join(exact, "column_name").select(
        "column_name",
        F.col("exact").alias("distinct_count"),
        "null_count",
        (error <= 0.15 * F.col("exact")).alias("estimate_holds"),
    )


def _stored_order(s: Store) -> DataFrame:
    found = [
        stored_order(table, key).select(
            F.lit(mart).alias("table_name"),
            "row_count",
            "out_of_order",
            (F.col("file_count") > 1).alias("several_files"),
        )
        for mart, (table, key) in s.ordered_marts().items()
    ]
    return reduce(DataFrame.unionByName, found)


def _full_run_databases(s: Store) -> DataFrame:
    """Comment of each layer's database, its tables, and whether all of these lie below its folder."""
    run = s.full_run()
    databases = database_list(s.spark, run.databases)
    tables = reduce(
        DataFrame.unionByName,
        [table_list(s.spark, database, layer) for layer, database in run.databases.items()],
    )
    counts = tables.groupBy("layer").agg(F.count(F.lit(1)).alias("table_count"))
    own_folder = F.element_at(F.split("location", "/"), -1) == F.col("layer")
    return databases.join(counts, "layer").select(
        "layer", "comment", "table_count", own_folder.alias("in_own_folder")
    )


def _full_run_tables(s: Store) -> DataFrame:
    databases = s.full_run().databases
    return reduce(
        DataFrame.unionByName,
        [table_list(s.spark, database, layer) for layer, database in databases.items()],
    )


def _full_run_statistics(s: Store) -> DataFrame:
    run = s.full_run()
    return reduce(
        DataFrame.unionByName,
        [
            row_count_statistic(s.spark, f"{run.databases[layer]}.{name}", name)
            for layer, tables in (("silver", run.silver), ("gold", run.gold))
            for name in tables
        ],
    )


def _report(s: Store) -> DataFrame:
    return s._table(
        "quality_report",
        lambda: quality.quality_report(
            raw_tables(s.spark, s.sf_dir),
            s.silver_tables(),
            s.gold_tables(),
            as_of(),
        ),
    )


def _completeness(s: Store) -> DataFrame:
    bronze = raw_tables(s.spark, s.sf_dir)
    del bronze["category_translation"]
    return summaries.layer_row_counts(
        {"bronze": bronze, "silver": s.silver_tables(), "gold": s.gold_tables()}
    )


QUERIES: dict[str, Query] = {
    **{f"scan_{RAW_TABLES[entity]}": _scan(entity) for entity in RAW_COLUMNS},
    "bronze_row_counts": lambda spark, sf_dir: summaries.row_counts(
        raw_tables(spark, sf_dir)
    ),
    "landing_manifest_files": _query(_manifest_by_entry),
    "landing_manifest": _query(
        lambda s: landing.landing_manifest(s.spark, s.exported())
        .groupBy("target")
        .agg(F.sum("record_count").alias("record_count"))
    ),
    **{f"silver_{name}": _clean(name) for name in SILVER},
    "orders_one_day": _query(_one_day),
    "orders_backfill": _query(_backfill),
    "silver_row_counts": _query(lambda s: summaries.row_counts(s.silver_tables())),
    "daily_kpi": _query(Store.daily_kpi),
    "daily_kpi_by_person": _query(_kpi_by_person),
    "daily_kpi_by_category": _query(
        lambda s: kpi.daily_kpi_by_category(
            s.silver("orders"), s.silver("order_items"), s.silver("products")
        )
    ),
    "kpi_range": _query(
        lambda s: kpi.kpi_range(
            s.daily_kpi(), PARAMETERS["first_day"], PARAMETERS["last_day"]
        )
    ),
    "monthly_activity": _query(Store.activity),
    "customer_cohorts": _query(lambda s: cohort.customer_cohorts(s.activity())),
    "cohort_retention": _query(Store.retention),
    "cohort_curve": _query(
        lambda s: cohort.cohort_curve(s.retention(), PARAMETERS["cohort"])
    ),
    "rfm_base": _query(
        lambda s: rfm.rfm_base(s.totals(), s.silver("customers"), s.silver("orders"))
    ),
    "rfm_scores": _query(
        lambda s: rfm.rfm_scores(s.rfm_base()).drop(
            "first_order_date", "last_order_date", "avg_order_value"
        )
    ),
    "rfm_features": _query(lambda s: rfm.rfm_features(s.rfm_base())),
    "rfm_scores_narrowed": _query(
        lambda s: rfm.rfm_scores(s.rfm_base(), leaf_rows=20, sample_rows=400).drop(
            "first_order_date", "last_order_date", "avg_order_value"
        )
    ),
    "money_sums": _query(_money_sums),
    "segment_distribution": _query(lambda s: rfm.segment_distribution(s.features())),
    "segment_spend": _query(lambda s: rfm.segment_spend(s.features())),
    "customer_churn_labels": _query(Store.labels),
    "churn_rate": _query(lambda s: churn.churn_rate(s.labels())),
    "churn_value": _query(lambda s: churn.churn_value(s.labels())),
    "gold_headlines": _query(
        lambda s: summaries.gold_headlines(
            s.daily_kpi(), s.retention(), s.features(), s.labels()
        )
    ),
    "duplicate_orders_raw": _query(
        lambda s: integrity.duplicate_keys(
            raw_table(s.spark, s.sf_dir, "orders"), "order_id"
        )
    ),
    "duplicate_products": _query(
        lambda s: integrity.duplicate_keys(s.silver("products"), "product_id")
    ),
    "orphan_order_customers": _orphans("orders", "customers", "customer_id"),
    "orphan_item_orders": _orphans("order_items", "orders", "order_id"),
    "orphan_item_products": _orphans("order_items", "products", "product_id"),
    "orphan_payment_orders": _orphans("payments", "orders", "order_id"),
    "quality_report": _query(_report),
    "completeness": _query(_completeness),
    "full_run_report": _query(lambda s: s.full_run().report),
    "full_run_row_counts": _query(lambda s: s.full_run().summaries["completeness"]),
    "full_run_rfm_features": _query(lambda s: s.full_run().gold["rfm_features"]),
    **{
        f"full_run_silver_{name}": _query(lambda s, name=name: s.full_run().silver[name])
        for name in SILVER
    },
    **{
        f"full_run_{name}": _query(lambda s, name=name: s.full_run().gold[name])
        for name in ("daily_kpi", "cohort_retention", "customer_churn_labels")
    },
    "full_run_tables": _query(_full_run_tables),
    "full_run_statistics": _query(_full_run_statistics),
    "rerun_orders": _query(
        lambda s: s.rebuilt_orders().groupBy("dt").agg(F.count("*").alias("order_count"))
    ),
    "full_run_kpi_by_category": _query(
        lambda s: s.full_run().gold["daily_kpi_by_category"]
    ),
    "rfm_scores_ties": _query(_rfm_scores_ties),
    "backfill_table": _query(_backfill_table),
    "backfill_partitions": _query(lambda s: partition_list(s.spark, s.backfilled()[0])),
    "partition_statistics": _query(_partition_statistics),
    "column_statistics": _query(_column_statistics),
    "stored_order": _query(_stored_order),
    "kpi_of_days": _query(_kpi_of_days),
    "plan_orders_one_day": _query(_plan_one_day),
    "full_run_databases": _query(_full_run_databases),
    "date_range": _query(lambda s: summaries.date_range(s.silver("orders"))),
}


def oracle_sql() -> dict[str, str]:
    return oracle.statements(
        {**PARAMETERS, "endings": RAW_FILE_ENDINGS, "order_columns": SILVER["orders"].names}
    )
