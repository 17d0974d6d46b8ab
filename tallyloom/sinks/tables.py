"""Databases and ORC tables."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tallyloom.schemas import raw_schema
from tallyloom.session import scoped
from tallyloom.sinks.orc import orc_options
from tallyloom.sinks.scratch import remove_path
from tallyloom.sources.csv import CSV_FORMAT

#: Folders of a table's versions begin with it.
_VERSION = "version-"

#: Size of the pieces into which a large day is cut, one file each.
FILE_BYTES = "256MB"


def _partitioned_write(file_bytes: str) -> dict[str, str]:
    """Settings of a write by day.

    It opens one file per day, which costs time by the file and not by the byte.
    There are more shuffle partitions than days, so a partition holds one or two
    days and is cut into few large files; the low minimum lets a small table use
    all cores.
    """
    return {
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": file_bytes,
    }



def quick_listing(spark: SparkSession) -> AbstractContextManager[None]:
    """List partition folders with a task per core; the default is one per folder."""
    lister = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    return scoped(spark, {lister: spark.sparkContext.defaultParallelism})


def small_splits(spark: SparkSession) -> AbstractContextManager[None]:
    """Scans of packed files with a few rows to a task, which sorts and combines them in memory.

    Rows take several times the bytes there that they have on disk: at the default of 128 MB a task would sort some
    6 million orders and spill.
    """
    return scoped(spark, {"spark.sql.files.maxPartitionBytes": "16MB"})


def create_database(spark: SparkSession, name: str, comment: str, location: str) -> None:
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT '{comment}' LOCATION '{location}'"
    )


def create_raw_table(spark: SparkSession, table: str, entity: str, location: str) -> None:
    """External CSV table over a landed folder; dropping it keeps the files."""
    columns = ", ".join(f"`{field.name}` STRING" for field in raw_schema(entity))
    options = ", ".join(
        "'{}' '{}'".format(k, v.replace("\\", "\\\\")) for k, v in CSV_FORMAT.items()
    )
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING csv OPTIONS ({options}) LOCATION '{location}'"
    )


def _by_partition(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Bring each partition value together, but split the large ones.

    Without it every task writes a file for every day. A plain repartition by
    day would send a day that holds a third of the rows to one task; the
    rebalance lets adaptive execution cut it into pieces of the advisory size.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_table(
    df: DataFrame,
    table: str,
    location: str,
    partition_by: tuple[str, ...] = (),
    order_by: tuple = (),
    file_bytes: str = FILE_BYTES,
) -> DataFrame:
    """Rebuild an ORC table as a whole and return it.

    The new rows go to a new folder below ``location`` and to a table of their own, which then
    takes the name of the old one: until then, and if the write fails, the old table can be
    read as it was. Its folder is deleted at the end. One writer of a table at a time.
    """
    spark = df.sparkSession
    fresh, former = f"{table}__next", f"{table}__former"
    _undo_switch(spark, table, former)
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    version = f"{location}/{_VERSION}{uuid4().hex}"
    rows = df.orderBy(*order_by) if order_by else _by_partition(df, partition_by)
    writer = rows.write.format("orc").options(**orc_options(df, partition_by)).option("path", version)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        if partition_by:
            with scoped(spark, _partitioned_write(file_bytes)):
                writer.saveAsTable(fresh)
        else:  # no setting is changed, so such writes may run at the same time
            writer.saveAsTable(fresh)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        remove_path(spark, version)
        raise
    old = None
    if spark.catalog.tableExists(table):
        old = table_location(spark, table)
        spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    if old is not None:
        spark.sql(f"DROP TABLE {former}")
        if old.rpartition("/")[2].startswith(_VERSION):
            remove_path(spark, old)
    return spark.table(table)


def _undo_switch(spark: SparkSession, table: str, former: str) -> None:
    """After a run that ended between the two renamings, give the old table its name back."""
    if spark.catalog.tableExists(former):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {former}")
        else:
            spark.sql(f"ALTER TABLE {former} RENAME TO {table}")


def table_location(spark: SparkSession, table: str) -> str:
    """Folder of a table's files."""
    described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'")
    return described.first().data_type.rstrip("/")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def insert_partitions(df: DataFrame, table: str, file_bytes: str = FILE_BYTES) -> list[tuple]:
    """Replace the partitions of a stored table that occur in ``df``, and add those that are new.

    It goes through the catalog, which learns the new partitions, and collects the
    statistics of the written ones. All other partitions stay as they are. ``df`` has the table's
    columns, in any order, and must not read from the table itself. Returns the
    values of the written partitions.
    """
    spark = df.sparkSession
    by = tuple(partition_columns(spark, table))
    if not by:
        raise ValueError(f"{table} has no partitions")
    dynamic = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
    with scoped(spark, {**dynamic, **_partitioned_write(file_bytes)}):
        _by_partition(df.select(*spark.table(table).columns), by).write.insertInto(table, overwrite=True)
    written = [tuple(row) for row in df.select(*by).distinct().orderBy(*by).collect()]
    analyze_partitions(spark, table, written)
    return written


def _partition(columns: list[str], values: tuple) -> str:
    quoted = (str(value).replace("\\", "\\\\").replace("'", "\\'") for value in values)
    return ", ".join(f"`{name}` = '{value}'" for name, value in zip(columns, quoted))


def analyze_partitions(spark: SparkSession, table: str, values: list[tuple]) -> None:
    """Row counts and sizes of the given partitions; several are read at the same time."""
    columns = partition_columns(spark, table)

    def one(value: tuple) -> None:
        spark.sql(f"ANALYZE TABLE {table} PARTITION ({_partition(columns, value)}) COMPUTE STATISTICS")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(one, values))


def partition_row_counts(spark: SparkSession, table: str, values: list[tuple]) -> DataFrame:
    """Partition columns and row_count, as the catalog keeps them; null if it keeps none."""
    columns = partition_columns(spark, table)

    def kept(value: tuple) -> int | None:
        shown = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({_partition(columns, value)})")
        said = shown.where("col_name = 'Partition Statistics'").collect()
        found = re.search(r"([0-9]+) rows", said[0].data_type) if said else None
        return int(found.group(1)) if found else None

    rows = [(*map(str, value), kept(value)) for value in values]
    fields = ", ".join(f"`{name}` string" for name in columns)
    return spark.createDataFrame(rows, f"{fields}, row_count long")


def partition_list(spark: SparkSession, table: str) -> DataFrame:
    """(partition): the partitions that the catalog knows."""
    return spark.sql(f"SHOW PARTITIONS {table}")


def column_statistics(spark: SparkSession, table: str) -> DataFrame:
    """(column_name, distinct_count, null_count) that the catalog keeps, the former estimated."""
    rows = []
    for column in spark.catalog.listColumns(table):
        said = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {table} `{column.name}`").collect()}
        counts = (said.get(name, "NULL") for name in ("distinct_count", "num_nulls"))
        rows.append((column.name, *(None if count == "NULL" else int(count) for count in counts)))
    return spark.createDataFrame(rows, "column_name string, distinct_count long, null_count long")


def stored_order(table: DataFrame, key: Column) -> DataFrame:
    """(file_count, row_count, out_of_order) of a stored table that should ascend by ``key``.

    Rows are compared with the one before them in their file, and each file's smallest key with the
    largest of the file before it, by the number that Spark gives to files: one row per
    file is all that one task sees.
    """
    placed = table.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        key.alias("key"),
    )
    before = F.lag("key").over(Window.partitionBy("file").orderBy("block", "at"))
    files = (
        placed.withColumn("late", before > F.col("key"))
        .groupBy("file")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if("late").alias("late"),
            F.min("key").alias("low"),
            F.max("key").alias("high"),
        )
    )
    number = F.regexp_extract("file", r"part-([0-9]+)", 1).cast("int")
    chunk = F.regexp_extract("file", r"[-.]c([0-9]+)[^/]*$", 1).cast("int")
    overlaps = F.lag("high").over(Window.orderBy(number, chunk)) > F.col("low")
    return files.withColumn("overlaps", overlaps).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("rows").alias("row_count"),
        (F.sum("late") + F.count_if("overlaps")).alias("out_of_order"),
    )


def database_list(spark: SparkSession, databases: dict[str, str]) -> DataFrame:
    """(layer, comment, location) of databases by layer, from the catalog."""
    rows = []
    for layer, name in databases.items():
        found = spark.catalog.getDatabase(name)
        rows.append((layer, found.description, found.locationUri))
    return spark.createDataFrame(rows, "layer string, comment string, location string")


def write_partitions(
    df: DataFrame, location: str, partition_by: tuple[str, ...], file_bytes: str = FILE_BYTES
) -> None:
    """Write ORC partitions, replacing those that occur in ``df`` and no others."""
    with scoped(df.sparkSession, _partitioned_write(file_bytes)):
        (
            _by_partition(df, partition_by)
            .write.format("orc")
            .mode("overwrite")
            .options(**orc_options(df, partition_by), partitionOverwriteMode="dynamic")
            .partitionBy(*partition_by)
            .save(location)
        )


def read_partitions(spark: SparkSession, location: str, schema: StructType) -> DataFrame:
    """Scan partitioned ORC. The schema keeps partition values as declared."""
    with quick_listing(spark):
        return spark.read.schema(schema).orc(location)


def analyze(spark: SparkSession, table: str, columns: bool = False) -> None:
    """Collect table statistics, and column statistics if asked."""
    suffix = " FOR ALL COLUMNS" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{suffix}")


def row_count_statistic(spark: SparkSession, table: str, label: str) -> DataFrame:
    """(table_name, row_count): the number of rows that the catalog keeps of a table."""
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'")
    rows = F.regexp_extract("data_type", "([0-9]+) rows", 1).try_cast("long")
    return described.select(F.lit(label).alias("table_name"), rows.alias("row_count"))


def table_list(spark: SparkSession, database: str, layer: str) -> DataFrame:
    """(layer, table_name) of a database, from the catalog."""
    shown = spark.sql(f"SHOW TABLES IN `{database}`").where(~F.col("isTemporary"))
    return shown.select(F.lit(layer).alias("layer"), F.col("tableName").alias("table_name"))


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
