"""Tables of the catalog: rebuilds, backfills, statistics, order and the life of scratch files."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import kpi
from tallyloom.operators.hot_join import hot_key_join, hot_keys
from tallyloom.plans.explain import plan_rows
from tallyloom.plans.registry import QUERIES, Store
from tallyloom.schemas import RAW_FILE_ENDINGS
from tallyloom.sinks import scratch, tables
from tallyloom.sinks.orc import orc_options

SCHEMA = "order_id string, dt string"
FIRST = [("1", "2018-01-01"), ("2", "2018-01-02"), ("3", "2018-01-02")]
DATA = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark, tmp_path):
    name = f"warehouse_{tmp_path.name.replace('-', '_')}"
    tables.create_database(spark, name, "for a test", str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_failed_rebuild_leaves_the_old_rows(spark, database, tmp_path):
    table, location = f"{database}.orders", str(tmp_path / "orders")
    tables.write_table(spark.createDataFrame(FIRST, SCHEMA), table, location, ("dt",))
    broken = spark.createDataFrame(FIRST, SCHEMA).repartition(2).withColumn(
        "order_id", F.when(F.col("order_id") == "3", F.raise_error(F.lit("lost"))).otherwise("new")
    )
    for by in (("dt",), ()):
        with pytest.raises(Exception, match="lost"):
            tables.write_table(broken, table, location, by)
        assert _rows(spark.table(table)) == FIRST
        assert tables.list_tables(spark, database) == ["orders"]
        assert len(list((tmp_path / "orders").iterdir())) == 1, "what was written in part is deleted"


def test_a_rebuild_replaces_rows_partitions_and_files(spark, database, tmp_path):
    table, location = f"{database}.orders", str(tmp_path / "orders")
    tables.write_table(spark.createDataFrame(FIRST, SCHEMA), table, location, ("dt",))
    # A run that ended between the two renamings left no table of the name.
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__former")
    second = tables.write_table(spark.createDataFrame([("4", "2018-01-03")], SCHEMA), table, location, ("dt",))
    assert _rows(second) == [("4", "2018-01-03")]
    assert _rows(tables.partition_list(spark, table)) == [("dt=2018-01-03",)]
    assert [p.name for p in (tmp_path / "orders").iterdir()] == [tables.table_location(spark, table).rpartition("/")[2]]
    wider = spark.createDataFrame([("5", 1)], "order_id string, other int")
    assert _rows(tables.write_table(wider, table, location)) == [("5", 1)], "columns may change"


def test_a_backfill_reaches_the_catalog_and_its_statistics(spark, database, tmp_path):
    table = f"{database}.orders"
    tables.write_table(spark.createDataFrame(FIRST, SCHEMA), table, str(tmp_path / "orders"), ("dt",))
    later = spark.createDataFrame([("2018-01-02", "4"), ("it's", "5"), ("it's", "6")], "dt string, order_id string")
    written = tables.insert_partitions(later, table)
    assert written == [("2018-01-02",), ("it's",)]
    assert _rows(spark.table(table)) == [("1", "2018-01-01"), ("4", "2018-01-02"), ("5", "it's"), ("6", "it's")]
    assert len(tables.partition_list(spark, table).collect()) == 3
    counts = tables.partition_row_counts(spark, table, [("2018-01-01",), *written])
    assert _rows(counts.fillna(-1)) == [("2018-01-01", -1), ("2018-01-02", 1), ("it's", 2)], "only written days are read"
    tables.analyze(spark, table, columns=True)
    assert _rows(tables.column_statistics(spark, table)) == [("dt", 3, 0), ("order_id", 4, 0)]
    flat = f"{database}.flat"
    tables.write_table(later, flat, str(tmp_path / "flat"))
    with pytest.raises(ValueError, match="no partitions"):
        tables.insert_partitions(later, flat)


def test_rows_out_of_order_are_counted(spark, tmp_path):
    rows = spark.range(1_000).select((F.col("id") % 1_000).alias("n"), (-F.col("id")).alias("m"))

    def order(df, name):
        df.write.orc(str(tmp_path / name))
        return tuple(tables.stored_order(spark.read.orc(str(tmp_path / name)), F.struct("n")).first())

    assert order(rows.repartitionByRange(4, "n").sortWithinPartitions("n"), "good") == (4, 1_000, 0)
    assert order(rows.repartition(4, "n").sortWithinPartitions("n"), "files")[2] == 3
    assert order(rows.coalesce(1).sortWithinPartitions("m"), "rows") == (1, 1_000, 999)
    assert order(rows.limit(0), "none") == (0, None, None)


def test_days_of_another_table_prune_the_scan(spark, tmp_path):
    """Files of other days are no ORC files: opening one would fail."""
    path = tmp_path / "orders"
    tables.write_partitions(spark.createDataFrame(FIRST + [("9", "2018-01-31")], SCHEMA), str(path), ("dt",))
    for file in [*path.glob("dt=2018-01-01/*.orc"), *path.glob("dt=2018-01-02/*.orc")]:
        file.write_bytes(b"not read" * 9)
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    orders = tables.read_partitions(spark, str(path), spark.createDataFrame([], SCHEMA).schema)
    days = scratch.materialize(kpi.month_ends(spark.createDataFrame(FIRST + [("9", "2018-01-31")], SCHEMA)), "days")
    found = kpi.orders_of_days(orders, days.where("dt = last_dt"))
    assert _rows(found.select("order_id")) == [("9",)]
    filters = [r.partition_filters for r in plan_rows(found).where("node LIKE 'Scan orc%'").collect()]
    assert any("dynamicpruningexpression" in f for f in filters)


def _largest(joined):
    """Rows of the largest task of a join."""
    loads = joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("rows"), F.count("said"))
    return max(r["rows"] for r in loads.collect())


def test_a_hot_key_is_cut_without_adaptive_execution(spark):
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "40",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        large = spark.range(60_000).select(
            "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1_000 != 1, F.col("id").cast("string")).alias("key")
        )
        small = large.select("key").distinct().where("key is null or key != '2'").withColumn("said", F.concat(F.lit("k"), "key"))
        for how in ("inner", "left"):
            hot = hot_keys(large, ["key"], share=0.005, least=100)
            joined = hot_key_join(large, small, ["key"], hot, ["id"], how)
            assert _rows(joined.fillna("")) == _rows(large.join(small, "key", how).fillna(""))
            assert _largest(joined) <= 0.1 * 60_000
            assert _largest(large.join(small, "key", how)) >= 0.3 * 60_000
        assert _rows(hot.select("key", "_pieces")) == [("hot", 67)]
        with pytest.raises(ValueError, match="inner or left"):
            hot_key_join(large, small, ["key"], hot, ["id"], "right")
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _left(spark):
    folder = Path(scratch.scratch_dir(spark).removeprefix("file://")) / "tallyloom"
    return {p.name for p in folder.iterdir()} if folder.is_dir() else set()


def test_a_scope_deletes_what_was_written_in_it(spark):
    before = _left(spark)
    with scratch.scratch_scope(spark) as scope:
        kept = scratch.materialize(spark.range(5), "numbers")
        with scratch.scratch_scope(spark):
            scratch.materialize(spark.range(5), "inner")
            assert len(_left(spark) - before) == 2
        assert len(_left(spark) - before) == 1 and kept.count() == 5
        tables.create_database(spark, "scoped_gold", "c", scratch.new_scratch_path(spark, "gold"))
        scope.databases.append("scoped_gold")
        tables.write_table(spark.range(3).toDF("n"), "scoped_gold.t", scratch.new_scratch_path(spark, "t"))
    assert _left(spark) == before and not spark.catalog.databaseExists("scoped_gold")
    with pytest.raises(ZeroDivisionError), scratch.scratch_scope(spark):
        scratch.materialize(spark.range(5), "numbers")
        raise ZeroDivisionError
    assert _left(spark) == before


def test_closing_a_store_leaves_nothing(spark, tmp_path):
    """Over a folder of its own, so that the queries of other tests keep what they share."""
    data = tmp_path / "data"
    data.symlink_to(DATA)
    before, databases = _left(spark), {d.name for d in spark.catalog.listDatabases()}
    for name in ("rfm_scores_ties", "full_run_daily_kpi", "backfill_table", "orders_backfill", "rerun_orders", "landing_manifest"):
        assert QUERIES[name](spark, str(data)).count()
    assert _left(spark) != before
    Store(spark, str(data)).close()
    assert _left(spark) == before
    assert {d.name for d in spark.catalog.listDatabases()} == databases


def _sources(spark, data, name):
    """Last part of the folders that a store wrote for one query."""
    store = Store(spark, str(data))
    try:
        QUERIES[name](spark, str(data)).collect()
        return sorted(e.name for path in store.scope.paths if Path(path).is_dir() for e in Path(path).iterdir() if e.is_dir())
    finally:
        store.close()


@pytest.mark.parametrize("entity", ["customers", "category_translation"])
def test_a_scan_delivers_and_lands_its_own_table_alone(spark, tmp_path, entity):
    data = tmp_path / "sf"
    data.symlink_to(DATA)
    assert _sources(spark, data, f"scan_{entity}_raw") == sorted([entity, RAW_FILE_ENDINGS[entity]])


def test_a_second_scan_shares_the_folders_of_the_first(spark, tmp_path):
    data = tmp_path / "sf"
    data.symlink_to(DATA)
    store = Store(spark, str(data))
    first, again = store.landed(["products"]), store.landed(["products", "payments"])
    written = {p: p.stat().st_mtime_ns for p in Path(first).glob("products/part-*")}
    assert first == again == store.landed()
    assert written == {p: p.stat().st_mtime_ns for p in Path(first).glob("products/part-*")}
    assert sorted(p.name for p in Path(first).iterdir()) == sorted(RAW_FILE_ENDINGS)
    store.close()


def test_ids_are_stored_without_a_dictionary(spark, database, tmp_path):
    df = spark.range(2000).selectExpr(
        "concat('order-number-', id % 10) AS order_id",
        "concat('order-number-', id % 10) AS status",
        "cast(id % 3 AS int) AS order_item_id",
        "'d' AS day_id",
    )
    assert orc_options(df, ("day_id",))["orc.column.encoding.direct"] == "order_id"
    assert "orc.column.encoding.direct" not in orc_options(df.select("status", "order_item_id"))
    stored = tables.write_table(df, f"{database}.t", str(tmp_path / "t"), ("day_id",))
    assert _rows(stored) == _rows(df)

    def encodings(folder):
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        (file,) = Path(folder).rglob("*.orc")
        reader = jvm.org.apache.orc.OrcFile.createReader(
            jvm.org.apache.hadoop.fs.Path(str(file)), jvm.org.apache.orc.OrcFile.readerOptions(conf)
        )
        footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
        names = list(reader.getSchema().getFieldNames())
        return {name: str(footer.getColumns(i + 1).getKind()) for i, name in enumerate(names)}

    found = encodings(tmp_path / "t")
    assert (found["order_id"], found["status"]) == ("DIRECT_V2", "DICTIONARY_V2")
    with scratch.work_database(spark, f"{database}_work") as work:
        table = scratch.temporary_table(df.coalesce(1), work, "t")
        found = encodings(tables.table_location(spark, f"`{work}`.t").removeprefix("file:"))
        assert (found["order_id"], found["day_id"]) == ("DIRECT_V2", "DIRECT_V2")
        assert _rows(table) == _rows(df)
    tables.write_partitions(df.coalesce(1), str(tmp_path / "p"), ("day_id",))
    assert encodings(tmp_path / "p")["order_id"] == "DIRECT_V2"


def test_tables_of_the_store_are_built_by_small_tasks(spark, tmp_path):
    """So sorts and sums stay in memory however large a file is; ids and amounts are written without a dictionary."""
    key, seen = "spark.sql.files.maxPartitionBytes", []

    def build():
        seen.append(spark.conf.get(key))
        return spark.range(2000, numPartitions=1).selectExpr(
            "concat('order-number-', id % 10) AS order_id", "concat('state-', id % 10) AS status", "id % 10 / 4 AS price"
        )

    before = spark.conf.get(key)
    store = Store(spark, str(tmp_path))
    stored = store._table("t", build)
    assert _rows(stored) == _rows(build())
    assert seen == ["16MB", before] and spark.conf.get(key) == before
    (file,) = (f.removeprefix("file://") for f in stored.inputFiles())
    group = pq.ParquetFile(file).metadata.row_group(0)
    dictionaries = {group.column(i).path_in_schema: group.column(i).has_dictionary_page for i in range(group.num_columns)}
    assert dictionaries == {"order_id": False, "status": True, "price": False}
    store.close()
