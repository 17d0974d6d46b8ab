import datetime
import threading

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.quality import QualityError
from tallyloom.plans.explain import plan_rows
from tallyloom.plans import pipeline
from tallyloom.plans.pipeline import run_pipeline
from tallyloom.schemas import RAW_COLUMNS, RAW_FILE_ENDINGS, SILVER
from tallyloom.sinks import tables
from tallyloom.sources import landing
from tallyloom.sources.csv import PACKED, read_raw, write_raw

LINES = {
    "orders": [
        "o1,c1,delivered,2018-01-01 10:00:00,,,2018-01-05 00:00:00,2018-01-20 00:00:00",
        "o1,c1,delivered,2018-01-02 10:00:00,,,,",
        "o2,c2, Delivered ,2018-02-03 11:00:00,2018-02-03 12:00:00,,2018-02-01 00:00:00,",
        "o3,c3,shipped,2018-03-04 11:00:00,,,,",
        ",c4,shipped,2018-03-04 11:00:00,,,,",
    ],
    "customers": ["c1,ann,01151,sao paulo,SP", 'c2,ann,1,"a, b",rj', "c3,bob,2,x,y"],
    "order_items": [
        "o1,1,p1,s,2018-01-03 00:00:00,58.90,13.29",
        "o1,2,p2,s,,1.10,0.01",
        "o2,1,p1,s,,10.00,2.00",
        "o9,1,p9,s,,5.00,1.00",
    ],
    "products": ["p1,Artes,40,287,1,225,16,10,14", "p2,,,,,,,,"],
    "payments": ["o1,1,voucher,1,10.00", "o1,2,credit_card,3,63.30", "o2,1,boleto,1,12.00"],
    "category_translation": ["artes,art"],
}


def _deliver(folder, lines=LINES, prefix="shop_"):
    for entity, rows in lines.items():
        text = "\n".join([",".join(RAW_COLUMNS[entity]), *rows]) + "\n"
        (folder / f"{prefix}{RAW_FILE_ENDINGS[entity]}").write_text(text)
    return str(folder)


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    return _deliver(tmp_path_factory.mktemp("source"))


@pytest.fixture(scope="module")
def run(spark, source, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    as_of = datetime.datetime(2018, 3, 1)
    for _ in range(2):  # a second run rebuilds the same tables
        done = run_pipeline(spark, source, root, prefix="t_", as_of=as_of)
    return done


def test_landing_keeps_every_line_and_counts_them(spark, source, tmp_path):
    target = str(tmp_path / "bronze")
    landing.land_raw(spark, source, target)
    landing.land_raw(spark, source, target)
    for entity, lines in LINES.items():
        landed = spark.read.text(f"{target}/{entity}")
        assert sorted(r.value for r in landed.collect()) == sorted(lines)
    manifest = landing.landing_manifest(spark, source).collect()
    assert {(r.file.rsplit("/", 1)[1], r.target, r.record_count) for r in manifest} == {
        (f"shop_{RAW_FILE_ENDINGS[entity]}", entity, len(lines))
        for entity, lines in LINES.items()
    }
    listing = landing.bronze_listing(spark, target).collect()
    assert len(listing) >= len(LINES) and all(r.length > 0 for r in listing)


ODD_LINES = [
    b"o1,1,vou\x01cher,1,10.00", b"#o4,1,c,1,5", b"o5,\x00,c,1,5", b"\x00", b'o6,"a ""b"" \\", x ",1,  ', b"",
    b"o7,1,c\r", b" o8 ,,,", b"\xff\xfe,1", "\u2028,\u0085é".encode(),
    ",".join(RAW_COLUMNS["payments"]).encode(),  # a line equal to the header is a line
]


def test_landing_keeps_every_byte_of_a_line(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    _deliver(source)
    header = ",".join(RAW_COLUMNS["payments"]).encode()
    name = f"shop_{RAW_FILE_ENDINGS['payments']}"
    (source / name).write_bytes(b"\n".join([header, *ODD_LINES]) + b"\n")
    landing.land_raw(spark, str(source), str(tmp_path / "bronze"))
    landed = b"".join(f.read_bytes() for f in (tmp_path / "bronze" / "payments").glob("part-*"))
    assert sorted(landed.split(b"\n")[:-1]) == sorted(ODD_LINES)
    counts = {r.target: r.record_count for r in landing.landing_manifest(spark, str(source)).collect()}
    assert counts["payments"] == len(ODD_LINES)
    keys = [r.order_id for r in read_raw(spark, str(tmp_path / "bronze"), "payments").collect()]
    assert {"o1", "#o4", "o6", "o7", " o8 "} <= set(keys)


def test_landing_drops_the_header_of_each_file_of_a_folder(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    _deliver(source, {k: v for k, v in LINES.items() if k != "payments"})
    folder = source / f"x{RAW_FILE_ENDINGS['payments']}"
    folder.mkdir()
    for i in range(7):
        (folder / f"{i}.csv").write_text(f"header {i}\n" + "".join(f"o{i},{j}\n" for j in range(i)))
    landing.land_raw(spark, str(source), str(tmp_path / "bronze"))
    landed = [r.value for r in spark.read.text(str(tmp_path / "bronze" / "payments")).collect()]
    assert sorted(landed) == sorted(f"o{i},{j}" for i in range(7) for j in range(i))


def test_ambiguous_and_empty_files_are_refused_before_anything_is_written(spark, tmp_path):
    source, bronze = tmp_path / "source", tmp_path / "bronze"
    source.mkdir()
    _deliver(source)
    _deliver(source, {"payments": LINES["payments"]}, prefix="old_shop_")
    with pytest.raises(landing.AmbiguousSource, match="old_shop_.*, shop_"):
        landing.land_raw(spark, str(source), str(bronze))
    landing.source_paths(spark, str(source), prefix="shop_")
    (source / f"shop_{RAW_FILE_ENDINGS['orders']}").write_text("")
    with pytest.raises(landing.EmptySource, match=f"shop_{RAW_FILE_ENDINGS['orders']}"):
        landing.land_raw(spark, str(source), str(bronze), prefix="shop_")
    assert not bronze.exists()


def test_landing_splits_large_files(spark, tmp_path):
    lines = {**LINES, "payments": [f'o{i},1,"a ""b"" \\", x ",1,  ' for i in range(5_000)]}
    source = tmp_path / "source"
    source.mkdir()
    _deliver(source, lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        landing.land_raw(spark, str(source), str(tmp_path / "bronze"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    files = list((tmp_path / "bronze" / "payments").glob("part-*"))
    assert len(files) > 1
    texts = [f.read_text().splitlines() for f in files]
    assert sorted(line for t in texts for line in t) == sorted(lines["payments"])
    assert read_raw(spark, str(tmp_path / "bronze"), "payments").count() == 5_000


def test_all_missing_files_are_named(spark, tmp_path):
    _deliver(tmp_path, {k: v for k, v in LINES.items() if k not in ("orders", "payments")})
    with pytest.raises(landing.MissingSource) as error:
        landing.land_raw(spark, str(tmp_path), str(tmp_path / "bronze"))
    assert RAW_FILE_ENDINGS["orders"] in str(error.value)
    assert RAW_FILE_ENDINGS["payments"] in str(error.value)
    assert RAW_FILE_ENDINGS["customers"] not in str(error.value)
    with pytest.raises(landing.MissingSource, match="does not exist"):
        landing.source_paths(spark, str(tmp_path / "nowhere"))


def test_csv_scan_reads_text_by_position(spark, tmp_path):
    folder = tmp_path / "customers"
    folder.mkdir()
    (folder / "a.csv").write_text(
        '"x,1",\\"q,01151, city ,\n' "\n" "short,row\n"
    )
    got = sorted(map(tuple, read_raw(spark, str(tmp_path), "customers").collect()))
    assert got == [("short", "row", "", "", ""), ("x,1", '\\"q', "01151", " city ", "")]


def test_layers(run, spark):
    assert {n: df.count() for n, df in run.silver.items()} == {
        "customers": 3, "orders": 3, "order_items": 4, "products": 2, "payments": 2,
    }
    daily = {r.dt: (r.order_count, r.gmv) for r in run.gold["daily_kpi"].collect()}
    assert daily == {"2018-01-01": (1, 60.0), "2018-02-03": (1, 10.0)}
    by_category = {
        (r.dt, r.category): r.gmv for r in run.gold["daily_kpi_by_category"].collect()
    }
    assert by_category == {
        ("2018-01-01", "art"): 58.9,
        ("2018-01-01", "unknown"): 1.1,
        ("2018-02-03", "art"): 10.0,
    }
    rates = {
        (r.cohort_month, r.months_since_cohort): r.retention_rate
        for r in run.gold["cohort_retention"].collect()
    }
    assert rates == {("2018-01", 0): 1.0, ("2018-01", 1): 1.0}
    ann = run.gold["rfm_features"].first()
    assert (ann.customer_unique_id, ann.recency_days, ann.frequency, ann.monetary) == (
        "ann",
        29,
        2,
        70.0,
    )
    assert run.gold["customer_churn_labels"].first().churn_risk_level == "Low"
    paid = {r.order_id: r.total_payment_value for r in run.silver["payments"].collect()}
    assert paid == {"o1": 73.3, "o2": 12.0}
    assert run.silver["customers"].where("customer_id = 'c2'").first().customer_city == "a, b"


def test_summaries_and_report(run):
    s = {name: {tuple(r) for r in df.collect()} for name, df in run.summaries.items()}
    assert ("orders", 3) in s["silver_row_counts"]
    assert s["gold_headlines"] == {
        ("Daily KPIs", 2), ("Total Cohorts", 1), ("RFM Customers", 1), ("Churned Customers", 0),
    }
    assert s["churn_rate"] == {(0, 1, 100.0)}
    assert ("bronze", "orders", 5) in s["completeness"] and len(s["completeness"]) == 14
    assert s["date_range"] == {("2018-01-01", "2018-03-04", 3)}
    failed = {r.check_name: r.violations for r in run.report.collect() if r.status != "PASS"}
    assert failed == {
        "bronze.orders_raw - null order_id": 1,
        "silver.orders - future order dates": 1,
        "silver.orders - delivery before purchase": 1,
        "silver.order_items - orphan order_id": 1,
        "silver.order_items - orphan product_id": 1,
    }


def test_failed_checks_can_stop_the_run(spark, source, tmp_path):
    with pytest.raises(QualityError, match="null order_id: 1"):
        run_pipeline(spark, source, str(tmp_path), prefix="strict_", fail_on="FAIL")


def test_catalog(run, spark):
    assert tables.list_tables(spark, "t_bronze") == sorted(f"{e}_raw" for e in RAW_COLUMNS)
    assert tables.list_tables(spark, "t_silver") == sorted(SILVER)
    assert len(tables.list_tables(spark, "t_gold")) == 5
    assert not spark.catalog.databaseExists("t_work")
    described = {
        r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED t_silver.orders").collect()
    }
    assert described["Provider"] == "orc" and described["dt"] == "string"
    assert "3 rows" in described["Statistics"]
    comments = {c.name: c.description for c in spark.catalog.listColumns("t_silver.orders")}
    assert comments["order_id"] == "Unique order id"
    column = spark.sql("DESCRIBE EXTENDED t_silver.orders order_id").collect()
    assert {r.info_name: r.info_value for r in column}["distinct_count"] == "3"


def test_files_are_snappy_orc_by_day(run):
    files = run.silver["orders"].inputFiles()
    assert {f.split("/dt=")[1].split("/")[0] for f in files} == {
        "2018-01-01", "2018-02-03", "2018-03-04",
    }
    assert all(f.endswith(".snappy.orc") for f in files)


def test_a_day_is_read_from_its_partition_alone(run):
    day = run.silver["orders"].where("dt = '2018-02-03'")
    scan = plan_rows(day).where("node LIKE 'Scan%'").first()
    assert scan.partition_filters == "[isnotnull(dt), (dt = 2018-02-03)]"
    assert [r.order_id for r in day.collect()] == ["o2"]


def test_only_the_columns_asked_for_are_read(run):
    plan = plan_rows(run.silver["order_items"].where("price > 1").groupBy("order_id").sum("price")).collect()
    scan = next(r for r in plan if r.node.startswith("Scan"))
    assert scan.read_schema == "struct<order_id:string,price:double>"
    assert scan.pushed_filters == "[IsNotNull(price), GreaterThan(price,1.0)]"
    exchange = [r for r in plan if r.node == "Exchange"]
    assert len(exchange) == 1 and exchange[0].dealt_by.startswith("hashpartitioning(order_id")


def test_backfill_replaces_only_its_days(spark, tmp_path):
    schema = "order_id string, dt string"
    path = str(tmp_path / "orders")
    first = [("1", "2018-01-01"), ("2", "2018-01-02"), ("3", "2018-01-02")]
    tables.write_partitions(spark.createDataFrame(first, schema), path, ("dt",))
    later = [("4", "2018-01-02"), ("5", "2018-01-03")]
    tables.write_partitions(spark.createDataFrame(later, schema), path, ("dt",))
    got = tables.read_partitions(spark, path, spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, got.collect())) == [
        ("1", "2018-01-01"), ("4", "2018-01-02"), ("5", "2018-01-03"),
    ]
    assert dict(got.dtypes)["dt"] == "string"


def test_a_day_with_a_third_of_the_rows_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(60_000).selectExpr(
        "sha2(cast(id as string), 256) as order_id",
        "if(id % 3 = 0, '2018-01-01', concat('2018-02-', 10 + id % 15)) as dt",
    )
    tables.write_partitions(df, str(tmp_path / "t"), ("dt",), file_bytes="200KB")
    assert len(list((tmp_path / "t" / "dt=2018-01-01").glob("*.orc"))) > 1
    assert spark.read.orc(str(tmp_path / "t")).count() == 60_000


def test_a_day_below_the_file_size_is_one_file(spark, tmp_path):
    days = spark.range(40_000).repartition(8).selectExpr("id", "concat('2018-01-', 10 + id % 20) as dt")
    tables.write_partitions(days, str(tmp_path / "t"), ("dt",))
    assert {len(list(d.glob("*.orc"))) for d in (tmp_path / "t").glob("dt=*")} == {1}


def test_a_rebuild_drops_days_under_every_overwrite_mode(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS rebuilt")
    schema = "order_id string, dt string"
    first = spark.createDataFrame([("1", "2018-01-01"), ("2", "2018-01-02")], schema)
    location = str(tmp_path / "orders")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        tables.write_table(first, "rebuilt.orders", location, ("dt",))
        second = tables.write_table(first.where("dt = '2018-01-02'"), "rebuilt.orders", location, ("dt",))
        assert [tuple(r) for r in second.collect()] == [("2", "2018-01-02")]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
        spark.sql("DROP DATABASE rebuilt CASCADE")


def test_the_manifest_of_a_run_is_stored(run, spark):
    assert {r.target: r.record_count for r in run.manifest.collect()} == {
        entity: len(lines) for entity, lines in LINES.items()
    }
    assert all("/work/manifest/" in file for file in run.manifest.inputFiles())


def test_packed_lines_are_delivered_and_landed_as_they_are(spark, tmp_path):
    lines = [(f"o{i:06d}", "1", " credit_card " if i % 2 else "", "x,y", f"{i}.50") for i in range(5_000)]
    frame = spark.createDataFrame(lines, ", ".join(f"{c} string" for c in RAW_COLUMNS["payments"])).coalesce(1)
    source = tmp_path / "delivery"
    write_raw(frame, str(source / RAW_FILE_ENDINGS["payments"]), **{**PACKED, "maxRecordsPerFile": 1_000})
    files = list(source.glob("*/part-*"))
    assert len(files) == 5 and all(f.name.endswith(".gz") for f in files), "a task can hold each of them"
    warehouse = pipeline.Warehouse(spark, str(tmp_path / "warehouse"))
    manifest = pipeline.land(warehouse, str(source), ["payments"])
    assert [r.record_count for r in manifest.collect()] == [1_000] * 5
    landed = list((tmp_path / "warehouse" / "bronze" / "payments").glob("part-*"))
    assert all(f.name.endswith(".gz") for f in landed)
    assert 2 * sum(f.stat().st_size for f in landed) < sum(len(",".join(line)) + 1 for line in lines)
    got = read_raw(spark, warehouse.location("bronze"), "payments").collect()
    assert sorted(map(tuple, got)) == lines, "no header among them, and no value changed"


def test_entities_are_landed_at_the_same_time(spark, source, tmp_path, monkeypatch):
    paths = landing.source_paths(spark, source, entities=["orders", "payments"])
    both, lines = threading.Barrier(2, timeout=30), landing._lines

    def meet(*given):
        both.wait()
        return lines(*given)

    monkeypatch.setattr(landing, "_lines", meet)
    targets = landing.land_raw(spark, paths, str(tmp_path))
    assert list(targets) == ["orders", "payments"]
    for entity, target in targets.items():
        assert sorted(r.value for r in spark.read.text(target).collect()) == sorted(LINES[entity])
