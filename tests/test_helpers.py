import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.functions.money import money_avg, money_parts, money_sum
from tallyloom.session import scoped
from tallyloom.sinks import scratch


def _apply(rows, column, values):
    df = rows("i int, x string", list(enumerate(values)))
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_whole_numbers(rows):
    cases = {
        "01151": 1151,
        " 12 ": 12,
        "-3": -3,
        "+4": 4,
        "12.9": 12,
        "12.": 12,
        "-0.5": 0,
        "": None,
        " ": None,
        ".5": None,
        "1e3": None,
        "12a": None,
        "99999999999": None,
        None: None,
    }
    assert _apply(rows, text.to_int("x"), cases) == list(cases.values())


def test_numbers_times_and_days(rows):
    assert _apply(rows, text.to_double("x"), ["1.50", "", "n/a", "-2", None]) == [
        1.5, None, None, -2.0, None,
    ]
    times = _apply(rows, text.to_timestamp("x"), ["2017-10-02 10:56:33", "", "2017-13-02", None])
    assert [t and t.isoformat() for t in times] == ["2017-10-02T10:56:33", None, None, None]
    days = _apply(rows, text.to_date("x"), ["2017-10-18 00:00:00", "2017-10-18", "soon", ""])
    assert [d and d.isoformat() for d in days] == ["2017-10-18", "2017-10-18", None, None]
    assert _apply(rows, text.day_of("x"), [" 2017-10-18 01", "short"]) == [" 2017-10-1", "short"]


def test_trimming_takes_blanks_only(rows):
    assert _apply(rows, text.lower_trim("x"), ["  ÁB ", "\tA"]) == ["áb", "\ta"]
    assert _apply(rows, text.upper_trim("x"), [" sp "]) == ["SP"]


def test_months_between(rows):
    df = rows("a string, b string", [("2017-12", "2018-02"), ("2018-05", "2018-05"), ("x", "y")])
    got = {r.a: r.m for r in df.select("a", text.months_between("a", "b").alias("m")).collect()}
    assert got == {"2017-12": 2, "2018-05": 0, "x": None}


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=40), st.integers(1, 5))
def test_sums_of_cents_are_exact(spark, cents, parts):
    data = [(c / 100,) for c in cents]
    df = spark.createDataFrame(data, "x double").repartition(parts)
    row = df.agg(money_sum(F.col("x")).alias("s"), money_avg(F.col("x")).alias("a")).first()
    assert row.s == sum(cents) / 100
    assert row.a == sum(cents) / 100 / len(cents)


def test_settings_are_restored_after_an_error(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), scoped(spark, {key: 3}):
        assert spark.conf.get(key) == "3"
        raise RuntimeError
    assert spark.conf.get(key) == before


class _Session:
    def __init__(self, **conf):
        self.conf = self
        self.values = conf

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_scratch_follows_the_cluster_setting(spark):
    assert scratch.scratch_dir(_Session(**{"spark.checkpoint.dir": "s3://b/x/"})) == "s3://b/x"
    assert scratch.scratch_dir(_Session(**{"spark.master": "local[2]"})).startswith("/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(_Session(**{"spark.master": "yarn"}))
    folder = spark.conf.get("spark.checkpoint.dir")
    stored = scratch.materialize(spark.range(10), "numbers")
    assert all(folder in path for path in stored.inputFiles())
    assert stored.count() == 10


def test_work_database_is_dropped_with_its_tables(spark):
    with scratch.work_database(spark, "w1") as work:
        table = scratch.temporary_table(spark.range(5), work, "t")
        assert table.count() == 5
    assert not spark.catalog.databaseExists("w1")


def test_small_amounts_are_not_rounded_away(spark):
    small = spark.range(100_000).select(F.lit(0.00004).alias("x"))
    assert small.select(money_sum(F.col("x"))).first()[0] == pytest.approx(4.0, rel=1e-9)
    odd = spark.range(1).select(F.lit(1.23456789).alias("x"))
    assert odd.select(money_sum(F.col("x"))).first()[0] == pytest.approx(1.23456789, rel=1e-15)


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_cents_leave_no_remainder(spark, parts):
    cents = spark.range(50_000, numPartitions=parts).select(
        (F.pmod(F.xxhash64("id"), F.lit(1_000_000_000)) / 100).alias("x")
    )
    whole = cents.agg(F.sum((F.col("x") * 100).cast("decimal(20,0)")).cast("long")).first()[0]
    assert cents.select(money_sum(F.col("x"))).first()[0] == whole / 100


def test_times_of_another_form_are_malformed(rows):
    values = ["2017-10-18 10:20:30", "2017-1-2", "2017", "2017-10", "2017-10-18 00:00:00+05:00", "2017-10-18T10:20:30Z",
              "", None, "2017-13-01", "2017-10-18 10:20:30.5", "10:20:30"]
    df = rows("i int, x string", list(enumerate(values)))
    got = [tuple(r) for r in df.orderBy("i").select(text.to_timestamp("x").isNotNull(), text.to_date("x").isNotNull()).collect()]
    assert got == [(known, known) for known in (True, True, *(False,) * 7, True, False)]


def test_first_sums_of_money_are_sums_of_longs(spark, rows):
    """A sum of decimals makes objects per row; in parts of longs it is as exact, also at the largest amounts."""
    largest = 99_999_999_999_999.0
    data = [(1, largest), (1, largest), (1, -0.0001), (1, -largest), (2, -largest), (2, -1.25), (3, None), (4, -0.01)]
    summed = rows("k int, x double", data).groupBy("k").agg(*money_parts(F.col("x"), "m"))
    assert dict(summed.dtypes)["m_units"] == "decimal(28,0)"
    assert {r.k: r.m_units and int(r.m_units) for r in summed.collect()} == {
        1: int(largest * 10_000) - 1, 2: -int(largest * 10_000) - 12_500, 3: None, 4: -100
    }
    plan = summed._jdf.queryExecution().executedPlan().toString()
    partial = next(line for line in plan.splitlines() if "partial_sum" in line)
    assert "decimal" not in partial and "MakeDecimal" not in partial
