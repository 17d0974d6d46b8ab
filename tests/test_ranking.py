import math
import random

import pytest
from pyspark.sql import Window, functions as F

from tallyloom.operators.ranking import Ranking, _Boundary, _Target, _tighten, global_ntile, tile_starts


def _expected(df, ranking, k):
    return {
        r.tie: r.tile
        for r in df.withColumn(
            "tile", F.ntile(k).over(Window.orderBy(*ranking.order()))
        ).collect()
    }


def _tiles(df, rankings, **options):
    got = global_ntile(df, rankings, **options).collect()
    return {name: {r.tie: r[name] for r in got} for name in rankings}


def _keys(kind, n):
    seeded = random.Random(n)
    return {
        "mixed": lambda: seeded.choice([None, -3.0, 0.0, 0.1, 7.25, 7.25, math.nan]),
        "equal": lambda: 1.0,
        "missing": lambda: None,
        "spread": lambda: seeded.random() * 1000,
    }[kind]


@pytest.mark.parametrize("kind", ["mixed", "equal", "missing", "spread"])
@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 1000])
def test_matches_the_window_function(spark, kind, n):
    key = _keys(kind, n)
    data = [(key(), f"c{i:05d}") for i in range(n)]
    df = spark.createDataFrame(data, "key double, tie string").repartition(4).cache()
    rankings = {"up": Ranking("key", "tie"), "down": Ranking("key", "tie", descending=True)}
    expected = {name: _expected(df, ranking, 5) for name, ranking in rankings.items()}
    assert _tiles(df, rankings) == expected
    if n == 1000 and kind in ("mixed", "spread"):
        assert _tiles(df, rankings, leaf_rows=60, sample_rows=200) == expected
    df.unpersist()


def test_narrowing_finds_boundaries_inside_one_hot_key(spark):
    df = (
        spark.range(30_000)
        .select(
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("key"),
            F.sha1(F.col("id").cast("string")).alias("tie"),
        )
        .cache()
    )
    rankings = {"up": Ranking("key", "tie"), "down": Ranking("key", "tie", descending=True)}
    got = _tiles(df, rankings, k=5, leaf_rows=1_000, sample_rows=400)
    for name, ranking in rankings.items():
        assert got[name] == _expected(df, ranking, 5)
    df.unpersist()


def test_a_poor_sample_costs_rounds_and_not_exactness(spark):
    df = spark.range(2_000).select(
        F.col("id").alias("key"), F.col("id").cast("string").alias("tie")
    ).cache()
    ranking = Ranking("key", "tie")
    got = _tiles(df, {"t": ranking}, leaf_rows=5, sample_rows=3)
    assert got["t"] == _expected(df, ranking, 5)
    df.unpersist()


def _counts(df, ranking, k, **options):
    """Rows per tile, key and tie, as found and by the window function."""
    by = ["tile", *dict.fromkeys(ranking.columns)]
    got = global_ntile(df, {"tile": ranking}, k=k, **options).groupBy(*by).count().collect()
    window = F.ntile(k).over(Window.orderBy(*ranking.order()))
    wanted = df.withColumn("tile", window).groupBy(*by).count().collect()
    return sorted(map(repr, got)), sorted(map(repr, wanted))


@pytest.mark.parametrize("leaf_rows", [10, 1_000_000])
@pytest.mark.parametrize("k", [2, 5])
def test_equal_rows_are_shared_out(spark, leaf_rows, k):
    same = spark.range(200).select(F.lit(1).alias("key"), F.lit("a").alias("tie"))
    found = global_ntile(same, {"t": Ranking("key", "tie")}, k=k, leaf_rows=leaf_rows, sample_rows=20)
    assert {r.t: r["count"] for r in found.groupBy("t").count().collect()} == {t: 200 // k for t in range(1, k + 1)}
    assert found.columns == ["key", "tie", "t"]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("others", [1, 299])
def test_the_search_ends_among_equal_rows(spark, others, descending):
    """300 equal rows and some more: a bracket of nearly equal rows must still shrink."""
    data = [(1.0, 1)] * 300 + [(2.0 + i // 3, 2) for i in range(others)]
    df = spark.createDataFrame(data, "key double, tie int").repartition(4).cache()
    for k in (2, 5):
        for ranking in (Ranking("key", "tie", descending), Ranking("key", descending=descending)):
            got, wanted = _counts(df, ranking, k, leaf_rows=20, sample_rows=50)
            assert got == wanted
    df.unpersist()


@pytest.mark.parametrize("leaf_rows", [50, 1_000_000])
def test_key_alone_gives_the_counts_of_the_window_function(spark, leaf_rows):
    seeded = random.Random(2)
    data = [(seeded.choice([None, 0.0, 1.5, 1.5, 1.5, math.nan]), seeded.randrange(4)) for _ in range(999)]
    df = spark.createDataFrame(data, "a double, b int").repartition(5).cache()
    for ranking in (Ranking("a"), Ranking("a", descending=True), Ranking("b"), Ranking("b", "a", True)):
        got, wanted = _counts(df, ranking, 7, leaf_rows=leaf_rows, sample_rows=40)
        assert got == wanted
    both = global_ntile(df, {"x": Ranking("a"), "y": Ranking("b")}, k=4, leaf_rows=leaf_rows, sample_rows=40)
    for tile in "xy":
        assert sorted(r["count"] for r in both.groupBy(tile).count().collect()) == [249, 250, 250, 250]
    df.unpersist()


def test_a_round_leaves_a_smaller_bracket():
    """A proposed value is the boundary's, or it leaves the bracket with all rows equal to it."""
    target = _Target(Ranking("key", "tie"), 300, 301)
    once = _tighten(target, [((1, 1), 0, 300), ((1, 1), 0, 300)])
    assert (once.low, once.below, once.size) == ((1, 1), 300, 1)
    found = _tighten(_Target(Ranking("key", "tie"), 150, 301), [((1, 1), 0, 300), ((2, 2), 300, 1)])
    assert isinstance(found, _Boundary) and (found.row, found.share, found.equal) == ((1, 1), 150, 300)
    below = _tighten(_Target(Ranking("key", "tie"), 10, 301), [((2, 2), 300, 1), (None, 0, 0)])
    assert (below.high, below.size) == ((2, 2), 300)


def test_the_jobs_of_a_round_do_not_grow_with_the_brackets(spark):
    df = spark.range(4_000).select(
        *[((F.col("id") * p) % 4_001).alias(f"k{p}") for p in (3, 7, 11)],
        F.col("id").cast("string").alias("tie"),
    ).cache()
    df.count()
    context = spark.sparkContext

    def jobs(rankings, k):
        context.setJobGroup(f"{len(rankings)}-{k}", "tiles")
        global_ntile(df, rankings, k=k, leaf_rows=2_000, sample_rows=1_500)
        found = context.statusTracker().getJobIdsForGroup(f"{len(rankings)}-{k}")
        context.setLocalProperty("spark.jobGroup.id", None)
        return len(found)

    one = {"a": Ranking("k3", "tie")}
    three = {f"k{p}": Ranking(f"k{p}", "tie") for p in (3, 7, 11)}
    # numbering takes a job or two per ranking; sampling and counting are shared
    assert jobs(three, 9) - jobs(one, 2) <= 2 * (len(three) - len(one))
    df.unpersist()


def test_the_tiles_need_no_shuffle_of_the_table(spark):
    df = spark.range(100).select(
        F.col("id").alias("key"), F.col("id").cast("string").alias("tie")
    )
    ranked = global_ntile(df, {"t": Ranking("key", "tie")})
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_first_tiles_take_the_remainder():
    assert tile_starts(12, 5) == [3, 6, 8, 10]
    assert tile_starts(3, 5) == [1, 2]
    assert tile_starts(0, 5) == []
