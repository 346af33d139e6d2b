"""Operators in blocks must equal the same operators on whole series."""

import random
from datetime import timedelta

import pytest
from frames import START, day
from pyspark.sql import functions as F

from tidemark.operators.alignment import naive_forecast, trailing_mean_forecast
from tidemark.operators.blocks import assign_blocks, plan_blocks, row_numbers
from tidemark.operators.cleaning import fill_missing
from tidemark.operators.features import add_indicators, ema, macd
from tidemark.operators.metrics import equity_curve, evaluate_wide, returns_to_date, strategy_returns
from tidemark.operators.reporting import qq_points
from tidemark.operators.sequences import chronological_split, latest_window, make_sequences

KEY = ["series"]
SCHEMA = "series string, ts timestamp, selling_price double, buying_price double, spread double"


@pytest.fixture(scope="module")
def ticks(spark):
    """Series of very different lengths and densities: bursts, long gaps, one row only."""
    rng = random.Random(3)
    rows = []

    def add(name, times):
        for t in times:
            p = rng.uniform(50, 150)
            rows.append((name, START + timedelta(microseconds=t), p, p * 0.9, p * 0.1))

    add("even", range(0, 3_000_000, 1000))
    burst = set(range(1700)) | {10**9 + i * 10**9 for i in range(40)} | {10**12 + i for i in range(900)}
    add("bursty", sorted(burst))
    add("sparse", [10**9 * i * i for i in range(150)])
    add("single", [5])
    return spark.createDataFrame(rows, SCHEMA).cache()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def close(a, b, rel=1e-9):
    left, right = rows(a.select(sorted(a.columns))), rows(b.select(sorted(b.columns)))
    assert len(left) == len(right)
    for x, y in zip(left, right):
        for u, v in zip(x, y):
            if isinstance(u, float) and v is not None:
                assert v == pytest.approx(u, rel=rel, abs=1e-9)
            else:
                assert u == v


SIZES = [64, 1000]


@pytest.mark.parametrize("size", SIZES)
def test_every_row_has_one_own_block_and_the_halo_is_complete(ticks, size):
    halo = 20
    placed = assign_blocks(ticks, KEY, "ts", halo, size)
    assert placed.filter("not _halo").count() == ticks.count()
    numbered = row_numbers(ticks, KEY, "ts", "n", None).select("series", "ts", "n")
    spans = placed.join(numbered, ["series", "ts"]).groupBy("series", "_block").agg(
        F.min("n").alias("lo"),
        F.min(F.when(~F.col("_halo"), F.col("n"))).alias("own"),
        F.max("n").alias("hi"),
        F.count("*").alias("rows"),
        F.max("_block_start").alias("start"),
    )
    for r in spans.collect():
        assert r.own == r.start
        assert r.rows == r.hi - r.lo + 1
        assert r.lo <= max(r.own - halo, 0)
    even = placed.filter("series = 'even' and not _halo").groupBy("_block").count()
    assert even.agg(F.max("count")).first()[0] <= size * 1.3


def test_row_numbers(ticks):
    assert rows(row_numbers(ticks, KEY, "ts", "n", 64)) == rows(row_numbers(ticks, KEY, "ts", "n", None))


@pytest.mark.parametrize("size", SIZES)
def test_indicators(ticks, size):
    assert rows(add_indicators(ticks, KEY, blocks=size)) == rows(add_indicators(ticks, KEY, blocks=None))


def test_one_layout_serves_several_operators(ticks):
    layout = plan_blocks(ticks, KEY, "ts", 30, 100)
    assert rows(add_indicators(ticks, KEY, blocks=layout)) == rows(add_indicators(ticks, KEY, blocks=None))
    assert rows(naive_forecast(ticks, KEY, blocks=layout)) == rows(naive_forecast(ticks, KEY, blocks=None))
    with pytest.raises(ValueError):
        make_sequences(ticks, KEY, length=60, blocks=layout)


@pytest.mark.parametrize("size", SIZES)
def test_fill_missing(ticks, size):
    gap = F.col("selling_price") < 80
    holes = ticks.withColumn("selling_price", F.when(~gap, F.col("selling_price")))
    holes = holes.withColumn("spread", F.when(F.col("ts") > F.lit(day(0.0000001)), F.col("spread")))
    columns = ["selling_price", "spread"]
    assert rows(fill_missing(holes, KEY, "ts", columns, blocks=size)) == rows(fill_missing(holes, KEY, "ts", columns, blocks=None))


@pytest.mark.parametrize("size", SIZES)
def test_exponential_averages(ticks, size):
    close(ema(ticks, KEY, "ts", "selling_price", blocks=size), ema(ticks, KEY, "ts", "selling_price", blocks=None))
    close(macd(ticks, KEY, "ts", "selling_price", blocks=size), macd(ticks, KEY, "ts", "selling_price", blocks=None))


def test_sequences(ticks):
    made = make_sequences(ticks, KEY, features=["selling_price", "spread"], length=7, blocks=64)
    assert rows(made) == rows(make_sequences(ticks, KEY, features=["selling_price", "spread"], length=7, blocks=None))


def test_split(ticks):
    assert rows(chronological_split(ticks, KEY, "ts", blocks=64)) == rows(chronological_split(ticks, KEY, "ts", blocks=None))


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("shift", [1000.0, -60.0])
def test_equity_and_metrics(ticks, size, shift):
    """A shift to small and negative prices gives growth factors of either sign."""
    near = ticks.withColumn("selling_price", F.col("selling_price") + shift)
    both = naive_forecast(near, KEY, blocks=None).unionByName(trailing_mean_forecast(near, KEY, blocks=None))
    both = both.filter("series <> 'even' or ts < '2024-01-01 00:00:00.2'").cache()
    close(strategy_returns(both, cost=0.01, blocks=size), strategy_returns(both, cost=0.01, blocks=None))
    close(equity_curve(both, blocks=size), equity_curve(both, blocks=None))
    close(evaluate_wide(both, blocks=size), evaluate_wide(both, blocks=None), rel=1e-6)


def test_returns_to_date(ticks):
    near = ticks.withColumn("selling_price", F.col("selling_price") + 1000)
    close(returns_to_date(near, KEY, blocks=64), returns_to_date(near, KEY, blocks=None))


def test_ranks_of_repeated_values(ticks):
    rough = ticks.withColumn("v", F.round(F.col("selling_price") / 40))
    assert rows(qq_points(rough, "v", KEY, 5)) == rows(qq_points(rough, "v", KEY, None))
    assert qq_points(rough, "v", KEY, 5).count() == ticks.count()


def test_a_single_series_with_a_constant_key(ticks):
    alone = ticks.filter("series = 'bursty'").drop("series").withColumn("series", F.lit("all"))
    assert rows(add_indicators(alone, KEY, blocks=50)) == rows(add_indicators(alone, KEY, blocks=None))
    with pytest.raises(ValueError):
        assign_blocks(alone, [], "ts", 1, 50)


def test_latest_window_orders_and_rejects(ticks):
    full, short = latest_window(ticks, KEY, features=["selling_price"], length=100)
    assert {r.series for r in full.collect()} == {"even", "bursty", "sparse"}
    assert [(r.series, r.n_rows) for r in short.collect()] == [("single", 1)]
    last = [r[0] for r in ticks.filter("series = 'sparse'").orderBy(F.desc("ts")).select("selling_price").limit(100).collect()]
    assert full.filter("series = 'sparse'").first().x == last[::-1]


def test_null_keys_stay(spark):
    rows_ = [("a" if i % 3 else None, day(i), float(i), 1.0, 0.0) for i in range(300)]
    df = spark.createDataFrame(rows_, SCHEMA)
    whole, cut = (row_numbers(df, KEY, "ts", "n", b).select("series", "ts", "n") for b in (None, 32))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, cut.collect()))
    filled = fill_missing(df.withColumn("selling_price", F.when(F.col("selling_price") % 4 != 0, F.col("selling_price"))), KEY, "ts", ["selling_price"], blocks=32)
    assert filled.filter("series IS NULL").count() == 100


@pytest.mark.parametrize("extreme", [float("inf"), float("-inf"), float("nan"), 1.7e308])
def test_positions_that_are_not_finite(spark, extreme):
    values = [float(i % 180) for i in range(400)] + [extreme] * 3 + ([-1.7e308] if extreme == 1.7e308 else [])
    df = spark.createDataFrame([("a", v) for v in values] + [("b", extreme)], "series string, v double")
    whole, cut = (qq_points(df, "v", KEY, b).select("series", "rank", "ordered").collect() for b in (None, 64))
    assert sorted(map(repr, whole)) == sorted(map(repr, cut))


def test_blocks_do_not_depend_on_the_zone(spark):
    hours = [(START.replace(month=3, day=9) + timedelta(minutes=10 * i)) for i in range(400)]
    df = spark.createDataFrame([("a", t, float(i)) for i, t in enumerate(hours)], "series string, ts timestamp_ntz, v double")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        cut = row_numbers(df, KEY, "ts", "n", 32).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(int(r.v) for r in cut) == list(range(400)) and all(int(r.v) == r.n for r in cut)


def test_averages_skip_unknown_values(spark):
    known = [100.0] * 60
    for at in (0, 1, 5, 30):
        known[at] = None
    df = spark.createDataFrame([("a", day(i), v, 1.0, 0.0) for i, v in enumerate(known)], SCHEMA)
    for blocks in (None, 16):
        got = [r.ema_12 for r in ema(df, KEY, "ts", "selling_price", (12,), blocks).orderBy("ts").collect()]
        assert [g is None for g in got] == [v is None for v in known]
        assert all(g is None or abs(g - 100) < 1e-9 for g in got)
