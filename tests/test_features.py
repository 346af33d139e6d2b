import random
import numpy as np
import pandas as pd
import pytest
from frames import by_time, day, prices
from pyspark.sql import functions as F

from tidemark.operators.features import (
    add_indicators,
    bollinger,
    ema,
    lag_features,
    macd,
    moving_averages,
    price_changes,
    rsi_sma,
    with_lookback,
)
from tidemark.schemas import FEATURES

KEY = ["series"]


def test_feature_table_has_24_columns_in_order(spark):
    made = add_indicators(prices(spark, range(1, 30)), KEY, blocks=None)
    assert made.columns == ["series", "ts", *FEATURES] and len(FEATURES) == 24


def test_frames_are_null_until_full(spark):
    made = add_indicators(prices(spark, range(1, 26)), KEY, blocks=None)
    short, long = by_time(made, "ma_short"), by_time(made, "ma_long")
    assert short[:9] == [None] * 9 and short[9] == 5.5
    assert long[18] is None and long[19] == 10.5
    assert by_time(made, "volatility")[19] == pytest.approx(5.916080, abs=1e-6)
    assert by_time(made, "roc")[5] == 5.0
    assert by_time(made, "bb_position")[19] == pytest.approx(0.901448, abs=1e-6)


def test_missing_values_keep_a_frame_empty(spark):
    made = moving_averages(prices(spark, [1, 2, None, 4, 5, 6]), KEY, "ts", "selling_price", [3], None)
    assert by_time(made, "sma_3") == [None, None, None, None, None, 5.0]


def test_rsi_edges(spark):
    assert by_time(rsi_sma(prices(spark, range(25)), KEY, "ts", "selling_price", blocks=None), "rsi") == [None] * 13 + [100.0] * 12
    assert by_time(rsi_sma(prices(spark, [5] * 25), KEY, "ts", "selling_price", blocks=None), "rsi") == [None] * 25
    saw = rsi_sma(prices(spark, [100 + i % 3 for i in range(20)]), KEY, "ts", "selling_price", blocks=None)
    assert by_time(saw, "rsi")[13:16] == pytest.approx([52.941176, 55.555556, 47.368421], abs=1e-6)


def test_flat_band_has_no_position(spark):
    made = bollinger(prices(spark, [5] * 22), KEY, "ts", "selling_price", blocks=None)
    assert by_time(made, "bb_position") == [None] * 22
    assert by_time(made, "bb_upper")[-1] == 5.0


def test_monday_is_day_zero(spark):
    made = add_indicators(prices(spark, range(1, 9)), KEY, blocks=None)
    assert by_time(made, "day_of_week") == [0, 1, 2, 3, 4, 5, 6, 0]
    assert by_time(made, "month") == [1] * 8
    assert by_time(made, "day_sin")[1] == pytest.approx(np.sin(2 * np.pi / 7))


def test_everything_equals_pandas(spark):
    rng = np.random.default_rng(1)
    p = pd.Series(rng.uniform(50, 60, 200))
    b = p * 0.97
    made = add_indicators(prices(spark, p.tolist(), b.tolist()), KEY, blocks=None)
    change = p.diff()
    gain = change.where(change > 0, 0).rolling(14).mean()
    loss = (-change).where(change < 0, 0).rolling(14).mean()
    mean, std = p.rolling(20).mean(), p.rolling(20).std()
    want = {
        "ma_short": p.rolling(10).mean(),
        "volatility": std,
        "roc": p.pct_change(5),
        "bb_lower": mean - 2 * std,
        "rsi": 100 - 100 / (1 + gain / loss),
        "price_lag_7": p.shift(7),
        "spread_lag_3": (p - b).shift(3),
    }
    for name, series in want.items():
        got = pd.Series(by_time(made, name), dtype=float)
        np.testing.assert_allclose(got, series, rtol=1e-9, err_msg=name)


def test_exponential_average_equals_pandas(spark):
    rng = np.random.default_rng(4)
    p = pd.Series(rng.uniform(50, 60, 1500))
    df = prices(spark, p.tolist())
    made = ema(df, KEY, "ts", "selling_price", (5, 26), None)
    for n in (5, 26):
        np.testing.assert_allclose(by_time(made, f"ema_{n}"), p.ewm(span=n, adjust=False).mean(), rtol=1e-12)
    line = p.ewm(span=12, adjust=False).mean() - p.ewm(span=26, adjust=False).mean()
    signal = line.ewm(span=9, adjust=False).mean()
    made = macd(df, KEY, "ts", "selling_price", blocks=None)
    np.testing.assert_allclose(by_time(made, "macd_signal"), signal, atol=1e-10)
    np.testing.assert_allclose(by_time(made, "macd_histogram"), line - signal, atol=1e-10)


def test_lags_and_changes(spark):
    df = prices(spark, [0, 2, 3, 6])
    assert by_time(lag_features(df, KEY, "ts", "selling_price", [2], "p", None), "p_lag_2") == [None, None, 0.0, 2.0]
    assert by_time(price_changes(df, KEY, "ts", "selling_price", [1], None), "change_1") == [None, None, 0.5, 1.0]


def test_two_series_together_equal_two_alone(spark):
    one = prices(spark, [i % 7 + 1 for i in range(40)])
    two = prices(spark, [i % 5 + 1 for i in range(30)], series="b")
    both = add_indicators(one.union(two), KEY, blocks=None)
    alone = add_indicators(one, KEY, blocks=None).union(add_indicators(two, KEY, blocks=None))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, alone.collect()))


def test_lookback_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "p")
    prices(spark, range(100)).write.parquet(path)
    df = with_lookback(spark.read.parquet(path), KEY, "ts", "2024-03-01", 20)
    assert df.agg(F.min("ts")).first()[0].strftime("%Y-%m-%d") == "2024-02-10"
    df.explain()
    assert "GreaterThanOrEqual(ts" in capsys.readouterr().out


def test_lookback_counts_rows_of_sparse_series(spark):
    sparse = prices(spark, range(60), step=30.0)
    since = sparse.orderBy("ts").collect()[40]["ts"].strftime("%Y-%m-%d")
    df = with_lookback(sparse, KEY, "ts", since, 20)
    assert df.count() == 40
    whole, cut = (add_indicators(x, KEY, blocks=None).filter(F.col("ts") >= since).orderBy("ts").collect() for x in (sparse, df))
    assert whole == cut


def test_one_shuffle_for_all_indicators(spark, capsys):
    add_indicators(prices(spark, range(10)), KEY, blocks=None).explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def _plain_average(xs, n, start=None):
    a, e, out = 2.0 / (n + 1), start, []
    for x in xs:
        if x is not None:
            e = x if e is None else a * x + (1 - a) * e
        out.append(None if x is None else e)
    return out


def _close(got, want):
    assert [v is None for v in got] == [v is None for v in want]
    assert [v for v in got if v is not None] == pytest.approx([v for v in want if v is not None], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("blocks", [None, 5, 40])
def test_averages_equal_plain_loops_in_any_blocks(spark, blocks):
    rng = random.Random(4)
    series = {
        "gaps": [None] * 7 + [rng.uniform(-50, 90) if rng.random() < 0.6 else None for _ in range(150)],
        "long": [rng.gauss(1000, 300) for _ in range(400)],
        "one": [3.0],
        "unknown": [None] * 12,
        None: [5.0, None, 6.0],
    }
    rows = [(k, day(i), v) for k, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "series string, ts timestamp, v double").repartition(5)
    averaged = ema(df, ["series"], "ts", "v", (1, 5, 60), blocks)
    moved = macd(df, ["series"], "ts", "v", 4, 9, 4, blocks)  # the signal's weight is the fast one's
    for k, vs in series.items():
        got = averaged.filter(F.col("series").eqNullSafe(k)).orderBy("ts").collect()
        for n in (1, 5, 60):
            _close([r[f"ema_{n}"] for r in got], _plain_average(vs, n))
        fast, slow = _plain_average(vs, 4), _plain_average(vs, 9)
        line = [None if f is None else f - s for f, s in zip(fast, slow)]
        signal = _plain_average(line, 4)
        got = moved.filter(F.col("series").eqNullSafe(k)).orderBy("ts").collect()
        _close([r.macd for r in got], line)
        _close([r.macd_signal for r in got], signal)
