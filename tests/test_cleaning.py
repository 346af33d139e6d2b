import math
import random

import numpy as np
import pandas as pd
import pytest
from frames import by_time, day, prices
from pyspark.sql import functions as F

from tidemark.operators.cleaning import (
    dedupe_first,
    fill_missing,
    iqr_bounds,
    iqr_filter,
    latest_days,
    positive_prices,
    price_summary,
    quality_report,
    require_min_rows,
    split_bad_records,
    to_prices,
    zscore_outliers,
)
from tidemark.operators.quantiles import approx_quantiles, exact_quantiles

KEY = ["series"]
RECORD = "series string, hargaJual string, hargaBeli string, lastUpdate string"


def test_quartiles_interpolate(spark):
    df = prices(spark, [10, 11, 9, 12, 12, 15, 100])
    r = iqr_bounds(df, KEY, "selling_price").first()
    assert (r.q1, r.q3, r.lower, r.upper) == (10.5, 13.5, 6.0, 18.0)
    assert 100.0 not in by_time(iqr_filter(df, KEY, ["selling_price"]), "selling_price")


def test_second_column_sees_the_rows_the_first_kept(spark):
    df = prices(spark, [10, 11, 12, 13, 14, 100], [9, 10, 11, 12, 13, 10])
    kept = iqr_filter(df, KEY)
    assert by_time(kept, "selling_price") == [10, 11, 12, 13, 14]
    first = iqr_filter(df, KEY, ["selling_price"])
    r = iqr_bounds(first, KEY, "buying_price").first()
    assert (r.lower, r.upper) == (7.0, 15.0)


@pytest.mark.parametrize("cuts", [{}, {"per_octave": 1, "parts": 200}])
def test_exact_quantiles_equal_numpy_in_every_distribution(spark, cuts):
    rng = random.Random(5)
    groups = {
        "heavy": [rng.paretovariate(0.5) for _ in range(4000)],
        "one_value": [7.0] * 3000,
        "third_equal": [5.0] * 1500 + [rng.uniform(0, 10) for _ in range(3000)],
        "two": [1.0, 2.0],
        "one": [3.0],
        "negative": [rng.gauss(0, 1) for _ in range(997)],
        "close": [1e9 + i * 2.0**-20 for i in range(500)],
        "extreme": [rng.choice((-1, 1)) * 10.0 ** rng.randrange(-320, 308) for _ in range(800)] + [0.0, -0.0],
        "infinite": [math.inf] * 40 + [-math.inf] * 30 + [1.0, 2.0] * 20,
        None: [rng.uniform(-1, 1) for _ in range(50)],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("heavy", None), ("empty", None)]
    df = spark.createDataFrame(rows, "series string, v double").repartition(7)
    probabilities = (0.0, 0.25, 0.5, 0.75, 1.0)
    found = {r.series: list(r)[1:] for r in exact_quantiles(df, KEY, "v", probabilities, **cuts).collect()}
    assert set(found) == set(groups)
    for k, vs in groups.items():
        if k == "infinite":
            assert found[k] == [-math.inf, -math.inf, 2.0, math.inf, math.inf]
        else:
            assert found[k] == pytest.approx(np.quantile(vs, probabilities).tolist(), rel=1e-12)


def test_nan_counts_as_the_greatest_number(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, math.nan, 3.0, None)], "v double")
    r = exact_quantiles(df, [], "v", (0.0, 1 / 3, 0.5, 1.0)).first()
    assert list(r)[:3] == pytest.approx([1.0, 2.0, 2.5]) and math.isnan(r.q3)


def test_quantiles_without_keys(spark):
    df = prices(spark, range(101))
    assert list(exact_quantiles(df, [], "selling_price", (0.25, 0.755)).first()) == pytest.approx([25.0, 75.5])
    assert list(approx_quantiles(df, [], "selling_price", (0.5,)).first()) == [50.0]


def test_a_bad_first_copy_hides_a_good_second_one(spark):
    rows = [("a", day(0), 0, -1.0), ("a", day(0), 1, 10.0), ("a", day(1), 2, 11.0)]
    df = spark.createDataFrame(rows, "series string, ts timestamp, arrival int, selling_price double")
    first = dedupe_first(df, KEY, "ts", ["arrival"])
    assert by_time(first, "selling_price") == [-1.0, 11.0]
    assert by_time(positive_prices(first, ["selling_price"]), "selling_price") == [11.0]


def test_copies_are_dropped_before_the_shuffle(spark, capsys):
    df = spark.range(100).selectExpr("'a' series", "id % 7 ts", "id arrival")
    dedupe_first(df, KEY, "ts", ["arrival"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") >= 2


def test_nan_is_not_a_positive_price(spark):
    assert positive_prices(prices(spark, [1, float("nan"), 0, -2, 3]), ["selling_price"]).count() == 2


def test_fill(spark):
    df = prices(spark, [None, 1, None, 3, None], [1, 1, 1, 1, 1])
    for blocks in (None, 2):
        filled = fill_missing(df, KEY, "ts", ["selling_price"], blocks=blocks)
        assert by_time(filled, "selling_price") == [1, 1, 1, 3, 3]
    assert by_time(fill_missing(df, KEY, "ts", ["selling_price"], "drop"), "selling_price") == [1, 3]
    empty = prices(spark, [None, None], [1, 1])
    assert fill_missing(empty, KEY, "ts", ["selling_price"], blocks=None).count() == 0


def test_fill_equals_pandas(spark):
    rng = random.Random(2)
    values = [rng.random() if rng.random() > 0.7 else None for _ in range(300)]
    got = by_time(fill_missing(prices(spark, values, [1] * 300), KEY, "ts", ["selling_price"], blocks=37), "selling_price")
    assert got == pd.Series(values, dtype=float).ffill().bfill().tolist()


def test_bad_records_are_set_aside(spark):
    rows = [
        ("a", "10", "9", "2024-01-01"),
        ("a", "x", "9", "2024-01-02"),
        ("a", "10", None, "2024-01-03"),
        ("a", "10", "9", "someday"),
        ("a", "NaN", "9", "2024-01-04"),
    ]
    records = spark.createDataFrame(rows, RECORD)
    good, bad = split_bad_records(records, KEY)
    assert good.count() == 1 and good.first().spread == 1.0
    assert sorted(r.reason for r in bad.collect()) == ["bad_buying_price", "bad_selling_price", "bad_selling_price", "bad_time"]
    assert to_prices(records, KEY).filter(F.col("selling_price").isNull()).count() == 2


def test_summary_uses_the_population_deviation(spark):
    r = price_summary(prices(spark, [1, 3], [2, 2]), KEY).first()
    assert (r.total_records, r.selling_price_mean, r.selling_price_std, r.buying_price_std) == (2, 2.0, 1.0, 0.0)


def test_quality_report(spark):
    rows = [("a", "10", "9", "2024-01-01")] * 2 + [("a", "", "9", "2024-01-02"), ("a", "10", None, "")]
    rows += [("a", "10", "9", f"2024-02-{d:02d}") for d in range(1, 29)] + [("a", "99999", "9", "2024-03-01"), ("a", "99.5", "9", "2024-03-02")]
    found = {r.check: (r.n_bad, r.passed) for r in quality_report(spark.createDataFrame(rows, RECORD), KEY, 60).collect()}
    assert found == {
        "insufficient_rows": (60 - len(rows), False),
        "missing_selling_price": (1, False),
        "missing_buying_price": (1, False),
        "missing_dates": (1, False),
        "duplicate_dates": (1, False),
        "outliers": (1, False),
    }


def test_zscore(spark):
    df = prices(spark, [10] * 30 + [1000])
    assert zscore_outliers(df, KEY, "selling_price").filter("is_outlier").count() == 1
    assert zscore_outliers(df, KEY, "selling_price", action="drop").count() == 30
    assert zscore_outliers(prices(spark, [5, 5]), KEY, "selling_price").filter("is_outlier").count() == 0


def test_short_series_are_rejected(spark):
    both = prices(spark, range(1, 11)).union(prices(spark, [1, 2], series="b"))
    kept, rejects = require_min_rows(both, KEY, 5)
    assert kept.count() == 10
    assert [(r.series, r.n_rows) for r in rejects.collect()] == [("b", 2)]
    assert require_min_rows(both, [], 13)[0].count() == 0
    assert require_min_rows(both, [], 12)[0].count() == 12


def test_latest_days(spark):
    assert by_time(latest_days(prices(spark, range(10)), KEY, "ts", 3), "selling_price") == [6, 7, 8, 9]


def test_lookups_lose_no_rows(spark):
    from tidemark.operators.scaling import apply_scaler, fit_scaler, inverse_price

    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("new", 7.0), (None, 9.0)], "series string, selling_price double")
    scaler = fit_scaler(df.filter("series = 'a'"), ["series"], ["selling_price"], "zscore")
    scaled = apply_scaler(df, scaler, ["selling_price"])
    assert sorted((r.series or "", r.selling_price) for r in scaled.collect()) == [("", 9.0), ("a", -1.0), ("a", 1.0), ("new", 7.0)]
    back = inverse_price(scaled, "selling_price", scaler)
    assert sorted(r.selling_price for r in back.collect()) == [1.0, 3.0, 7.0, 9.0]


def test_a_number_zero_counts_as_missing(spark):
    from tidemark.operators.cleaning import quality_report
    from tidemark.schemas import BUY_FIELD, SELL_FIELD, TIME_FIELD

    df = spark.createDataFrame([("a", "0", "5", "2024-01-01"), ("a", "7", "", "2024-01-02")], f"series string, {SELL_FIELD} string, {BUY_FIELD} string, {TIME_FIELD} string")
    bad = {r.check: r.n_bad for r in quality_report(df, ["series"]).collect()}
    assert bad["missing_selling_price"] == 1 and bad["missing_buying_price"] == 1 and bad["missing_dates"] == 0
