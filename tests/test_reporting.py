import statistics

import numpy as np
import pytest
from frames import predictions, prices
from pyspark.sql import functions as F

from tidemark.functions.normal import with_normal_quantile
from tidemark.functions.numeric import correlation
from tidemark.operators.features import add_indicators
from tidemark.operators.metrics import evaluate
from tidemark.operators.reporting import (
    best_model,
    head_forecast,
    histogram,
    indicator_panel,
    metric_panel,
    plot_r2,
    qq_fit,
    qq_points,
    rank_features,
    run_summary,
    summary_table,
    top_metrics,
    write_summary,
)

KEY = ["series"]
GROUP = ["model", "series"]


def test_normal_quantile(spark):
    p = [1e-12, 1e-5, 0.01, 0.07, 0.075, 0.3, 0.5, 0.8, 0.925, 0.93, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(x,) for x in p], "p double")
    for r in with_normal_quantile(df, "p", "z").collect():
        assert r.z == pytest.approx(statistics.NormalDist().inv_cdf(r.p), abs=1e-9)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 9.0)], "x double, y double")
    assert df.agg(correlation(F.col("x"), F.col("y"))).first()[0] is None


@pytest.mark.parametrize("keys", [[], KEY])
def test_histogram_equals_numpy(spark, keys):
    values = np.round(np.random.default_rng(1).exponential(10, 500), 1)
    found = histogram(prices(spark, values.tolist()), "selling_price", 30, keys).orderBy("bin").collect()
    counts, edges = np.histogram(values, 30)
    assert sum(r.n for r in found) == 500
    assert [r.n for r in found] == counts.tolist()
    assert [r.lower for r in found] == pytest.approx(edges[:-1])
    assert found[-1].upper == edges[-1]


def test_histogram_of_a_constant(spark):
    found = histogram(prices(spark, [3, 3]), "selling_price", 4).orderBy("bin").collect()
    counts, edges = np.histogram([3, 3], 4)
    assert [r.n for r in found] == counts.tolist() and found[0].lower == edges[0] == 2.5


@pytest.mark.parametrize("blocks", [None, 10])
def test_probability_plot(spark, blocks):
    values = [4.0, 1.0, 4.0, 2.0, 9.0, 4.0, 0.5] * 5
    points = qq_points(prices(spark, values), "selling_price", KEY, blocks).orderBy("rank").collect()
    n, nd = len(values), statistics.NormalDist()
    assert [r.ordered for r in points] == sorted(values)
    want = [1 - 0.5 ** (1 / n)] + [(i - 0.3175) / (n + 0.365) for i in range(2, n)] + [0.5 ** (1 / n)]
    assert [r.theoretical for r in points] == pytest.approx([nd.inv_cdf(p) for p in want], abs=1e-9)
    fit = qq_fit(qq_points(prices(spark, values), "selling_price", KEY, blocks), KEY).first()
    x, y = np.array([r.theoretical for r in points]), np.array(sorted(values))
    assert (fit.slope, fit.intercept) == pytest.approx(tuple(np.polyfit(x, y, 1)))
    assert fit.r == pytest.approx(np.corrcoef(x, y)[0, 1])


def test_reports(spark, tmp_path):
    long = evaluate(predictions(spark, [1, 2, 3, 2], [1, 2, 2, 3]), blocks=None)
    top = [r.metric for r in top_metrics(long, GROUP, 3).orderBy("rank").collect()]
    assert top == ["mae", "rmse", "mape"]
    partial = long.filter("metric in ('r2', 'max_error')")
    assert [r.metric for r in top_metrics(partial, GROUP).orderBy("rank").collect()] == ["r2", "max_error"]
    assert metric_panel(long).count() == 5 and metric_panel(long, "trading").count() == 4
    runs = run_summary(
        spark.createDataFrame([("r", i, 1.0 / i, 2.0 / i + (i == 3), 0.0, 2.0) for i in (1, 3, 2)], "run_id string, step int, train_loss double, val_loss double, learning_rate double, seconds double")
    )
    r = runs.first()
    assert (r.total_steps, r.best_val_loss, r.final_val_loss, r.steps_per_second) == (3, 1.0, pytest.approx(5 / 3), 0.5)
    table = summary_table(long, runs, {"length": 60})
    lines = {(x.section, x.name): x.value for x in table.collect()}
    assert lines["Performance Metrics", "mae"] == "0.5000"
    assert lines["Training Summary", "Final Validation Loss"] == "1.6667"
    assert lines["Model Configuration", "length"] == "60"
    path = str(tmp_path / "summary")
    write_summary(table, path)
    assert "Training Summary / Total Epochs: 3" in [x.value for x in spark.read.text(path).collect()]


def test_summary_lines_name_their_group(spark, tmp_path):
    metrics = spark.createDataFrame([("a", "x", "mae", 1.0), ("a", None, "mae", 2.0), ("b", "x", "mae", 3.0)], "model string, series string, metric string, value double")
    table = summary_table(metrics, params={"length": 60}, group=GROUP)
    write_summary(table, str(tmp_path / "s"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "s")).collect()) == [
        "Model Configuration / length: 60",
        "Performance Metrics [model=a, series=x] / mae: 1.0000",
        "Performance Metrics [model=a] / mae: 2.0000",
        "Performance Metrics [model=b, series=x] / mae: 3.0000",
    ]


def test_lists(spark):
    board = spark.createDataFrame([("a", 0.5), ("b", None), ("c", 0.7)], "model string, r2 double")
    assert best_model(board).first().model == "c"
    head = head_forecast(prices(spark, range(7)), KEY, n=5).orderBy("step").collect()
    assert [r.step for r in head] == [1, 2, 3, 4, 5] and head[0].remaining == 2
    ranked = spark.createDataFrame([("x", 1.0), ("y", 3.0), ("z", 2.0)], "feature string, importance double")
    assert [r.feature for r in rank_features(ranked).collect()] == ["y", "z", "x"]


def test_plot_r2_is_the_squared_correlation(spark):
    y, p = [1.0, 2.0, 4.0, 3.0], [2.0, 2.5, 3.0, 3.5]
    assert plot_r2(predictions(spark, y, p), GROUP).first().plot_r2 == pytest.approx(np.corrcoef(y, p)[0, 1] ** 2)


def test_indicator_panel(spark):
    panel = indicator_panel(add_indicators(prices(spark, range(1, 31)), KEY, blocks=None), KEY)
    assert {r.rsi_state for r in panel.collect()} == {None, "overbought"}
    assert "volume" not in panel.columns and "bb_upper" in panel.columns


def test_histogram_counts_what_is_not_finite_apart(spark):
    from tidemark.operators.reporting import histogram

    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("a", nan), ("a", -inf), ("b", inf), ("c", 1.0)], "series string, v double")
    got = {(r.series, r.bin): (r.lower, r.upper, r.n) for r in histogram(df, "v", 2, ["series"]).collect()}
    assert got == {("a", 0): (0.0, 5.0, 1), ("a", 1): (5.0, 10.0, 1), ("a", None): (None, None, 2), ("b", None): (None, None, 1),
                   ("c", 0): (0.5, 1.0, 0), ("c", 1): (1.0, 1.5, 1)}
