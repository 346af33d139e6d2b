import math

import numpy as np
import pytest
from frames import day, predictions, prices

from tidemark.operators.alignment import align_predictions, merge_metrics, naive_forecast
from tidemark.operators.metrics import (
    equity_curve,
    evaluate,
    evaluate_wide,
    forecast_diagnostics,
    regression_metrics,
    strategy_returns,
    trading_metrics,
    trend_accuracy,
)

# The worked example and its expected metrics.
Y = [100, 102, 101, 105, 105]
P = [100, 101, 103, 104, 106]
WANT = {
    "mae": 1.0, "mse": 1.4, "rmse": 1.183216, "mape": 0.973070, "smape": 0.970162, "mase": 0.571429,
    "r2": 0.669811, "explained_variance": 0.679245, "max_error": 2.0, "directional_accuracy": 50.0,
    "strategy_return": 5.0, "buy_hold_return": 5.0, "excess_return": 0.0, "sharpe_ratio": 10.399901,
    "max_drawdown": -0.980392, "win_rate": 50.0, "profit_factor": 6.079604, "calmar_ratio": 5.1,
    "final_portfolio_value": 10500.0, "theil_u": 0.577350, "residual_autocorr": -0.785674,
    "forecast_bias": 0.2, "tracking_signal": -0.2, "mean_residual": -0.2, "std_residual": 1.166190,
}


@pytest.mark.parametrize("blocks", [None, 2])
def test_worked_example(spark, blocks):
    r = evaluate_wide(predictions(spark, Y, P), blocks=blocks).first().asDict()
    for name, value in WANT.items():
        assert r[name] == pytest.approx(value, abs=1e-6), name


def test_long_form_and_families(spark):
    df = predictions(spark, Y, P)
    long = {(r.category, r.metric): r.value for r in evaluate(df, blocks=None).collect()}
    assert len(long) == 25
    assert long["trading_metrics", "calmar_ratio"] == pytest.approx(5.1)
    plain = evaluate(df, include_trading=False, blocks=None)
    assert {r.category for r in plain.select("category").distinct().collect()} == {"regression_metrics", "time_series_metrics"}
    families = [f(df, blocks=None) for f in (regression_metrics, forecast_diagnostics, trading_metrics)]
    merged = merge_metrics(families, ["model", "series"]).first().asDict()
    assert {k: merged[k] for k in WANT} == pytest.approx(WANT, abs=1e-6)


def test_strategy_rows_and_curve(spark):
    df = predictions(spark, Y, P)
    got = [r.strategy_return for r in strategy_returns(df, blocks=None).orderBy("ts").collect()]
    assert got == pytest.approx([0.02, -0.009804, 0.039604, 0.0], abs=1e-6)
    curve = equity_curve(df, blocks=None).orderBy("ts").collect()
    assert [c.running_max for c in curve] == pytest.approx([1.02, 1.02, 1.05, 1.05], abs=1e-6)


def test_cost_is_charged_on_entry_and_on_flips(spark):
    df = predictions(spark, [100, 100, 100, 100, 100], [1, 2, 3, 2, 1])
    for blocks in (None, 2):
        got = [r.strategy_return for r in strategy_returns(df, cost=0.5, blocks=blocks).orderBy("ts").collect()]
        assert got == [-0.5, 0.0, -0.5, 0.0]


def test_constant_truth(spark):
    r = evaluate_wide(predictions(spark, [5, 5, 5], [5, 6, 5]), blocks=None).first()
    assert r.r2 == 0.0 and r.mase == math.inf and r.theil_u == math.inf and r.explained_variance is None
    assert evaluate_wide(predictions(spark, [5, 5], [5, 5]), blocks=None).first().r2 == 1.0


def test_one_row(spark):
    df = predictions(spark, [5], [6])
    r = evaluate_wide(df, blocks=None).first()
    assert r.mase == math.inf and r.directional_accuracy == 0.0 and r.residual_autocorr == 0.0 and r.r2 is None
    assert r.final_portfolio_value is None
    assert trading_metrics(df, blocks=None).count() == 0


def test_zero_truth_is_left_out_of_mape(spark):
    assert regression_metrics(predictions(spark, [0, 10], [1, 11]), blocks=None).first().mape == pytest.approx(10.0)
    r = regression_metrics(predictions(spark, [0, 0], [0, 0]), blocks=None).first()
    assert r.mape == math.inf and r.smape == 0.0


def test_constant_residuals(spark):
    r = forecast_diagnostics(predictions(spark, [1, 2, 3, 4], [0, 1, 2, 3]), blocks=None).first()
    assert r.residual_autocorr == 0.0 and r.tracking_signal == 1.0


def test_no_losses(spark):
    r = trading_metrics(predictions(spark, [1, 2, 3], [1, 2, 3]), blocks=None).first()
    assert r.profit_factor == math.inf and r.calmar_ratio == math.inf and r.max_drawdown == 0.0


def test_trend_accuracy(spark):
    r = trend_accuracy(predictions(spark, [1, 2, 3, 2, 2], [1, 2, 1, 0, 5]), blocks=None).first()
    assert (r.uptrend_accuracy, r.downtrend_accuracy) == (50.0, 100.0)


def test_identities(spark):
    rng = np.random.default_rng(0)
    y = 100 + rng.normal(0, 1, 300).cumsum()
    p = y + rng.normal(0.3, 1, 300)
    r = evaluate_wide(predictions(spark, y, p), blocks=64).first()
    assert r.rmse**2 == pytest.approx(r.mse)
    assert r.mse == pytest.approx(r.mean_residual**2 + r.std_residual**2)
    assert r.forecast_bias == pytest.approx(-r.mean_residual)
    assert r.excess_return == pytest.approx(r.strategy_return - r.buy_hold_return)
    assert r.calmar_ratio == pytest.approx(r.strategy_return / abs(r.max_drawdown))
    assert r.final_portfolio_value == pytest.approx(10000 * (1 + r.strategy_return / 100))
    assert r.explained_variance >= r.r2
    e = y - p
    assert r.residual_autocorr == pytest.approx(np.corrcoef(e[:-1], e[1:])[0, 1])


def test_naive_forecast_has_theil_u_one(spark):
    naive = naive_forecast(prices(spark, [3, 5, 4, 8, 9]), ["series"], blocks=None)
    assert forecast_diagnostics(naive, blocks=None).first().theil_u == pytest.approx(1.0)


def test_alignment_is_by_time(spark):
    actual = spark.createDataFrame([("a", day(i), float(i)) for i in range(5)], "series string, ts timestamp, y_true double")
    predicted = spark.createDataFrame([("a", day(i), 10.0 + i) for i in (7, 3, 2)], "series string, ts timestamp, y_pred double")
    got = align_predictions(actual, predicted, ["series"]).orderBy("ts").collect()
    assert [(r.y_true, r.y_pred) for r in got] == [(2.0, 12.0), (3.0, 13.0)]
