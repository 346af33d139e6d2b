"""Queries over alignment, forecast metrics, back-tests and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.normal import (
    CENTRE_DEN,
    CENTRE_NUM,
    MIDDLE_DEN,
    MIDDLE_NUM,
    TAIL_DEN,
    TAIL_NUM,
)
from tidemark.operators.alignment import (
    align_predictions,
    attach_dates,
    merge_metrics,
    naive_forecast,
    trailing_mean_forecast,
)
from tidemark.operators.metrics import (
    compare_models,
    equity_curve,
    evaluate,
    evaluate_wide,
    forecast_diagnostics,
    regression_metrics,
    returns_to_date,
    strategy_returns,
    trading_metrics,
    trend_accuracy,
)
from tidemark.operators.reporting import (
    best_model,
    head_forecast,
    histogram,
    metric_panel,
    plot_r2,
    qq_fit,
    qq_points,
    rank_features,
    residual_table,
    run_summary,
    summary_table,
    top_metrics,
)
from tidemark.functions.numeric import correlation
from tidemark.operators.features import add_indicators
from tidemark.plans.catalog.cleaning import BLOCK, KEY
from tidemark.plans.catalog.features import indicators_sql
from tidemark.plans.catalog.registry import query, rounded, rounded_sql, rounding, sql_round
from tidemark.plans.views import (
    PREDICTIONS_EVENTS,
    PREDICTIONS_LINEITEM,
    PRICES_LINEITEM,
    PRICES_ORDERS,
    TICKS_EVENTS,
    predictions_events,
    predictions_lineitem,
    prices_lineitem,
    prices_orders,
    ticks_events,
)
from tidemark.schemas import (
    DIAGNOSTIC_METRICS,
    FEATURES,
    REGRESSION_METRICS,
    REGRESSION_PANEL,
    SUMMARY_ORDER,
    TRADING_METRICS,
    TRADING_PANEL,
)
from tidemark.session import stored

GROUP = ["model", "series"]
ROW = ["model", "series", "ts"]


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    return predictions_lineitem(spark, folder)


def _tick_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return predictions_events(spark, folder, BLOCK)


@query("naive_forecast", f"SELECT * FROM ({PREDICTIONS_EVENTS}) WHERE model = 'naive'")
def _naive(spark: SparkSession, folder: str) -> DataFrame:
    return naive_forecast(ticks_events(spark, folder), KEY, blocks=BLOCK)


@query(
    "trailing_mean_forecast",
    rounded_sql(f"SELECT * FROM ({PREDICTIONS_LINEITEM}) WHERE model = 'ma10'", {4: ["y_pred"]}, [*ROW, "y_true", "y_pred"]),
)
def _trailing(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(trailing_mean_forecast(prices_lineitem(spark, folder), KEY, blocks=None), {4: ["y_pred"]})


@query(
    "align_predictions",
    f"""SELECT p.model, p.series, p.ts, t.selling_price AS y_true, p.y_pred FROM ({TICKS_EVENTS}) t
        JOIN ({PREDICTIONS_EVENTS}) p ON p.series = t.series AND p.ts = t.ts WHERE p.model = 'naive'""",
)
def _align(spark: SparkSession, folder: str) -> DataFrame:
    ticks = ticks_events(spark, folder)
    predicted = naive_forecast(ticks, KEY, blocks=BLOCK).drop("y_true")
    return align_predictions(ticks, predicted, KEY, actual_column="selling_price")


@query(
    "attach_dates",
    f"""SELECT p.model, p.series, p.ts, p.y_true, p.y_pred, t.spread FROM ({PREDICTIONS_LINEITEM}) p
        LEFT JOIN ({PRICES_LINEITEM}) t ON p.series = t.series AND p.ts = t.ts WHERE p.model = 'naive'""",
)
def _attach(spark: SparkSession, folder: str) -> DataFrame:
    prices = prices_lineitem(spark, folder)
    return attach_dates(naive_forecast(prices, KEY, blocks=None), prices, KEY)


def _lagged(source: str, group: str = "model, series") -> str:
    return f"""lagged AS (SELECT *, y_true - y_pred AS e, lag(y_true) OVER w AS y1, lag(y_pred) OVER w AS p1,
         lag(y_true - y_pred) OVER w AS e1 FROM ({source}) WINDOW w AS (PARTITION BY {group} ORDER BY ts))"""


_REGRESSION = """avg(abs(e)) AS mae, avg(e * e) AS mse, sqrt(avg(e * e)) AS rmse,
  coalesce(100 * avg(abs(e / nullif(y_true, 0))), CAST('inf' AS DOUBLE)) AS mape,
  coalesce(100 * avg(abs(e) / nullif((abs(y_true) + abs(y_pred)) / 2, 0)), 0) AS smape,
  coalesce(avg(abs(e)) / nullif(avg(abs(y_true - y1)), 0), CAST('inf' AS DOUBLE)) AS mase,
  1 - sum(e * e) / (var_pop(y_true) * count(*)) AS r2, 1 - var_pop(e) / var_pop(y_true) AS explained_variance,
  max(abs(e)) AS max_error,
  coalesce(100 * avg(CASE WHEN y1 IS NULL THEN NULL WHEN (y_true > y1) = (y_pred > p1) THEN 1 ELSE 0 END), 0) AS directional_accuracy"""
_DIAGNOSTICS = """coalesce(sqrt(avg(CASE WHEN y1 IS NOT NULL THEN e * e END)) / nullif(sqrt(avg((y_true - y1) * (y_true - y1))), 0), CAST('inf' AS DOUBLE)) AS theil_u,
  coalesce(covar_pop(e1, CASE WHEN e1 IS NOT NULL THEN e END) / nullif(stddev_pop(e1) * stddev_pop(CASE WHEN e1 IS NOT NULL THEN e END), 0), 0) AS residual_autocorr,
  avg(-e) AS forecast_bias, coalesce(sum(e) / nullif(avg(abs(e)) * count(*), 0), 0) AS tracking_signal,
  avg(e) AS mean_residual, stddev_pop(e) AS std_residual"""
_TRADING = """100 * (product(1 + s) - 1) AS strategy_return,
  100 * (arg_max(y_true, ts) - arg_min(y_true, ts)) / arg_min(y_true, ts) AS buy_hold_return,
  100 * (product(1 + s) - 1) - 100 * (arg_max(y_true, ts) - arg_min(y_true, ts)) / arg_min(y_true, ts) AS excess_return,
  coalesce(sqrt(252) * avg(s) / nullif(stddev_pop(s), 0), 0) AS sharpe_ratio, 100 * min(drawdown) AS max_drawdown,
  100 * avg(CASE WHEN s IS NULL THEN NULL WHEN s > 0 THEN 1 ELSE 0 END) AS win_rate,
  sum(CASE WHEN s > 0 THEN s ELSE 0 END) / abs(sum(CASE WHEN s < 0 THEN s END)) AS profit_factor,
  (product(1 + s) - 1) / abs(min(drawdown)) AS calmar_ratio, 10000 * product(1 + s) AS final_portfolio_value"""


def _curve(cost: float = 0.0) -> str:
    charge = f"- CASE WHEN pos <> coalesce(lag(pos) OVER w, 0) THEN CAST({cost} AS DOUBLE) ELSE 0 END" if cost else ""
    return f"""placed AS (SELECT *, CASE WHEN y1 IS NOT NULL THEN CASE WHEN y_pred > p1 THEN 1 ELSE -1 END END AS pos FROM lagged),
earned AS (SELECT *, pos * ((y_true - y1) / nullif(y1, 0)) {charge} AS s FROM placed WINDOW w AS (PARTITION BY model, series ORDER BY ts)),
grown AS (SELECT *, product(CASE WHEN s IS NOT NULL THEN 1 + s END) OVER w AS cum FROM earned
  WINDOW w AS (PARTITION BY model, series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
peaked AS (SELECT *, max(cum) OVER w AS peak FROM grown
  WINDOW w AS (PARTITION BY model, series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
curve AS (SELECT *, (cum - peak) / nullif(peak, 0) AS drawdown FROM peaked)"""


def _shown(names: tuple[str, ...] | list[str]) -> dict[int, list[str]]:
    """Squared money keeps two places, money four, ratios six."""
    money = {"mae", "rmse", "max_error", "forecast_bias", "mean_residual", "std_residual", "final_portfolio_value"}
    return {
        2: [n for n in names if n == "mse"],
        4: [n for n in names if n in money],
        6: [n for n in names if n != "mse" and n not in money],
    }


def _metrics_sql(source: str, names: tuple[str, ...], what: str, table: str = "lagged", extra: str = "") -> str:
    return f"""WITH {_lagged(source)}{extra}, m AS (SELECT model, series, {what} FROM {table} GROUP BY model, series)
        SELECT {rounding(_shown(names), [*GROUP, *names])} FROM m"""


@query("regression_metrics", _metrics_sql(PREDICTIONS_EVENTS, REGRESSION_METRICS, _REGRESSION))
def _regression(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(regression_metrics(_tick_predictions(spark, folder), blocks=BLOCK), _shown(REGRESSION_METRICS))


@query("compare_models", _metrics_sql(PREDICTIONS_LINEITEM, REGRESSION_METRICS, _REGRESSION))
def _compare(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(compare_models(_predictions(spark, folder), blocks=None), _shown(REGRESSION_METRICS))


@query("forecast_diagnostics", _metrics_sql(PREDICTIONS_EVENTS, DIAGNOSTIC_METRICS, _DIAGNOSTICS))
def _diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(forecast_diagnostics(_tick_predictions(spark, folder), blocks=BLOCK), _shown(DIAGNOSTIC_METRICS))


@query("trading_metrics", _metrics_sql(PREDICTIONS_LINEITEM, TRADING_METRICS, _TRADING, "curve", ", " + _curve()))
def _trading(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(trading_metrics(_predictions(spark, folder), blocks=None), _shown(TRADING_METRICS))


@query("trading_metrics_cost", _metrics_sql(PREDICTIONS_LINEITEM, TRADING_METRICS, _TRADING, "curve", ", " + _curve(0.001)))
def _trading_cost(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(trading_metrics(_predictions(spark, folder), cost=0.001, blocks=None), _shown(TRADING_METRICS))


# Daily changes of a few percent, so that products over long tick series stay in range.
_CALM = f"""SELECT model, series, ts, 1000 + y_true AS y_true, 1000 + y_pred AS y_pred FROM ({PREDICTIONS_EVENTS})"""


def _calm(spark: SparkSession, folder: str) -> DataFrame:
    moved = {"y_true": 1000 + F.col("y_true"), "y_pred": 1000 + F.col("y_pred")}
    return _tick_predictions(spark, folder).withColumns(moved)


@query("trading_metrics_blocks", _metrics_sql(_CALM, TRADING_METRICS, _TRADING, "curve", ", " + _curve(0.0001)))
def _trading_blocks(spark: SparkSession, folder: str) -> DataFrame:
    found = trading_metrics(_calm(spark, folder), cost=0.0001, blocks=BLOCK)
    return rounded(found, _shown(TRADING_METRICS))


@query(
    "strategy_returns",
    f"WITH {_lagged(PREDICTIONS_LINEITEM)}, {_curve(0.001)} SELECT {rounding({6: ['strategy_return']}, [*ROW, 'position', 'strategy_return'])} "
    "FROM (SELECT *, pos AS position, s AS strategy_return FROM earned) WHERE pos IS NOT NULL",
)
def _strategy(spark: SparkSession, folder: str) -> DataFrame:
    made = strategy_returns(_predictions(spark, folder), cost=0.001, blocks=None)
    return rounded(made, {6: ["strategy_return"]})


_CURVE = ["strategy_return", "cumulative_return", "running_max", "drawdown"]


@query(
    "equity_curve",
    f"WITH {_lagged(_CALM)}, {_curve()} SELECT {rounding({6: _CURVE}, [*ROW, *_CURVE])} "
    "FROM (SELECT *, s AS strategy_return, cum AS cumulative_return, peak AS running_max FROM curve) WHERE pos IS NOT NULL",
)
def _equity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(equity_curve(_calm(spark, folder), blocks=BLOCK), {6: _CURVE})


_HELD = ["return", "cumulative_return", "running_max", "drawdown"]


@query(
    "returns_to_date",
    f"""WITH r AS (SELECT series, ts, (selling_price - lag(selling_price) OVER w) / lag(selling_price) OVER w AS ret FROM ({PRICES_ORDERS})
                   WINDOW w AS (PARTITION BY series ORDER BY ts)),
        c AS (SELECT *, product(CASE WHEN ret IS NOT NULL THEN 1 + ret END) OVER w AS cum FROM r
              WINDOW w AS (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        m AS (SELECT *, max(cum) OVER w AS peak FROM c WINDOW w AS (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        SELECT series, ts, {sql_round("ret", 6, '"return"')}, {sql_round("cum", 6, "cumulative_return")},
               {sql_round("peak", 6, "running_max")}, {sql_round("(cum - peak) / peak", 6, "drawdown")} FROM m WHERE ret IS NOT NULL""",
)
def _returns(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(returns_to_date(prices_orders(spark, folder), KEY, blocks=None), {6: _HELD})


@query(
    "trend_accuracy",
    f"""WITH {_lagged(PREDICTIONS_LINEITEM)}, m AS (SELECT model, series,
          100 * avg(CASE WHEN y_true > y1 THEN CASE WHEN y_pred > p1 THEN 1 ELSE 0 END END) AS uptrend_accuracy,
          100 * avg(CASE WHEN y_true < y1 THEN CASE WHEN y_pred <= p1 THEN 1 ELSE 0 END END) AS downtrend_accuracy FROM lagged GROUP BY model, series)
        SELECT {rounding({6: ["uptrend_accuracy", "downtrend_accuracy"]}, [*GROUP, "uptrend_accuracy", "downtrend_accuracy"])} FROM m""",
)
def _trend(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(trend_accuracy(_predictions(spark, folder), blocks=None), {6: ["uptrend_accuracy", "downtrend_accuracy"]})


_EVERY = (*REGRESSION_METRICS, *DIAGNOSTIC_METRICS, *TRADING_METRICS)
_WIDE = f"WITH {_lagged(PREDICTIONS_LINEITEM)}, {_curve()}, m AS (SELECT model, series, {_REGRESSION}, {_DIAGNOSTICS}, {_TRADING} FROM curve GROUP BY model, series)"


def _long_sql(names: tuple[str, ...], head: str = _WIDE) -> str:
    def category(n: str) -> str:
        kind = "regression" if n in REGRESSION_METRICS else "trading" if n in TRADING_METRICS else "time_series"
        return f"{kind}_metrics"

    rows = " UNION ALL ".join(
        f"SELECT model, series, '{category(n)}' AS category, '{n}' AS metric, {n} AS value FROM m" for n in names
    )
    return f"{head} SELECT model, series, category, metric, {sql_round('value', 4, 'value')} FROM ({rows})"


@query("evaluate", _long_sql(_EVERY))
def _evaluate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate(_predictions(spark, folder), blocks=None), {4: ["value"]})


@query("evaluate_without_trading", _long_sql((*REGRESSION_METRICS, *DIAGNOSTIC_METRICS)))
def _evaluate_plain(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate(_predictions(spark, folder), include_trading=False, blocks=None), {4: ["value"]})


@query("merge_metrics", f"{_WIDE} SELECT {rounding(_shown(_EVERY), [*GROUP, *_EVERY])} FROM m")
def _merge(spark: SparkSession, folder: str) -> DataFrame:
    rows = _predictions(spark, folder)
    families = [f(rows, blocks=None) for f in (regression_metrics, forecast_diagnostics, trading_metrics)]
    return rounded(merge_metrics(families, GROUP), _shown(_EVERY))


_RANKED = ", ".join(f"('{m}', {i})" for i, m in enumerate(SUMMARY_ORDER, 1))


@query(
    "top_metrics",
    f"SELECT l.model, l.series, o.place AS rank, l.metric, l.value FROM ({_long_sql(_EVERY)}) l JOIN (VALUES {_RANKED}) o(metric, place) USING (metric) WHERE place <= 5",
)
def _top(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(top_metrics(evaluate(_predictions(spark, folder), blocks=None), GROUP), {4: ["value"]})


@query("regression_panel", f"SELECT * FROM ({_long_sql(_EVERY)}) WHERE metric IN ({', '.join(repr(n) for n in REGRESSION_PANEL)})")
def _panel_regression(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metric_panel(evaluate(_predictions(spark, folder), blocks=None)), {4: ["value"]})


@query("trading_panel", f"SELECT * FROM ({_long_sql(_EVERY)}) WHERE metric IN ({', '.join(repr(n) for n in TRADING_PANEL)})")
def _panel_trading(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metric_panel(evaluate(_predictions(spark, folder), blocks=None), "trading"), {4: ["value"]})


# Squared errors of a model by year stand for a training history: even days train, odd days validate.
_HISTORY = f"""SELECT model AS run_id, year(ts) AS step, avg(CASE WHEN day(ts) % 2 = 0 THEN (y_true - y_pred) * (y_true - y_pred) END) AS train_loss,
          avg(CASE WHEN day(ts) % 2 = 1 THEN (y_true - y_pred) * (y_true - y_pred) END) AS val_loss FROM ({PREDICTIONS_LINEITEM}) GROUP BY 1, 2"""
_RUNS = """SELECT run_id, count(*) AS total_steps, min(train_loss) AS best_train_loss, min(val_loss) AS best_val_loss,
          arg_max(train_loss, step) AS final_train_loss, arg_max(val_loss, step) AS final_val_loss FROM h GROUP BY run_id"""
_LOSSES = ["best_train_loss", "best_val_loss", "final_train_loss", "final_val_loss"]


def _history(predictions: DataFrame) -> DataFrame:
    squared = F.pow(F.col("y_true") - F.col("y_pred"), F.lit(2))
    even = F.dayofmonth("ts") % 2 == 0
    return predictions.groupBy(F.col("model").alias("run_id"), F.year("ts").alias("step")).agg(
        F.avg(F.when(even, squared)).alias("train_loss"), F.avg(F.when(~even, squared)).alias("val_loss")
    )


@query("yearly_run_summary", f"WITH h AS ({_HISTORY}) SELECT {rounding({2: _LOSSES}, ['run_id', 'total_steps', *_LOSSES])} FROM ({_RUNS})")
def _yearly_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of histories with a step per year."""
    return rounded(run_summary(_history(_predictions(spark, folder))), {2: _LOSSES})


_SHOWN = [n for n in (*REGRESSION_METRICS, *DIAGNOSTIC_METRICS) if n != "mse"]


def _nine_digits(value: Column) -> Column:
    """A number to nine significant digits, nothing below a shown place; products of returns have no fixed number of places."""
    k = F.floor(F.log10(F.abs(value))) - 8
    up, down = F.pow(F.lit(10.0), F.greatest(k, F.lit(0)).cast("double")), F.pow(F.lit(10.0), F.greatest(-k, F.lit(0)).cast("double"))
    shown = F.coalesce(F.round(value * down / up) / down * up, value)
    return F.when(F.abs(value) < 0.00005, 0.0).otherwise(shown)


def _nine_digits_sql(value: str) -> str:
    k = f"(floor(log10(nullif(abs({value}), 0))) - 8)"
    up, down = f"pow(10.0::DOUBLE, greatest({k}, 0))", f"pow(10.0::DOUBLE, greatest(-{k}, 0))"
    return f"CASE WHEN abs({value}) < 0.00005 THEN 0 ELSE coalesce(round({value} * {down} / {up}) / {down} * {up}, {value}) END"


_PARAMS = {"length": 10, "features": 1}


@query(
    "summary_table",
    f"""{_WIDE}, h AS ({_HISTORY}), runs AS ({_RUNS})
        SELECT section, model, series, name, value FROM (
        {" UNION ALL ".join(f"SELECT 'Performance Metrics' AS section, model, series, '{n}' AS name, printf('%.4f', {n}) AS value FROM m" for n in _SHOWN)}
        UNION ALL SELECT 'Performance Metrics', model, series, 'mse', printf('%.4f', round(mse, 2)) FROM m
        {" ".join(f"UNION ALL SELECT 'Performance Metrics', model, series, '{n}', printf('%.4f', {_nine_digits_sql(n)}) FROM m WHERE {n} IS NOT NULL" for n in TRADING_METRICS)}
        UNION ALL SELECT 'Training Summary', run_id, NULL, 'Final Training Loss', printf('%.4f', round(final_train_loss, 2)) FROM runs
        UNION ALL SELECT 'Training Summary', run_id, NULL, 'Final Validation Loss', printf('%.4f', round(final_val_loss, 2)) FROM runs
        UNION ALL SELECT 'Training Summary', run_id, NULL, 'Best Validation Loss', printf('%.4f', round(best_val_loss, 2)) FROM runs
        UNION ALL SELECT 'Training Summary', run_id, NULL, 'Total Epochs', CAST(total_steps AS VARCHAR) FROM runs
        UNION ALL SELECT 'Model Configuration', NULL, NULL, name, value FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in _PARAMS.items())}) p(name, value))""",
)
def _summary(spark: SparkSession, folder: str) -> DataFrame:
    """The report of all groups, with its three sections and every metric; squared prices to two places."""
    predictions = stored(_predictions(spark, folder))
    metrics = evaluate(predictions, blocks=None)
    shown = F.when(F.col("metric") == "mse", F.round("value", 2)).when(F.col("metric").isin(*TRADING_METRICS), _nine_digits(F.col("value")))
    metrics = metrics.withColumn("value", shown.otherwise(F.col("value")))
    runs = run_summary(_history(predictions))
    runs = runs.withColumns({c: F.round(c, 2) for c in _LOSSES})
    return summary_table(metrics, runs, _PARAMS, GROUP)


@query(
    "best_model",
    f"""{_WIDE} SELECT model, series, {sql_round("rmse", 4, "rmse")}, {sql_round("r2", 6, "r2")} FROM m ORDER BY m.r2 DESC LIMIT 1""",
)
def _best(spark: SparkSession, folder: str) -> DataFrame:
    board = compare_models(_predictions(spark, folder), blocks=None).select("model", "series", "rmse", "r2")
    return rounded(best_model(board), {4: ["rmse"], 6: ["r2"]})


@query(
    "head_forecast",
    f"""SELECT series, ts, y_pred, step, n - 5 AS remaining FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) AS step,
          count(*) OVER (PARTITION BY series) AS n FROM ({PREDICTIONS_EVENTS}) WHERE model = 'naive') WHERE step <= 5""",
)
def _head(spark: SparkSession, folder: str) -> DataFrame:
    rows = naive_forecast(ticks_events(spark, folder), KEY, blocks=BLOCK).select("series", "ts", "y_pred")
    return head_forecast(rows, KEY)


_MEASURED = [f for f in FEATURES if f != "selling_price"]


@query(
    "rank_features",
    indicators_sql(PRICES_LINEITEM)
    + f"""SELECT series, feature, {sql_round("importance", 6, "importance")} FROM (
        {" UNION ALL ".join(f"SELECT series, '{f}' AS feature, abs(corr({f}, selling_price)) AS importance FROM features GROUP BY series" for f in _MEASURED)})""",
)
def _rank_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features by the strength of their correlation with the price."""
    features = add_indicators(prices_lineitem(spark, folder), KEY, blocks=None)
    strength = features.groupBy("series").agg(
        F.array(
            *[
                F.struct(F.lit(f).alias("feature"), F.abs(correlation(F.col(f), F.col("selling_price"))).alias("importance"))
                for f in _MEASURED
            ]
        ).alias("_s")
    )
    return rounded(rank_features(strength.select("series", F.inline("_s")), KEY), {6: ["importance"]})


@query("residual_table", f"SELECT model, series, ts, y_pred, y_true - y_pred AS residual FROM ({PREDICTIONS_EVENTS}) WHERE model = 'naive'")
def _residuals(spark: SparkSession, folder: str) -> DataFrame:
    return residual_table(naive_forecast(ticks_events(spark, folder), KEY, blocks=BLOCK), GROUP)


def _histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""WITH v AS (SELECT series, {column} AS v FROM ({source})),
        s AS (SELECT series, min(v) AS lo, max(v) AS hi FROM v GROUP BY series),
        c AS (SELECT series, least(CAST(floor((v - lo) * {bins} / (hi - lo)) AS INTEGER), {bins - 1}) AS bin, count(*) AS n
              FROM v JOIN s USING (series) GROUP BY ALL),
        f AS (SELECT series, lo, hi, CAST(b AS INTEGER) AS bin FROM s CROSS JOIN range({bins}) r(b))
        SELECT series, bin, {sql_round(f"lo + bin * ((hi - lo) / {bins})", 6, "lower")},
               {sql_round(f"CASE WHEN bin = {bins - 1} THEN hi ELSE lo + (bin + 1) * ((hi - lo) / {bins}) END", 6, "upper")},
               coalesce(n, 0) AS n FROM f LEFT JOIN c USING (series, bin)"""


@query("price_histogram", _histogram_sql("SELECT l_returnflag AS series, l_extendedprice AS p FROM lineitem", "p", 50))
def _price_histogram(spark: SparkSession, folder: str) -> DataFrame:
    prices = spark.read.parquet(f"{folder}/lineitem.parquet").select(F.col("l_returnflag").alias("series"), "l_extendedprice")
    return rounded(histogram(prices, "l_extendedprice", 50, KEY), {6: ["lower", "upper"]})


@query("residual_histogram", _histogram_sql(f"SELECT series, y_true - y_pred AS e FROM ({PREDICTIONS_EVENTS}) WHERE model = 'naive'", "e", 30))
def _residual_histogram(spark: SparkSession, folder: str) -> DataFrame:
    rows = residual_table(naive_forecast(ticks_events(spark, folder), KEY, blocks=BLOCK), GROUP)
    return rounded(histogram(rows, "residual", 30, KEY), {6: ["lower", "upper"]})


def _polynomial(coefficients: tuple[float, ...], x: str) -> str:
    text = f"CAST({coefficients[-1]!r} AS DOUBLE)"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + CAST({c!r} AS DOUBLE))"
    return text


_QUANTILE = f"""positions AS (SELECT *, CASE WHEN i = n THEN pow(CAST(0.5 AS DOUBLE), CAST(1 AS DOUBLE) / n) WHEN i = 1 THEN 1 - pow(CAST(0.5 AS DOUBLE), CAST(1 AS DOUBLE) / n)
   ELSE (i - CAST(0.3175 AS DOUBLE)) / (n + CAST(0.365 AS DOUBLE)) END AS p FROM ranked),
 arguments AS (SELECT *, p - 0.5 AS q, CAST(0.180625 AS DOUBLE) - (p - 0.5) * (p - 0.5) AS c, sqrt(-ln(CASE WHEN p < 0.5 THEN p ELSE 1 - p END)) AS r FROM positions),
 pieces AS (SELECT *, q * {_polynomial(CENTRE_NUM, "c")} / {_polynomial(CENTRE_DEN, "c")} AS centre,
   CASE WHEN r <= 5 THEN {_polynomial(MIDDLE_NUM, "(r - 1.6)")} / {_polynomial(MIDDLE_DEN, "(r - 1.6)")}
        ELSE {_polynomial(TAIL_NUM, "(r - 5)")} / {_polynomial(TAIL_DEN, "(r - 5)")} END AS outside FROM arguments),
 points AS (SELECT series, i AS rank, v AS ordered, CASE WHEN abs(q) <= 0.425 THEN centre WHEN q < 0 THEN -outside ELSE outside END AS theoretical FROM pieces)"""


def _qq_sql(source: str) -> str:
    return f"""WITH ranked AS (SELECT series, v, row_number() OVER (PARTITION BY series ORDER BY v) AS i, count(*) OVER (PARTITION BY series) AS n
          FROM (SELECT series, y_true - y_pred AS v FROM ({source}) WHERE model = 'naive')), {_QUANTILE}"""


@query("qq_points", _qq_sql(PREDICTIONS_EVENTS) + f"SELECT {rounding({6: ['theoretical']}, ['series', 'rank', 'theoretical', 'ordered'])} FROM points")
def _qq(spark: SparkSession, folder: str) -> DataFrame:
    rows = residual_table(naive_forecast(ticks_events(spark, folder), KEY, blocks=BLOCK), GROUP)
    return rounded(qq_points(rows, "residual", KEY, BLOCK), {6: ["theoretical"]})


@query(
    "qq_fit",
    _qq_sql(PREDICTIONS_LINEITEM)
    + f"""SELECT series, {sql_round("regr_slope(ordered, theoretical)", 4, "slope")}, {sql_round("regr_intercept(ordered, theoretical)", 4, "intercept")},
          {sql_round("corr(ordered, theoretical)", 6, "r")} FROM points GROUP BY series""",
)
def _qq_fit(spark: SparkSession, folder: str) -> DataFrame:
    rows = residual_table(naive_forecast(prices_lineitem(spark, folder), KEY, blocks=None), GROUP)
    return rounded(qq_fit(qq_points(rows, "residual", KEY, None), KEY), {4: ["slope", "intercept"], 6: ["r"]})


@query("plot_r2", f"SELECT model, series, {sql_round('pow(corr(y_true, y_pred), 2)', 6, 'plot_r2')} FROM ({PREDICTIONS_EVENTS}) GROUP BY model, series")
def _plot_r2(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(plot_r2(_tick_predictions(spark, folder), GROUP), {6: ["plot_r2"]})


@query("evaluate_blocks", _metrics_sql(_CALM, _EVERY, f"{_REGRESSION}, {_DIAGNOSTICS}, {_TRADING}", "curve", ", " + _curve()))
def _evaluate_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """All families over long tick series, in blocks with carries."""
    return rounded(evaluate_wide(_calm(spark, folder), blocks=BLOCK), _shown(_EVERY))
