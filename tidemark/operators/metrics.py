"""Forecast metrics: one ordered pass for previous values, one aggregation per group."""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.equity import equity_before
from tidemark.functions.numeric import correlation, inf, key_join, ratio
from tidemark.operators.blocks import BLOCK, BLOCK_ROWS, HALO, START, Blocks, assign_blocks
from tidemark.schemas import DIAGNOSTIC_METRICS, REGRESSION_METRICS, TRADING_METRICS
from tidemark.session import stored

GROUP = ("model", "series")
CAPITAL = 10_000.0
TRADING_DAYS = 252

_CATEGORY = {
    **dict.fromkeys(REGRESSION_METRICS, "regression_metrics"),
    **dict.fromkeys(DIAGNOSTIC_METRICS, "time_series_metrics"),
    **dict.fromkeys(TRADING_METRICS, "trading_metrics"),
}


def _error() -> Column:
    return F.col("y_true") - F.col("y_pred")


def _previous(df: DataFrame, group: Sequence[str], ts: str, blocks: Blocks) -> DataFrame:
    """Rows with the previous truth and prediction of their group, tagged with their block."""
    by = [*group, BLOCK]
    blocked = assign_blocks(df.select(*group, ts, "y_true", "y_pred"), group, ts, 1, blocks)
    w = Window.partitionBy(*by).orderBy(ts)
    seen = blocked.withColumns({"_y1": F.lag("y_true").over(w), "_p1": F.lag("y_pred").over(w)})
    return seen.filter(~F.col(HALO)).drop(HALO, START)


def _direction() -> tuple[Column, Column]:
    """Did truth and forecast rise since the previous row? NULL on the first row."""
    return F.col("y_true") > F.col("_y1"), F.col("y_pred") > F.col("_p1")


def _regression() -> dict[str, Column]:
    e, y, p = _error(), F.col("y_true"), F.col("y_pred")
    n, mae, mse = F.count(e), F.avg(F.abs(e)), F.avg(e * e)
    spread = F.var_pop(y) * n
    size = (F.abs(y) + F.abs(p)) / 2
    naive = F.avg(F.abs(y - F.col("_y1")))
    up, forecast_up = _direction()
    constant = F.when(F.sum(e * e) == 0, 1.0).otherwise(0.0)
    return {
        "mae": mae,
        "mse": mse,
        "rmse": F.sqrt(mse),
        "mape": F.coalesce(F.avg(F.abs(ratio(e, y))) * 100, inf()),
        "smape": F.coalesce(F.avg(ratio(F.abs(e), size)) * 100, F.lit(0.0)),
        "mase": F.coalesce(ratio(mae, naive), inf()),
        "r2": F.when(n < 2, None).when(spread == 0, constant).otherwise(1 - ratio(F.sum(e * e), spread)),
        "explained_variance": 1 - ratio(F.var_pop(e), F.var_pop(y)),
        "max_error": F.max(F.abs(e)),
        "directional_accuracy": F.coalesce(F.avg((up == forecast_up).cast("int")) * 100, F.lit(0.0)),
    }


def _diagnostics() -> dict[str, Column]:
    e = _error()
    y1, e1 = F.col("_y1"), F.col("_y1") - F.col("_p1")
    naive = F.avg(F.pow(F.col("y_true") - y1, F.lit(2)))
    model = F.avg(F.when(y1.isNotNull(), e * e))
    return {
        "theil_u": F.coalesce(ratio(F.sqrt(model), F.sqrt(naive)), inf()),
        "residual_autocorr": F.coalesce(correlation(e1, e), F.lit(0.0)),
        "forecast_bias": F.avg(-e),
        "tracking_signal": F.coalesce(ratio(F.sum(e), F.avg(F.abs(e)) * F.count(e)), F.lit(0.0)),
        "mean_residual": F.avg(e),
        "std_residual": F.stddev_pop(e),
    }


def strategy_returns(
    df: DataFrame, group: Sequence[str] = GROUP, ts: str = "ts", cost: float = 0.0, blocks: Blocks = BLOCK_ROWS
) -> DataFrame:
    """(group, ts, position, strategy_return) from the second row of each group on.

    `cost` is charged on entry and whenever the position flips.
    """
    return _strategy_rows(df, group, ts, cost, blocks).filter(F.col("position").isNotNull()).select(
        *group, ts, "position", "strategy_return"
    )


def _strategy_rows(df: DataFrame, group: Sequence[str], ts: str, cost: float, blocks: Blocks) -> DataFrame:
    """All rows with previous values, position, strategy return and block."""
    w = Window.partitionBy(*group, BLOCK).orderBy(ts)
    # Two rows back: a flip is seen against the previous position, which itself
    # looks one row back.
    blocked = assign_blocks(df.select(*group, ts, "y_true", "y_pred"), group, ts, 2, blocks)
    rows = blocked.withColumns({"_y1": F.lag("y_true").over(w), "_p1": F.lag("y_pred").over(w)})
    _, long = _direction()
    position = F.when(F.col("_y1").isNotNull(), F.when(long, 1).otherwise(-1))
    gain = ratio(F.col("y_true") - F.col("_y1"), F.col("_y1"))
    rows = rows.withColumn("position", position)
    result = gain * F.col("position")
    if cost:
        flipped = F.coalesce(F.lag("position").over(w), F.lit(0)) != F.col("position")
        result = result - F.when(flipped, F.lit(float(cost))).otherwise(0.0)
    return rows.withColumn("strategy_return", result).filter(~F.col(HALO)).drop(HALO, START)


def _with_equity(rows: DataFrame, group: Sequence[str], ts: str, blocks: Blocks) -> DataFrame:
    """Add cumulative_return (running product), running_max and drawdown.

    In blocks the ordered pass runs once and is stored: it leaves each row's product since the
    block's start and the highest and lowest product so far. Summaries of the blocks are
    composed over the one-row-per-block table; a row then needs only what its block was
    handed, so the second pass neither shuffles nor sorts.
    """
    by = [*group, BLOCK]
    so_far = Window.partitionBy(*by).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    growth = F.when(F.col("strategy_return").isNotNull(), 1 + F.col("strategy_return"))
    rows = rows.withColumn("cumulative_return", F.product(growth).over(so_far))
    rows = rows.withColumn("running_max", F.max("cumulative_return").over(so_far))
    if blocks is not None:
        rows = stored(rows.withColumn("_low", F.min("cumulative_return").over(so_far)), "equity")
        # Levels scale with the product before the block, and swap ends if it is negative.
        ends = rows.groupBy(*by).agg(
            F.max_by("cumulative_return", F.when(F.col("cumulative_return").isNotNull(), F.col(ts))).alias("_total"),
            F.max("cumulative_return").alias("_most"),
            F.min("cumulative_return").alias("_least"),
        )
        fields = [T.StructField(c, T.DoubleType()) for c in ("_scale", "_peak_before")]
        handed = T.StructType([*[rows.schema[c] for c in by], *fields])
        carry = ends.groupBy(*group).applyInArrow(equity_before(BLOCK), handed)
        top = F.col("_scale") * F.when(F.col("_scale") >= 0, F.col("running_max")).otherwise(F.col("_low"))
        rows = key_join(rows, stored(carry, "carries"), group, exact=[BLOCK]).withColumns(
            {"cumulative_return": F.col("cumulative_return") * F.col("_scale"), "running_max": F.greatest(top, F.col("_peak_before"))}
        )
    drawdown = ratio(F.col("cumulative_return") - F.col("running_max"), F.col("running_max"))
    return rows.withColumn("drawdown", drawdown)


def equity_curve(
    df: DataFrame, group: Sequence[str] = GROUP, ts: str = "ts", cost: float = 0.0, blocks: Blocks = BLOCK_ROWS
) -> DataFrame:
    """(group, ts, strategy_return, cumulative_return, running_max, drawdown)."""
    rows = _with_equity(_strategy_rows(df, group, ts, cost, blocks), group, ts, blocks)
    return rows.filter(F.col("position").isNotNull()).select(
        *group, ts, "strategy_return", "cumulative_return", "running_max", "drawdown"
    )


def _trading(ts: str, capital: float) -> dict[str, Column]:
    s = F.col("strategy_return")
    total = F.product(1 + s) - 1
    first, last = F.min_by("y_true", ts), F.max_by("y_true", ts)
    hold = ratio(last - first, first)
    gains = F.coalesce(F.sum(F.when(s > 0, s)), F.lit(0.0))
    losses = F.abs(F.coalesce(F.sum(F.when(s < 0, s)), F.lit(0.0)))
    worst = F.min("drawdown")
    return {
        "strategy_return": total * 100,
        "buy_hold_return": hold * 100,
        "excess_return": (total - hold) * 100,
        "sharpe_ratio": F.coalesce(ratio(F.lit(sqrt(TRADING_DAYS)) * F.avg(s), F.stddev_pop(s)), F.lit(0.0)),
        "max_drawdown": worst * 100,
        "win_rate": F.avg((s > 0).cast("int")) * 100,
        "profit_factor": F.when(losses > 0, ratio(gains, losses)).when(gains > 0, inf()).otherwise(0.0),
        "calmar_ratio": F.when(worst != 0, ratio(total, F.abs(worst))).when(total > 0, inf()).otherwise(0.0),
        "final_portfolio_value": F.lit(capital) * (1 + total),
    }


def _named(columns: dict[str, Column], names: Sequence[str]) -> list[Column]:
    return [columns[n].alias(n) for n in names]


def regression_metrics(
    df: DataFrame, group: Sequence[str] = GROUP, ts: str = "ts", blocks: Blocks = BLOCK_ROWS
) -> DataFrame:
    rows = _previous(df, group, ts, blocks)
    return rows.groupBy(*group).agg(*_named(_regression(), REGRESSION_METRICS))


def forecast_diagnostics(
    df: DataFrame, group: Sequence[str] = GROUP, ts: str = "ts", blocks: Blocks = BLOCK_ROWS
) -> DataFrame:
    rows = _previous(df, group, ts, blocks)
    return rows.groupBy(*group).agg(*_named(_diagnostics(), DIAGNOSTIC_METRICS))


def trading_metrics(
    df: DataFrame, group: Sequence[str] = GROUP, ts: str = "ts", initial: float = CAPITAL, cost: float = 0.0,
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """Back-test of the forecast's direction; groups with fewer than two rows give no row."""
    rows = _with_equity(_strategy_rows(df, group, ts, cost, blocks), group, ts, blocks)
    found = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), *_named(_trading(ts, initial), TRADING_METRICS))
    return found.filter(F.col("_n") > 1).drop("_n")


def trend_accuracy(
    df: DataFrame, group: Sequence[str] = GROUP, ts: str = "ts", blocks: Blocks = BLOCK_ROWS
) -> DataFrame:
    """Share of rises forecast as rises, and of falls forecast as no rise, in percent."""
    up, forecast_up = _direction()
    down = F.col("y_true") < F.col("_y1")
    return _previous(df, group, ts, blocks).groupBy(*group).agg(
        (F.avg(F.when(up, forecast_up.cast("int"))) * 100).alias("uptrend_accuracy"),
        (F.avg(F.when(down, (~forecast_up).cast("int"))) * 100).alias("downtrend_accuracy"),
    )


def evaluate_wide(
    df: DataFrame, group: Sequence[str] = GROUP, ts: str = "ts", include_trading: bool = True,
    initial: float = CAPITAL, cost: float = 0.0, blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """All metric families in one row per group, from one ordered pass and one aggregation."""
    if include_trading:
        rows = _with_equity(_strategy_rows(df, group, ts, cost, blocks), group, ts, blocks)
    else:
        rows = _previous(df, group, ts, blocks)
    wanted = _named(_regression(), REGRESSION_METRICS) + _named(_diagnostics(), DIAGNOSTIC_METRICS)
    if include_trading:
        wanted += [
            F.when(F.count(F.lit(1)) > 1, c).alias(n)
            for n, c in _trading(ts, initial).items()
        ]
    return rows.groupBy(*group).agg(*wanted)


def to_long(wide: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group, category, metric, value); metrics without a value are left out."""
    names = [c for c in wide.columns if c in _CATEGORY]
    entries = F.array(
        *[
            F.struct(F.lit(_CATEGORY[n]).alias("category"), F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
            for n in names
        ]
    )
    return wide.select(*group, F.inline(entries)).filter(F.col("value").isNotNull())


def evaluate(
    df: DataFrame, group: Sequence[str] = GROUP, ts: str = "ts", include_trading: bool = True,
    initial: float = CAPITAL, cost: float = 0.0, blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """(group, category, metric, value) for all metric families."""
    return to_long(evaluate_wide(df, group, ts, include_trading, initial, cost, blocks), group)


def compare_models(
    df: DataFrame, keys: Sequence[str] = ("series",), ts: str = "ts", blocks: Blocks = BLOCK_ROWS
) -> DataFrame:
    """Regression metrics per model (and key) as one row each."""
    return regression_metrics(df, ("model", *keys), ts, blocks)


def returns_to_date(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", column: str = "selling_price",
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """Holding the series itself: `return`, `cumulative_return`, `running_max`, `drawdown` per row."""
    w = Window.partitionBy(*keys, BLOCK).orderBy(ts)
    blocked = assign_blocks(df.select(*keys, ts, column), keys, ts, 1, blocks)
    before = F.lag(column).over(w)
    rows = blocked.withColumn("strategy_return", ratio(F.col(column) - before, before))
    rows = _with_equity(rows.filter(~F.col(HALO)).drop(HALO, START), keys, ts, blocks)
    return rows.filter(F.col("strategy_return").isNotNull()).select(
        *keys, ts, F.col("strategy_return").alias("return"), "cumulative_return", "running_max", "drawdown"
    )
