"""Technical indicators over one shared window per series."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.affine import Averages, across_blocks, along_blocks
from tidemark.functions.numeric import key_join, ratio
from tidemark.functions.rolling import diff, pct_change, rolling_mean, rolling_std
from tidemark.operators.blocks import BLOCK, BLOCK_ROWS, HALO, START, Blocks, assign_blocks, in_blocks
from tidemark.schemas import FEATURES
from tidemark.session import stored

LAGS = (1, 3, 7)
INDICATOR_HALO = 20


def series_window(keys: Sequence[str], ts: str = "ts") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(ts)


def lags(column: str, w: WindowSpec, steps: Sequence[int], prefix: str) -> dict[str, Column]:
    return {f"{prefix}_lag_{k}": F.lag(column, k).over(w) for k in steps}


def moving_averages(
    df: DataFrame, keys: Sequence[str], ts: str, column: str, periods: Sequence[int] = (10, 20, 50),
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """`sma_<n>` for each period."""

    def run(part: DataFrame, by: list[str]) -> DataFrame:
        w = series_window(by, ts)
        return part.withColumns({f"sma_{n}": rolling_mean(F.col(column), w, n) for n in periods})

    return in_blocks(df, run, keys, ts, max(periods), blocks)


def price_changes(
    df: DataFrame, keys: Sequence[str], ts: str, column: str, steps: Sequence[int] = (1, 5, 10, 20),
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """`change_<k>` = relative change over k rows."""

    def run(part: DataFrame, by: list[str]) -> DataFrame:
        w = series_window(by, ts)
        return part.withColumns({f"change_{k}": pct_change(F.col(column), w, k) for k in steps})

    return in_blocks(df, run, keys, ts, max(steps), blocks)


def lag_features(
    df: DataFrame, keys: Sequence[str], ts: str, column: str, steps: Sequence[int] = (1, 2, 3, 5, 10),
    prefix: str | None = None, blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    def run(part: DataFrame, by: list[str]) -> DataFrame:
        return part.withColumns(lags(column, series_window(by, ts), steps, prefix or column))

    return in_blocks(df, run, keys, ts, max(steps), blocks)


def _band_columns(mean: Column, std: Column, price: Column, k: float) -> dict[str, Column]:
    upper, lower = mean + std * k, mean - std * k
    return {"bb_upper": upper, "bb_lower": lower, "bb_position": ratio(price - lower, upper - lower)}


def bollinger(
    df: DataFrame, keys: Sequence[str], ts: str, column: str, n: int = 20, k: float = 2.0,
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """`bb_upper`, `bb_lower`, `bb_position`; the position is NULL on a flat window."""

    def run(part: DataFrame, by: list[str]) -> DataFrame:
        w = series_window(by, ts)
        price = F.col(column)
        part = part.withColumns({"_mean": rolling_mean(price, w, n), "_std": rolling_std(price, w, n)})
        return part.withColumns(_band_columns(F.col("_mean"), F.col("_std"), price, k)).drop("_mean", "_std")

    return in_blocks(df, run, keys, ts, n, blocks)


def _up_down(column: str, w: WindowSpec) -> dict[str, Column]:
    # greatest() skips NULL, so the first row of a series has no gain and no loss.
    change = diff(F.col(column), w)
    return {"_up": F.greatest(change, F.lit(0.0)), "_down": F.greatest(-change, F.lit(0.0))}


def _rsi(w: WindowSpec, n: int) -> Column:
    frame = w.rowsBetween(1 - n, 0)
    up, down = F.avg("_up").over(frame), F.avg("_down").over(frame)
    value = F.when(down > 0, 100 - 100 / (1 + ratio(up, down))).when(up > 0, F.lit(100.0))
    return F.when(F.count(F.lit(1)).over(frame) == n, value)


def rsi_sma(
    df: DataFrame, keys: Sequence[str], ts: str, column: str, n: int = 14, blocks: Blocks = BLOCK_ROWS
) -> DataFrame:
    """`rsi` from simple n-row means of gains and losses; NULL while both are zero."""

    def run(part: DataFrame, by: list[str]) -> DataFrame:
        w = series_window(by, ts)
        return part.withColumns(_up_down(column, w)).withColumn("rsi", _rsi(w, n)).drop("_up", "_down")

    return in_blocks(df, run, keys, ts, n, blocks)


def calendar_columns(ts: str = "ts") -> dict[str, Column]:
    day, month = F.weekday(ts), F.month(ts)
    return {
        "day_of_week": day,
        "month": month,
        "day_sin": F.sin(day * (2 * pi) / 7),
        "day_cos": F.cos(day * (2 * pi) / 7),
        "month_sin": F.sin(month * (2 * pi) / 12),
        "month_cos": F.cos(month * (2 * pi) / 12),
    }


def add_indicators(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    short: int = 10,
    volatility: int = 20,
    roc: int = 5,
    bands: int = 20,
    width: float = 2.0,
    rsi: int = 14,
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """Price table -> (other columns, ts, the 24 features in their fixed order).

    All windows share one partitioning and order: one shuffle and one sort.
    """

    def run(part: DataFrame, by: list[str]) -> DataFrame:
        w = series_window(by, ts)
        price = F.col("selling_price")
        first = {
            "ma_short": rolling_mean(price, w, short),
            "ma_long": rolling_mean(price, w, 2 * short),
            "volatility": rolling_std(price, w, volatility),
            "_before_roc": F.lag(price, roc).over(w),
        }
        # Means and deviations that are already there are not computed again.
        if bands != 2 * short:
            first["_band_mean"] = rolling_mean(price, w, bands)
        if bands != volatility:
            first["_band_std"] = rolling_std(price, w, bands)
        for k in LAGS:
            first[f"price_lag_{k}"] = F.lag("selling_price", k).over(w)
            first[f"spread_lag_{k}"] = F.lag("spread", k).over(w)
        first |= _up_down("selling_price", w)
        part = part.withColumns(first)
        mean = F.col("_band_mean" if bands != 2 * short else "ma_long")
        std = F.col("_band_std" if bands != volatility else "volatility")
        second = {
            "price_ma_ratio": ratio(price, F.col("ma_short")),
            "roc": ratio(price, F.col("_before_roc")) - 1,
            "rsi": _rsi(w, rsi),
            **_band_columns(mean, std, price, width),
            **calendar_columns(ts),
        }
        return part.withColumns(second).select(*others, ts, *FEATURES, *[c for c in ("_block", "_halo") if c in part.columns])

    others = [c for c in df.columns if c != ts and c not in FEATURES]
    return in_blocks(df, run, keys, ts, max(2 * short, volatility, roc, bands, rsi, *LAGS), blocks)


def _averaged(
    df: DataFrame, averages: Averages, names: Sequence[str], keys: Sequence[str], ts: str, column: str, blocks: Blocks
) -> DataFrame:
    """Add the averages' states as `names`; a NULL moves nothing and gets NULL.

    Every block is computed on its own, in one sorted pass, from a state of zero. The blocks'
    ends are composed over the one-row-per-block table, and each row adds what its block was
    handed, decayed by the number of values since.
    """
    keys, names = list(keys), list(names)
    doubles = [T.StructField(c, T.DoubleType()) for c in names]
    blocked = assign_blocks(df, keys, ts, 0, blocks).drop(HALO, START)
    schema = T.StructType([*blocked.schema, T.StructField("_known", T.LongType()), *doubles])
    local = blocked.groupBy(*keys, BLOCK).applyInArrow(along_blocks(averages, ts, column, BLOCK, names, blocks is None), schema)
    if blocks is None:
        return local.drop(BLOCK, "_known")
    local = stored(local, "averages")
    ends, before = ([f"_{word}{i}" for i in range(len(names))] for word in ("end", "before"))
    per_block = local.groupBy(*keys, BLOCK).agg(
        F.max("_known").alias("_n"),
        F.min_by(F.col(column).cast("double"), "_known").alias("_first"),
        *[F.max_by(c, "_known").alias(e) for c, e in zip(names, ends)],
    )
    handed = T.StructType([*[local.schema[c] for c in (*keys, BLOCK)], *[T.StructField(c, T.DoubleType()) for c in before]])
    carries = per_block.groupBy(*keys).applyInArrow(across_blocks(averages, BLOCK, ends, before), handed)
    met = key_join(local, stored(carries, "carries"), keys, exact=[BLOCK])
    keeps, n = averages.keeps, F.col("_known")
    decayed = [F.pow(F.lit(k), n) for k in keeps]
    brought = [F.col(b) * d for b, d in zip(before, decayed)]
    if averages.signal is not None:
        last = keeps[-1]
        for i, sign in ((0, 1.0), (1, -1.0)):
            # The sum of last**(n - m) * keep**m over m = 1 ... n.
            passed = n * decayed[i] if keeps[i] == last else (decayed[i] - decayed[-1]) * (keeps[i] / (keeps[i] - last))
            brought[-1] = brought[-1] + F.col(before[i]) * passed * (sign * (1.0 - last))
    return met.withColumns({c: F.col(c) + b for c, b in zip(names, brought)}).select(*df.columns, *names)


def ema(
    df: DataFrame, keys: Sequence[str], ts: str, column: str, periods: Sequence[int] = (12, 26),
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """`ema_<n>` for each period: e = a*x + (1-a)*e with a = 2/(n+1), starting at the first value; a NULL moves nothing and gets NULL."""
    return _averaged(df, Averages(tuple(periods)), [f"ema_{n}" for n in periods], keys, ts, column, blocks)


def macd(
    df: DataFrame, keys: Sequence[str], ts: str, column: str, fast: int = 12, slow: int = 26, signal: int = 9,
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """`macd`, `macd_signal`, `macd_histogram`."""
    made = _averaged(df, Averages((fast, slow), signal), ["_fast", "_slow", "macd_signal"], keys, ts, column, blocks)
    made = made.withColumn("macd", F.col("_fast") - F.col("_slow"))
    return made.select(*df.columns, "macd", "macd_signal", (F.col("macd") - F.col("macd_signal")).alias("macd_histogram"))


def with_lookback(df: DataFrame, keys: Sequence[str], ts: str, since: str, rows: int = INDICATOR_HALO) -> DataFrame:
    """Rows from `since` on and each series' last `rows` rows before: all a recent slice looks at.

    The recent part is a plain comparison, which reaches the Parquet scan; of the rest, no
    more than `rows` rows per series and task pass the rank limit.
    """
    start = F.lit(since).cast(df.schema[ts].dataType)
    newest = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    before = df.filter(F.col(ts) < start).withColumn("_back", F.row_number().over(newest))
    return df.filter(F.col(ts) >= start).unionByName(before.filter(F.col("_back") <= rows).drop("_back"))
