"""Pairing actual and predicted values by key and time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rolling import rolling_mean
from tidemark.operators.blocks import BLOCK_ROWS, Blocks, in_blocks
from tidemark.operators.features import series_window


def align_predictions(
    actual: DataFrame, predicted: DataFrame, keys: Sequence[str], ts: str = "ts",
    actual_column: str = "y_true", predicted_column: str = "y_pred",
) -> DataFrame:
    """Inner join on (keys, ts); with the timestamp in the key a hot series spreads over all tasks."""
    on = [*keys, ts]
    left = actual.select(*on, F.col(actual_column).alias("y_true"))
    extra = [c for c in predicted.columns if c not in on and c != predicted_column]
    right = predicted.select(*on, *extra, F.col(predicted_column).alias("y_pred"))
    return left.join(right, on).select(*extra, *on, "y_true", "y_pred")


def attach_dates(
    predictions: DataFrame, prices: DataFrame, keys: Sequence[str], ts: str = "ts", columns: Sequence[str] = ("spread",)
) -> DataFrame:
    """Price-table columns for each prediction, found by (keys, ts)."""
    on = [*keys, ts]
    return predictions.join(prices.select(*on, *columns), on, "left")


def merge_metrics(tables: Sequence[DataFrame], group: Sequence[str]) -> DataFrame:
    """One row per group with the columns of all tables; a group missing from one keeps NULLs."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.join(table, list(group), "full")
    return merged


def naive_forecast(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", column: str = "selling_price",
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """(model='naive', keys, ts, y_true, y_pred): the previous value as prediction."""

    def run(part: DataFrame, by: list[str]) -> DataFrame:
        return part.withColumn("y_pred", F.lag(column, 1).over(series_window(by, ts)))

    return _predictions(in_blocks(df, run, keys, ts, 1, blocks), "naive", keys, ts, column)


def trailing_mean_forecast(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", column: str = "selling_price", n: int = 10,
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """(model='ma<n>', ...): the mean of the n rows before as prediction."""

    def run(part: DataFrame, by: list[str]) -> DataFrame:
        w = series_window(by, ts)
        part = part.withColumn("_mean", rolling_mean(F.col(column), w, n))
        return part.withColumn("y_pred", F.lag("_mean", 1).over(w)).drop("_mean")

    return _predictions(in_blocks(df, run, keys, ts, n + 1, blocks), f"ma{n}", keys, ts, column)


def _predictions(df: DataFrame, model: str, keys: Sequence[str], ts: str, column: str) -> DataFrame:
    rows = df.select(F.lit(model).alias("model"), *keys, ts, F.col(column).alias("y_true"), "y_pred")
    return rows.filter(F.col("y_pred").isNotNull() & F.col("y_true").isNotNull())
