"""From raw price rows to scaled features, sequences and predictions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.blocks import BLOCK_ROWS, Blocks, plan_blocks
from tidemark.operators.cleaning import dedupe_first, fill_missing, iqr_filter, positive_prices
from tidemark.operators.features import INDICATOR_HALO, add_indicators
from tidemark.functions.numeric import key_join
from tidemark.functions.recurrent import EncoderSpec
from tidemark.operators.forecasting import (
    ENCODE_BLOCK_ROWS,
    Forecaster,
    encode_series,
    fit_forecaster,
    forecast,
    predict,
)
from tidemark.operators.scaling import apply_scaler, fit_scaler
from tidemark.operators.sequences import chronological_split, latest_window
from tidemark.schemas import FEATURES
from tidemark.session import stored


@dataclass
class Prepared:
    clean: DataFrame
    features: DataFrame
    scaler: DataFrame
    scaled: DataFrame


def clean_prices(
    prices: DataFrame, keys: Sequence[str], ts: str = "ts", arrival: Sequence[str] = (), method: str = "exact"
) -> DataFrame:
    """First copy per timestamp, positive prices, quartile filter on both prices.

    The de-duplicated table is written once, because the filter reads it several times.
    """
    first = dedupe_first(prices, keys, ts, arrival) if arrival else prices
    first = first.select(*keys, ts, "selling_price", "buying_price", "spread")
    return iqr_filter(stored(positive_prices(first)), keys, method=method)


def prepare(
    prices: DataFrame, keys: Sequence[str], ts: str = "ts", arrival: Sequence[str] = (), method: str = "exact",
    fill: str = "ffill_bfill", block_rows: int | None = BLOCK_ROWS, scale: str = "mixed", fit_on: str = "all",
) -> Prepared:
    """Clean, add indicators, fill gaps, fit and apply scalers.

    `scale` is the scaler's method; `fit_on="train"` fits it on the oldest part only.

    The clean and the filled table are stored, because two later passes read each; the
    blocks are found once, on the clean table.
    """
    clean = stored(clean_prices(prices, keys, ts, arrival, method))
    blocks = None if block_rows is None else plan_blocks(clean, keys, ts, INDICATOR_HALO, block_rows)
    indicators = add_indicators(clean, keys, ts, blocks=blocks)
    features = stored(fill_missing(indicators, keys, ts, FEATURES, fill, blocks))
    rows = chronological_split(features, keys, ts, blocks=blocks) if fit_on == "train" else features
    scaler = stored(fit_scaler(rows, keys, method=scale, fit_on=fit_on), "scaler")
    return Prepared(clean, features, scaler, apply_scaler(features, scaler))


def prepare_recent(
    prices: DataFrame, keys: Sequence[str], scaler: DataFrame, features: Sequence[str] = FEATURES, length: int = 60,
    ts: str = "ts", fill: str = "ffill_bfill", blocks: Blocks = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """((keys, last_ts, x) for a fitted forecaster, (keys, reason) of series that have none).

    New prices get indicators, filled gaps and the scalers stored at fitting time; no
    scaler is fitted. A series that the scalers do not know, or with too few rows, is rejected.
    """
    indicators = add_indicators(prices, keys, ts, blocks=blocks)
    filled = stored(fill_missing(indicators, keys, ts, list(features), fill, blocks), "recent")
    known = scaler.select(*keys).distinct() if keys else None
    unknown = key_join(filled.select(*keys).distinct(), known, keys, "left_anti") if keys else filled.limit(0).select(*keys)
    usable = key_join(filled, known, keys, "left_semi") if keys else filled
    windows, short = latest_window(apply_scaler(usable, scaler, list(features)), keys, ts, features, length)
    rejects = unknown.withColumn("reason", F.lit("unknown_series")).unionByName(
        short.select(*keys, F.lit("too_few_rows").alias("reason"))
    )
    return windows, rejects


def predict_recent(prices: DataFrame, keys: Sequence[str], forecaster: Forecaster, horizon: int = 30, **options: object) -> tuple[DataFrame, DataFrame]:
    """(forecast of each usable series, rejects) for new prices under a loaded forecaster."""
    windows, rejects = prepare_recent(prices, keys, forecaster.scaler, forecaster.features, forecaster.length, **options)
    return forecast(windows, forecaster, keys, horizon), rejects


@dataclass
class Fitted:
    forecaster: Forecaster
    encoded: DataFrame
    predictions: DataFrame


def fit_and_predict(
    prepared: Prepared, keys: Sequence[str], spec: EncoderSpec = EncoderSpec(), length: int = 60, reg: float = 1e-4,
    blocks: Blocks = ENCODE_BLOCK_ROWS,
) -> Fitted:
    """Encode every sequence, fit on the oldest part of each series, predict the newest part.

    The split is taken on the narrow encoded table, one row per sequence.
    """
    encoded = stored(encode_series(prepared.scaled, keys, "ts", spec, length=length, blocks=blocks))
    split = chronological_split(encoded, keys, blocks=blocks)
    scaler = stored(prepared.scaler)
    forecaster = fit_forecaster(split.filter(F.col("split") != "test"), spec, scaler, reg, length=length)
    return Fitted(forecaster, split, predict(split.filter(F.col("split") == "test"), forecaster, keys))
