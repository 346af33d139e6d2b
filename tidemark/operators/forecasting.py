"""Sequence forecaster: fixed random recurrent features and a linear readout.

The encoder's weights are never fitted, so encoding is independent work per row
and the fit is a linear regression, solved by MLlib from a distributed Gramian.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import recurrent
from tidemark.functions.recurrent import BATCH, EncoderSpec, encode_driven, encode_windows, layer_weights
from tidemark.functions.numeric import attach, key_join, ratio
from tidemark.operators.blocks import BLOCK, HALO, START, Blocks, assign_blocks
from tidemark.operators.metrics import regression_metrics
from tidemark.operators.scaling import inverse_price
from tidemark.schemas import FEATURES
from tidemark.session import stored

ENCODE_BLOCK_ROWS = 20_000

# The functions that run in Python workers travel with the job, so executors need
# NumPy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(recurrent)


@dataclass
class Forecaster:
    """What is needed to predict; `scaler` is None when prices were not scaled."""

    readout: LinearRegressionModel | Readout
    spec: EncoderSpec
    scaler: DataFrame | None = None
    features: tuple[str, ...] = FEATURES
    length: int = 60
    name: str = "lstm"
    fitted_at: str = field(default_factory=lambda: datetime.now(timezone.utc).isoformat())


def encode_sequences(df: DataFrame, spec: EncoderSpec, n_features: int = len(FEATURES)) -> DataFrame:
    """Replace the flat sequence `x` by its encoding `h`."""
    others = [c for c in df.columns if c != "x"]
    schema = T.StructType([df.schema[c] for c in others] + [T.StructField("h", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[others].copy()
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                out["h"] = list(encode_windows(x.reshape(len(x), -1, n_features), spec))
            else:
                out["h"] = []
            yield out

    return df.mapInPandas(run, schema)


def encode_series(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    spec: EncoderSpec = EncoderSpec(),
    features: Sequence[str] = FEATURES,
    target: str = "selling_price",
    length: int = 60,
    blocks: Blocks = ENCODE_BLOCK_ROWS,
) -> DataFrame:
    """(keys, target_ts, y, h) straight from the scaled feature table.

    Same result as `make_sequences` followed by `encode_sequences`, but the windows slide
    inside NumPy over one block at a time, so no row is copied `length` times and
    a task holds one block, whatever the series' length.
    """
    keys, features = list(keys), list(features)
    rows = df.select(
        *keys, F.col(ts).alias("target_ts"), F.col(target).cast("double").alias("y"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("row"),
    )
    blocked = assign_blocks(rows, keys, "target_ts", length, blocks).drop(START)
    schema = T.StructType(
        [rows.schema[c] for c in (*keys, "target_ts", "y")] + [T.StructField("h", T.ArrayType(T.DoubleType()))]
    )

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("target_ts", kind="stable")
        own = ~block[HALO].to_numpy()
        own[:length] = False
        at = np.flatnonzero(own)
        out = block.iloc[at][[*keys, "target_ts", "y"]].copy()
        if not len(at):
            out["h"] = []
            return out
        layers = layer_weights(spec, len(features))
        drive = np.stack(block["row"].to_numpy()) @ layers[0][0]
        encoded = []
        for i in range(0, len(at), BATCH):
            # Row numbers of each window, oldest first: (length, batch).
            window = at[i : i + BATCH][None, :] - length + np.arange(length)[:, None]
            encoded.append(encode_driven(drive[window], layers))
        out["h"] = list(np.concatenate(encoded))
        return out

    return blocked.groupBy(*keys, BLOCK).applyInPandas(run, schema)


def fit_forecaster(
    encoded: DataFrame, spec: EncoderSpec, scaler: DataFrame | None = None, reg: float = 1e-4,
    features: Sequence[str] = FEATURES, length: int = 60, name: str = "lstm",
) -> Forecaster:
    """Least squares of `y` on `h` (ridge penalty `reg`)."""
    rows = encoded.select(array_to_vector("h").alias("features"), F.col("y").alias("label"))
    readout = LinearRegression(solver="normal", regParam=reg).fit(rows)
    return Forecaster(readout, spec, scaler, tuple(features), length, name)


def predict(encoded: DataFrame, forecaster: Forecaster, keys: Sequence[str]) -> DataFrame:
    """(model, keys, ts, y_true, y_pred) in price units."""
    scored = forecaster.readout.transform(encoded.withColumn("features", array_to_vector("h")))
    rows = scored.select(
        F.lit(forecaster.name).alias("model"), *keys, F.col("target_ts").alias("ts"),
        F.col("y").alias("y_true"), F.col("prediction").alias("y_pred"),
    )
    return inverse_price(rows, ["y_true", "y_pred"], forecaster.scaler)


def forecast(windows: DataFrame, forecaster: Forecaster, keys: Sequence[str], horizon: int = 30) -> DataFrame:
    """(keys, step, ts, y_pred): recursive forecast, one day per step.

    `windows` has one row per series (`latest_window`). Each prediction becomes
    the price of a new last row; its other features carry over from the row before.
    """
    keys = list(keys)
    spec, features = forecaster.spec, forecaster.features
    coefficients = np.asarray(forecaster.readout.coefficients.toArray())
    intercept = float(forecaster.readout.intercept)
    price = features.index("selling_price")
    schema = T.StructType(
        [windows.schema[k] for k in keys]
        + [windows.schema["last_ts"], T.StructField("step", T.IntegerType()), T.StructField("y_pred", T.DoubleType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layers = None
        for batch in batches:
            for i in range(0, len(batch), BATCH):
                part = batch.iloc[i : i + BATCH]
                x = np.stack(part["x"].to_numpy()).reshape(len(part), -1, len(features))
                layers = layers or layer_weights(spec, len(features))
                for step in range(1, horizon + 1):
                    y = encode_windows(x, spec, layers) @ coefficients + intercept
                    newest = x[:, -1:, :].copy()
                    newest[:, 0, price] = y
                    x = np.concatenate([x[:, 1:, :], newest], axis=1)
                    yield part[[*keys, "last_ts"]].assign(step=step, y_pred=y)

    steps = windows.select(*keys, "last_ts", "x").mapInPandas(run, schema)
    ahead = F.make_dt_interval(F.col("step"))
    rows = steps.select(*keys, "step", (F.col("last_ts") + ahead).alias("ts"), "y_pred")
    return inverse_price(rows, "y_pred", forecaster.scaler)


@dataclass(frozen=True)
class Trial:
    name: str
    spec: EncoderSpec
    reg: float = 1e-4


@dataclass
class Sweep:
    """`leaderboard`: one row per trial over all series; `by_series`: one per trial and series;
    `history`: the losses of each trial by growing share of its train rows."""

    leaderboard: DataFrame
    by_series: DataFrame
    history: DataFrame


SHARES = (0.25, 0.5, 0.75, 1.0)


def sweep(
    scaled: DataFrame, keys: Sequence[str], trials: Sequence[Trial], scaler: DataFrame | None = None,
    features: Sequence[str] = FEATURES, length: int = 60, blocks: Blocks = ENCODE_BLOCK_ROWS,
    shares: Sequence[float] = SHARES,
) -> Sweep:
    """Compare encoder and penalty settings, fitted on train and scored on val in price units.

    `scaled` carries `split` and `seq_no`. A trial is fitted on growing shares of each
    series' oldest train rows; the last fit is the one that is scored. Trials of one encoder
    share its encodings and one aggregate of their products (`gram_sums`); from those sums
    every share and penalty is a small solve, and its losses a small product. Pass a stored table.
    """
    boards, by_series, runs = [], [], []
    n_train = scaled.filter("split = 'train'").groupBy(*keys).agg(F.max("seq_no").alias("_last"))
    splits = attach(scaled.select(*keys, F.col("ts").alias("target_ts"), "split", "seq_no"), n_train, keys)
    share = F.try_divide(F.col("seq_no"), F.col("_last"))
    # The first share that holds a train row; validation rows are counted apart as 0.
    part = F.when(F.col("split") == "val", 0)
    for step, upto in enumerate(shares, 1):
        part = part.when((F.col("split") == "train") & (share <= upto), step)
    splits = splits.select(*keys, "target_ts", "split", part.alias("_part"))
    for spec in dict.fromkeys(t.spec for t in trials):
        encoded = encode_series(scaled, keys, "ts", spec, features, "selling_price", length, blocks)
        encoded = stored(key_join(encoded, splits, keys, exact=["target_ts"]), "encoded")
        sums = gram_sums(encoded.filter(F.col("_part").isNotNull()), "_part")
        grams = {r["_part"]: Gram.of(r["sums"]) for r in sums.collect()}
        for trial in (t for t in trials if t.spec == spec):
            train, readout = None, None
            for step in range(1, len(shares) + 1):
                own = grams.get(step)
                train = own if train is None else train if own is None else train + own
                readout = None if train is None else train.solve(trial.reg)
                losses = [None if g is None or readout is None else g.loss(readout) for g in (train, grams.get(0))]
                runs.append((trial.name, step, *losses, 0.0))
            if readout is None:
                raise ValueError("no train rows to fit on")
            fitted = Forecaster(readout, spec, scaler, tuple(features), length, trial.name)
            scored = stored(predict(encoded.filter(F.col("split") == "val"), fitted, keys), "scored")
            boards.append(pooled_scores(scored))
            by_series.append(regression_metrics(scored, ("model", *keys), "ts", blocks if keys else None))
    history = scaled.sparkSession.createDataFrame(runs, "run_id string, step int, train_loss double, val_loss double, learning_rate double")
    return Sweep(*[reduce(DataFrame.unionByName, tables) for tables in (boards, by_series)], history)


def gram_sums(encoded: DataFrame, by: str) -> DataFrame:
    """(by, sums): for each value of `by`, the products of (1, h, y) with themselves, summed over its rows, row by row.

    A task sums its batches in NumPy and hands on one array per value of `by`, which is to
    have few values; Spark adds these up.
    """
    schema = T.StructType([encoded.schema[by], T.StructField("sums", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            groups, y, h = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2)
            x = h.flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            z = np.column_stack([np.ones(len(y)), x, y])
            for group in dict.fromkeys(groups):
                own = z[[g == group for g in groups]]
                held[group] = held.get(group, 0.0) + own.T @ own
        if held:
            sums = pa.array([m.ravel().tolist() for m in held.values()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), batch.schema.types[0]), sums], [by, "sums"])

    partial = encoded.select(by, F.col("y").cast("double").alias("y"), "h").mapInArrow(run, schema)
    total = Summarizer.sum(array_to_vector("sums"))
    return partial.groupBy(by).agg(vector_to_array(total).alias("sums"))


@dataclass(frozen=True)
class Readout:
    """y = intercept + coefficients . h"""

    coefficients: DenseVector
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `prediction` for the vectors in `features`."""
        weights = F.array(*[F.lit(float(c)) for c in self.coefficients])
        products = F.zip_with(vector_to_array("features"), weights, lambda a, b: a * b)
        return df.withColumn("prediction", F.lit(float(self.intercept)) + F.aggregate(products, F.lit(0.0), lambda a, b: a + b))


@dataclass(frozen=True)
class Gram:
    """Products of (1, h, y) summed over rows; those of two sets of rows add up."""

    products: np.ndarray

    @classmethod
    def of(cls, sums: Sequence[float]) -> Gram:
        width = round(len(sums) ** 0.5)
        return cls(np.array(sums).reshape(width, width))

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.products + other.products)

    def solve(self, reg: float) -> Readout:
        """Least squares with a ridge penalty on standardised coefficients, as `fit_forecaster` has it."""
        n, means = self.products[0, 0], self.products[0, 1:] / self.products[0, 0]
        spread = self.products[1:, 1:] / n - np.outer(means, means)
        scale = np.sqrt(np.maximum(np.diag(spread), 0.0))
        known = np.flatnonzero(scale[:-1] > 1e-12)  # constant encodings tell nothing
        weights = np.zeros(len(scale) - 1)
        if len(known) and scale[-1] > 0:
            of_x = spread[np.ix_(known, known)] / np.outer(scale[known], scale[known])
            of_y = spread[known, -1] / (scale[known] * scale[-1])
            penalty = reg / scale[-1] * np.eye(len(known))
            weights[known] = np.linalg.lstsq(of_x + penalty, of_y, rcond=None)[0] * scale[-1] / scale[known]
        return Readout(DenseVector(weights), float(means[-1] - means[:-1] @ weights))

    def loss(self, readout: Readout) -> float:
        """Mean squared residual of these rows."""
        v = np.concatenate([[readout.intercept], readout.coefficients.toArray(), [-1.0]])
        return max(0.0, float(v @ self.products @ v / self.products[0, 0]))


def pooled_scores(predictions: DataFrame, group: Sequence[str] = ("model",)) -> DataFrame:
    """(group, n, mae, rmse, mape, r2) over the rows of all series together."""
    e = F.col("y_true") - F.col("y_pred")
    return predictions.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (100 * F.avg(F.abs(ratio(e, F.col("y_true"))))).alias("mape"),
        (1 - ratio(F.avg(e * e), F.var_pop("y_true"))).alias("r2"),
    )
