"""Saved forecasters: readout, scaler and encoder settings.

A save goes into a folder of its own under the model's path, and only when it is whole a
small row is written that points to it. Readers follow the newest pointer, so a save that
was cut short, or one that is still going on, is never seen.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.forecasting import EncoderSpec, Forecaster

_POINTER = "version string, name string, fitted_at string, saved_at timestamp, settings string"


def _write_version(spark: SparkSession, forecaster: Forecaster, folder: str) -> None:
    forecaster.readout.write().save(f"{folder}/readout")
    if forecaster.scaler is not None:
        forecaster.scaler.write.parquet(f"{folder}/scaler")


def _publish(spark: SparkSession, forecaster: Forecaster, path: str, version: str) -> None:
    spec = forecaster.spec
    settings = {
        "hidden": spec.hidden,
        "layers": spec.layers,
        "seed": spec.seed,
        "features": list(forecaster.features),
        "length": forecaster.length,
        "scaled": forecaster.scaler is not None,
    }
    row = spark.createDataFrame([(version, forecaster.name, forecaster.fitted_at, json.dumps(settings))], "version string, name string, fitted_at string, settings string")
    row = row.select("version", "name", "fitted_at", F.current_timestamp().alias("saved_at"), "settings")
    # One file, which the writer commits by a rename: the pointer is there or it is not.
    row.coalesce(1).write.mode("append").json(f"{path}/published")


def save_model(spark: SparkSession, forecaster: Forecaster, path: str) -> str:
    """Write a new version under `path` and publish it; returns the version. Earlier ones stay."""
    version = uuid.uuid4().hex
    _write_version(spark, forecaster, f"{path}/versions/{version}")
    _publish(spark, forecaster, path, version)
    return version


def _published(spark: SparkSession, pattern: str) -> DataFrame:
    return spark.read.schema(_POINTER).json(pattern).filter(F.col("version").isNotNull())


def load_model(spark: SparkSession, path: str, version: str | None = None) -> Forecaster:
    """The version published last, or the one named."""
    rows = _published(spark, f"{path}/published")
    if version is not None:
        rows = rows.filter(F.col("version") == version)
    row = rows.orderBy(F.desc("saved_at"), F.desc("version")).first()
    if row is None:
        raise FileNotFoundError(f"no published model under {path}")
    settings, folder = json.loads(row.settings), f"{path}/versions/{row.version}"
    return Forecaster(
        LinearRegressionModel.load(f"{folder}/readout"),
        EncoderSpec(settings["hidden"], settings["layers"], settings["seed"]),
        spark.read.parquet(f"{folder}/scaler") if settings["scaled"] else None,
        tuple(settings["features"]),
        settings["length"],
        row.name,
        row.fitted_at,
    )


def latest_model(spark: SparkSession, folder: str) -> str | None:
    """Path of the model fitted last, by its recorded time."""
    saved = _published(spark, f"{folder}/*/published")
    newest = saved.select("fitted_at", "saved_at", F.col("_metadata.file_path").alias("file")).orderBy(F.desc("fitted_at"), F.desc("saved_at")).first()
    return newest.file.rsplit("/published/", 1)[0] if newest else None
