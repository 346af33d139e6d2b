"""Parquet tables in and out: plain folders, folders by year, and tables laid out by key hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_prices(df: DataFrame, path: str, ts: str = "ts", mode: str = "append") -> None:
    """Prices partitioned by year, so a recent slice prunes whole folders and no key makes one folder hot."""
    write_table(df.withColumn("year", F.year(ts)), path, ("year",), mode)


def write_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], ts: str = "ts", buckets: int = 200, path: str | None = None, mode: str = "overwrite"
) -> DataFrame:
    """A catalog table with its rows dealt by a hash of `keys` into `buckets` files, each sorted by keys and time.

    Rows are dealt before the write, so that each bucket is one sorted file. Windows and joins
    on `keys` then read it without a shuffle, and windows without a sort where one file
    holds a bucket. A hot series makes its bucket large: long series belong into blocks
    (`operators.blocks`), whose layout needs no buckets. `path` makes the table an external one.
    """
    keys = list(keys)
    writer = df.repartition(buckets, *keys).write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys, ts)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
