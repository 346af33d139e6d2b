"""Structured Streaming over folders of arriving payloads or price rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.cleaning import bad_record_reason, positive_prices, to_prices
from tidemark.schemas import PAYLOAD, REQUIRED_FIELDS
from tidemark.sources.payloads import validate_payload
from tidemark.streaming.first_copies import LATE, PRICE, first_copies, rocksdb_state

WATERMARK = "30 days"
QUARANTINED, REJECTED = "quarantined", "rejected"
KINDS = (PRICE, LATE, QUARANTINED, REJECTED)
# Copies of a batch count in this order: by their file's time, its name and their place in it.
ARRIVAL = ("arrived", "source", "ordinal")


def dedupe_stream(prices: DataFrame, keys: Sequence[str], ts: str = "ts", watermark: str = WATERMARK) -> DataFrame:
    """One row per (keys, ts); state older than the watermark is dropped, and so are later rows."""
    return prices.withWatermark(ts, watermark).dropDuplicates([*keys, ts])


def _read(spark: SparkSession, folder: str, keys: Sequence[str], files_per_trigger: int | None) -> DataFrame:
    schema = T.StructType([*PAYLOAD.fields, *[T.StructField(k, T.StringType()) for k in keys]])
    reader = spark.readStream.schema(schema).option("multiLine", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder).select(
        "*", F.col("_metadata.file_modification_time").alias("arrived"), F.col("_metadata.file_path").alias("source")
    )


def _records(payloads: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per record of a valid payload, and one for an invalid one with its text; each file is read once."""

    def record(r: Column | None, i: Column | None) -> Column:
        fields = [(F.lit(None).cast("string") if r is None else F.try_element_at(r, F.lit(f))).alias(f) for f in REQUIRED_FIELDS]
        return F.struct(F.lit(0).alias("ordinal") if i is None else i.alias("ordinal"), *fields)

    every = F.when(F.col("is_valid"), F.transform("data.priceList", record)).otherwise(F.array(record(None, None)))
    text = F.when(~F.col("is_valid"), F.to_json(F.struct("responseCode", "data"))).alias("payload")
    return payloads.select(*keys, "arrived", "source", "is_valid", "reject_reason", text, F.explode(every).alias("_r")).select(
        *keys, "arrived", "source", "is_valid", "reject_reason", "payload", "_r.*"
    )


def stream_arrivals(
    spark: SparkSession, folder: str, watermark: str = WATERMARK, keys: Sequence[str] = (), files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming table of all that a folder of JSON payloads delivers, each row with its `kind`.

    `price`: the first copy to arrive of each (keys, ts), whatever its price, so that a bad
    first copy hides a later good one as in the batch path. `late`: copies of timestamps
    that the watermark has closed. `quarantined`: records that cannot be read, with the
    reason. `rejected`: one row per payload that fails validation, with the reason and the
    payload's text. Further copies of an open timestamp are dropped. Each poll of a source
    delivers its whole history again; the watermark says how far back a new timestamp may
    lie. `keys` are folder partition columns (`key=value`). Start it within `write_stream`
    or `rocksdb_state`.
    """
    records = _records(validate_payload(_read(spark, folder, keys, files_per_trigger)), keys)
    unreadable = bad_record_reason()
    kind = F.when(~F.col("is_valid"), REJECTED).when(unreadable.isNotNull(), QUARANTINED)
    reason = F.when(~F.col("is_valid"), F.col("reject_reason")).otherwise(unreadable)
    shown = [*keys, "kind", "reason", "arrived", "source", "ordinal", "payload", *REQUIRED_FIELDS]
    read = to_prices(records.withColumns({"kind": kind, "reason": reason}), shown)
    return first_copies(read, keys, "ts", ARRIVAL, watermark, read.columns)


def _prices(arrivals: DataFrame, keys: Sequence[str]) -> DataFrame:
    first = arrivals.filter(F.col("kind") == PRICE)
    return positive_prices(first).select(*keys, "ts", "selling_price", "buying_price", "spread")


def stream_price_payloads(
    spark: SparkSession, folder: str, watermark: str = WATERMARK, keys: Sequence[str] = (), files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming price table: the first copies of `stream_arrivals` that have valid prices."""
    return _prices(stream_arrivals(spark, folder, watermark, keys, files_per_trigger), keys)


def write_stream(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append to a Parquet table, taking what is there now and then stopping."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with rocksdb_state(df.sparkSession):
        return writer.trigger(availableNow=True).start(path)


def land_price_stream(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    files_per_trigger: int | None = None,
    watermark: str = WATERMARK,
) -> StreamingQuery:
    """Take the payloads that are there into a table under `target`, one folder per kind, then stop.

    The table's log says which files belong to it, so a batch that is repeated after a
    failure counts once. What has landed is never read again: state alone tells copies.
    """
    return write_stream(stream_arrivals(spark, folder, watermark, keys, files_per_trigger), target, checkpoint, ["kind"])


def landed(spark: SparkSession, target: str, kind: str) -> DataFrame:
    """Rows of one kind behind `land_price_stream`."""
    if kind not in KINDS:
        raise ValueError(f"kind is one of {', '.join(KINDS)}")
    return spark.read.parquet(target).filter(F.col("kind") == kind).drop("kind")


def landed_prices(spark: SparkSession, target: str) -> DataFrame:
    """The price table behind `land_price_stream`: first copies with valid prices."""
    extra = {"reason", "arrived", "source", "ordinal", "payload", *REQUIRED_FIELDS}
    rows = landed(spark, target, PRICE)
    return positive_prices(rows).select(*[c for c in rows.columns if c not in extra])
