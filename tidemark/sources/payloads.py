"""Price payloads: landed JSON documents, each with one price history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.schemas import CHECKED_RECORDS, PAYLOAD, REQUIRED_FIELDS, SUCCESS_CODE


def _file_columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_modification_time").alias("ingest_ts"),
    ]


def read_price_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON document: payload columns, source path and arrival time."""
    files = spark.read.schema(PAYLOAD).option("multiLine", True).json(path)
    return files.select("*", *_file_columns())


def parse_payloads(df: DataFrame, column: str = "value") -> DataFrame:
    """The same columns from payloads held as text in `column`."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.from_json(column, PAYLOAD).alias("_p")).select(*others, "_p.*")


def _first_records_own(records: Column, name: str) -> Column:
    return F.forall(
        F.slice(records, 1, CHECKED_RECORDS), lambda r: F.coalesce(F.map_contains_key(r, name), F.lit(False))
    )


def validate_payload(df: DataFrame) -> DataFrame:
    """Add `is_valid` and `reject_reason`.

    Accepted: the success code, a non-empty price list, and the required fields present in
    the first records. A field that is present with a null value passes.
    """
    records = F.col("data.priceList")
    reason = (
        F.when(~F.col("responseCode").eqNullSafe(SUCCESS_CODE), "response_code")
        .when(records.isNull(), "missing_price_list")
        .when(F.size(records) == 0, "empty_price_list")
    )
    for name in REQUIRED_FIELDS:
        reason = reason.when(~_first_records_own(records, name), f"missing_{name}")
    return df.withColumn("reject_reason", reason).withColumn("is_valid", F.col("reject_reason").isNull())


def explode_records(df: DataFrame, keys: Sequence[str] = ("source",)) -> DataFrame:
    """(keys, ordinal, required fields as text): one row per record, `ordinal` its position."""
    exploded = df.select(*keys, F.posexplode("data.priceList").alias("ordinal", "_r"))
    return exploded.select(*keys, "ordinal", *[F.try_element_at("_r", F.lit(f)).alias(f) for f in REQUIRED_FIELDS])


def land_payloads(df: DataFrame, path: str) -> None:
    """Append payloads to a Parquet table partitioned by arrival date."""
    df.withColumn("ingest_date", F.to_date("ingest_ts")).write.mode("append").partitionBy("ingest_date").parquet(path)


def latest_snapshot(
    df: DataFrame, keys: Sequence[str] = ("source",), now: Column | None = None, max_age_s: int = 3600, stale_ok: bool = False
) -> DataFrame:
    """The newest payload per key, if it is younger than `max_age_s`.

    Of payloads that arrived together the one of the last `source` counts. `stale_ok` keeps older ones too (the fallback when nothing newer arrived); `is_fresh` tells.
    """
    now = F.current_timestamp() if now is None else now
    newest = Window.partitionBy(*keys).orderBy(F.col("ingest_ts").desc(), *([F.col("source").desc()] if "source" in df.columns else []))
    latest = df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")
    age = F.make_dt_interval(secs=F.lit(max_age_s))
    marked = latest.withColumn("is_fresh", F.col("ingest_ts") > now - age)
    return marked if stale_ok else marked.filter("is_fresh")


def to_payload_text(df: DataFrame, keys: Sequence[str], code: Column | None = None) -> DataFrame:
    """(keys, value): records grouped into payload documents, in order of `ordinal`.

    The caller's keys must bound a document, such as one series and year of daily prices.
    """
    record = F.struct("ordinal", F.struct(*REQUIRED_FIELDS).alias("r"))
    gathered = df.groupBy(*keys).agg(F.array_sort(F.collect_list(record)).alias("_rows"))
    records = F.transform("_rows", lambda x: x["r"])
    code = F.lit(SUCCESS_CODE) if code is None else code
    document = F.struct(code.alias("responseCode"), F.struct(records.alias("priceList")).alias("data"))
    return gathered.select(*keys, F.to_json(document).alias("value"))

