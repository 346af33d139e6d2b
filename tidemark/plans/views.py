"""Price tables derived from the TPC-H-like tables, in Spark and as SQL text for the checks.

Prices have two decimals, so sums are taken over whole hundredths (or
ten-thousandths for discounted prices): exact, and the same in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.alignment import naive_forecast, trailing_mean_forecast
from tidemark.operators.blocks import plan_blocks
from tidemark.operators.cleaning import dedupe_first
from tidemark.session import stored

ARRIVAL = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _units(c: Column, scale: int) -> Column:
    return F.sum(F.round(c * scale).cast("long")).cast("double")


def prices_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """One row per return flag and day: a series here has as many rows as the calendar has days."""
    full = F.col("l_extendedprice")
    reduced = full * (1 - F.col("l_discount"))
    n = F.count(F.lit(1))
    daily = table(spark, folder, "lineitem").groupBy(F.col("l_returnflag").alias("series"), F.col("l_shipdate").alias("ts"))
    prices = daily.agg(
        (_units(full, 100) / (100 * n)).alias("selling_price"),
        (_units(reduced, 10_000) / (10_000 * n)).alias("buying_price"),
    )
    return prices.withColumn("spread", F.col("selling_price") - F.col("buying_price"))


PRICES_LINEITEM = """
SELECT series, ts, selling_price, buying_price, selling_price - buying_price AS spread
FROM (SELECT l_returnflag AS series, l_shipdate AS ts,
        CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / (100 * COUNT(*)) AS selling_price,
        CAST(SUM(CAST(round(l_extendedprice * (1 - l_discount) * 10000) AS BIGINT)) AS DOUBLE) / (10000 * COUNT(*)) AS buying_price
      FROM lineitem GROUP BY l_returnflag, l_shipdate)"""


def ticks_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as a tick: many rows per series and day."""
    full = F.col("l_extendedprice")
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("series"),
        F.col("l_shipdate").alias("ts"),
        *ARRIVAL,
        full.alias("selling_price"),
        (full * (1 - F.col("l_discount"))).alias("buying_price"),
        (full - full * (1 - F.col("l_discount"))).alias("spread"),
    )


TICKS_LINEITEM = """
SELECT l_returnflag AS series, l_shipdate AS ts, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_extendedprice AS selling_price, l_extendedprice * (1 - l_discount) AS buying_price,
       l_extendedprice - l_extendedprice * (1 - l_discount) AS spread
FROM lineitem"""


def prices_orders(spark: SparkSession, folder: str) -> DataFrame:
    daily = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("series"), F.col("o_orderdate").alias("ts"))
    return daily.agg((_units(F.col("o_totalprice"), 100) / (100 * F.count(F.lit(1)))).alias("selling_price"))


PRICES_ORDERS = """
SELECT o_orderpriority AS series, o_orderdate AS ts,
       CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / (100 * COUNT(*)) AS selling_price
FROM orders GROUP BY o_orderpriority, o_orderdate"""


def ticks_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event values as ticks: few, very long series. One row per (series, ts), the lowest event id.

    Stored, because the block operators read their input three times.
    """
    events = table(spark, folder, "events").filter(F.col("value") > 0)
    first = dedupe_first(events.select("event_type", "ts", "event_id", "value"), ["event_type"], "ts", ["event_id"])
    sell = F.col("value")
    ticks = first.select(
        F.col("event_type").alias("series"), "ts", sell.alias("selling_price"),
        (sell * 0.98).alias("buying_price"), (sell - sell * 0.98).alias("spread"),
    )
    return stored(ticks, "ticks")


TICKS_EVENTS = """
SELECT event_type AS series, ts, value AS selling_price, value * CAST(0.98 AS DOUBLE) AS buying_price,
       value - value * CAST(0.98 AS DOUBLE) AS spread
FROM (SELECT *, row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id) AS copy FROM events WHERE value > 0)
WHERE copy = 1"""


def predictions_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Two models over the daily prices: previous value and trailing mean of ten."""
    prices = prices_lineitem(spark, folder)
    return naive_forecast(prices, ["series"], blocks=None).unionByName(
        trailing_mean_forecast(prices, ["series"], blocks=None)
    )


_PREDICTIONS = """
SELECT * FROM (
  SELECT 'naive' AS model, series, ts, selling_price AS y_true,
         lag(selling_price) OVER (PARTITION BY series ORDER BY ts) AS y_pred FROM {source}
  UNION ALL
  SELECT 'ma10', series, ts, selling_price,
         CASE WHEN count(*) OVER w10 = 10 THEN avg(selling_price) OVER w10 END FROM {source}
  WINDOW w10 AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
WHERE y_pred IS NOT NULL"""

PREDICTIONS_LINEITEM = _PREDICTIONS.format(source=f"({PRICES_LINEITEM})")
PREDICTIONS_EVENTS = _PREDICTIONS.format(source=f"({TICKS_EVENTS})")


def predictions_events(spark: SparkSession, folder: str, block_rows: int) -> DataFrame:
    ticks = ticks_events(spark, folder)
    blocks = plan_blocks(ticks, ["series"], "ts", 11, block_rows)
    both = naive_forecast(ticks, ["series"], blocks=blocks).unionByName(
        trailing_mean_forecast(ticks, ["series"], blocks=blocks)
    )
    return stored(both, "predictions")
