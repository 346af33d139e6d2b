"""Queries over the forecaster, its leaderboard and streaming ingestion.

The encoder and the fit are not expressible in SQL; their queries report rows
whose numbers are checked by the unit tests. Streams are checked against SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.alignment import naive_forecast
from tidemark.functions.recurrent import EncoderSpec
from tidemark.operators.forecasting import (
    Sweep,
    Trial,
    encode_series,
    forecast,
    sweep,
)
from tidemark.operators.features import INDICATOR_HALO, add_indicators, with_lookback
from tidemark.operators.metrics import regression_metrics
from tidemark.operators.reporting import best_model, run_summary
from tidemark.operators.scaling import fit_scaler, minmax_columns
from tidemark.operators.sequences import chronological_split, latest_window
from tidemark.plans.catalog.cleaning import _JUDGED, _PAYLOADS, BLOCK, KEY, payload_text
from tidemark.plans.catalog.features import indicators_sql
from tidemark.plans.catalog.registry import query, rounded, sql_round
from tidemark.plans.preprocess import Prepared, fit_and_predict, prepare, prepare_recent
from tidemark.plans.views import PRICES_LINEITEM, TICKS_EVENTS, prices_lineitem, ticks_events
from tidemark.session import new_folder, stored
from tidemark.sources.models import latest_model, load_model, save_model
from tidemark.sources.payloads import parse_payloads
from tidemark.schemas import SELL_FIELD, TIME_FIELD
from tidemark.streaming.payloads import dedupe_stream, land_price_stream, landed_prices, stream_price_payloads, write_stream

SMALL = EncoderSpec(hidden=16, layers=2, seed=7)
LENGTH = 30


def _prepared(spark: SparkSession, folder: str) -> Prepared:
    return prepare(prices_lineitem(spark, folder), KEY, block_rows=None)


@query("encode_series")
def _encode(spark: SparkSession, folder: str) -> DataFrame:
    """Encodings of every sequence of the daily prices."""
    return encode_series(_prepared(spark, folder).scaled, KEY, spec=SMALL, length=LENGTH, blocks=None)


@query("encode_series_blocks")
def _encode_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same over long tick series, one block per task at a time."""
    return encode_series(prepare(ticks_events(spark, folder), KEY, block_rows=BLOCK).scaled, KEY, spec=SMALL, length=LENGTH, blocks=BLOCK)


@query("lstm_predictions")
def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on the older part of each series, predict the newest part, in price units."""
    return fit_and_predict(_prepared(spark, folder), KEY, SMALL, LENGTH, blocks=None).predictions


@query("lstm_against_naive")
def _against_naive(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of the forecaster and of the previous-value forecast on the same rows."""
    prepared = _prepared(spark, folder)
    fitted = stored(fit_and_predict(prepared, KEY, SMALL, LENGTH, blocks=None).predictions)
    naive = naive_forecast(prepared.clean, KEY, blocks=None).join(fitted.select("series", "ts"), ["series", "ts"], "left_semi")
    return regression_metrics(fitted.unionByName(naive.select(*fitted.columns)), blocks=None)


@query("lstm_forecast")
def _forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Save, find and load a forecaster, then forecast 30 days of each series."""
    prepared = _prepared(spark, folder)
    models = new_folder(spark, "models")
    save_model(spark, fit_and_predict(prepared, KEY, SMALL, LENGTH, blocks=None).forecaster, f"{models}/daily")
    loaded = load_model(spark, latest_model(spark, models))
    windows, _ = latest_window(prepared.scaled, KEY, length=LENGTH)
    return forecast(windows, loaded, KEY, 30)


TRIALS = (
    Trial("small", EncoderSpec(8, 1, 1)),
    Trial("medium", EncoderSpec(16, 2, 1)),
    Trial("wide", EncoderSpec(32, 1, 1), 1e-3),
)


def _sweep(spark: SparkSession, folder: str) -> Sweep:
    prepared = _prepared(spark, folder)
    split = stored(chronological_split(prepared.scaled, KEY, "ts", blocks=None))
    return sweep(split, KEY, TRIALS, stored(prepared.scaler), length=LENGTH, blocks=None)


_RECENT = ["selling_price", "spread", "ma_short", "rsi", "price_lag_7"]


_RECENT_MINMAX = minmax_columns(_RECENT)


def _scaled_sql(c: str) -> str:
    if c in _RECENT_MINMAX:
        return f"coalesce((f.{c} - s.lo_{c}) / nullif(s.hi_{c} - s.lo_{c}, 0), 0)"
    return f"coalesce((f.{c} - s.mean_{c}) / nullif(s.dev_{c}, 0), 0)"


@query(
    "prepare_recent",
    indicators_sql(PRICES_LINEITEM)
    + f"""SELECT series, ts, feature, {sql_round("z", 4, "z")} FROM (
        SELECT f.series, f.ts, unnest([{", ".join(f"'{c}'" for c in _RECENT)}]) AS feature, unnest([{", ".join(_scaled_sql(c) for c in _RECENT)}]) AS z,
               dense_rank() OVER (PARTITION BY f.series ORDER BY f.ts DESC) AS i
        FROM features f JOIN (SELECT series, {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}, avg({c}) AS mean_{c}, stddev_pop({c}) AS dev_{c}" for c in _RECENT)}
                              FROM features WHERE ts < TIMESTAMP '2000-01-01' GROUP BY series) s
        ON s.series = f.series WHERE f.ts >= TIMESTAMP '2000-06-01' AND f.series <> 'R') WHERE i <= {LENGTH}""",
)
def _prepare_recent(spark: SparkSession, folder: str) -> DataFrame:
    """New prices under stored scalers: all features of the last window of each series that the scalers know."""
    windows, _ = _recent(spark, folder)
    prices = prices_lineitem(spark, folder).filter(F.col("ts") >= F.lit("2000-06-01").cast("timestamp_ntz"))
    newest = Window.partitionBy("series").orderBy(F.desc("ts"))
    days = prices.select("series", "ts", (F.row_number().over(newest)).alias("back")).filter(F.col("back") <= LENGTH)
    cells = windows.select("series", F.posexplode("x").alias("at", "z"))
    back = (LENGTH - F.floor(F.col("at") / len(_RECENT))).cast("int")
    name = F.element_at(F.array(*[F.lit(c) for c in _RECENT]), (F.col("at") % len(_RECENT) + 1).cast("int"))
    shown = cells.select("series", back.alias("back"), name.alias("feature"), "z").join(days, ["series", "back"])
    return rounded(shown.select("series", "ts", "feature", "z"), {4: ["z"]})


@query("prepare_recent_rejects", "SELECT DISTINCT l_returnflag AS series, 'unknown_series' AS reason FROM lineitem WHERE l_returnflag = 'R'")
def _recent_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return _recent(spark, folder)[1].select("series", "reason")


def _recent(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    prices = stored(prices_lineitem(spark, folder))
    old = add_indicators(prices.filter(F.col("ts") < F.lit("2000-01-01").cast("timestamp_ntz")), KEY, blocks=None)
    scaler = stored(fit_scaler(old.filter("series <> 'R'"), KEY, _RECENT))
    new = with_lookback(prices, KEY, "ts", "2000-06-01", LENGTH + INDICATOR_HALO)
    return prepare_recent(new, KEY, scaler, _RECENT, LENGTH, blocks=None)


@query("lstm_leaderboard")
def _leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    return _sweep(spark, folder).leaderboard


@query("best_trial")
def _best(spark: SparkSession, folder: str) -> DataFrame:
    return best_model(_sweep(spark, folder).leaderboard)


@query("run_summary")
def _runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_summary(_sweep(spark, folder).history)


@query("stream_event_prices", f"SELECT series, ts, selling_price FROM ({TICKS_EVENTS})")
def _stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a stream: de-duplicated behind a watermark, appended to a table."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    arriving = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    prices = arriving.filter(F.col("value") > 0).select(
        F.col("event_type").alias("series"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("selling_price")
    )
    path = new_folder(spark, "stream")
    write_stream(dedupe_stream(prices, KEY), path, f"{path}-checkpoint").awaitTermination()
    return spark.read.schema(prices.schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "stream_payloads",
    f"SELECT series, ts, selling_price, buying_price, selling_price - buying_price AS spread FROM ({_JUDGED}) WHERE NOT absent AND NOT unreadable",
)
def _stream_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Payload documents as a stream; every document is delivered twice and counted once."""
    source = new_folder(spark, "arriving")
    documents = payload_text(spark, folder)
    for delivery in range(2):
        documents.write.mode("append").partitionBy("series", "year").option("maxRecordsPerFile", 1).text(source)
    prices = stream_price_payloads(spark, source, keys=["series", "year"]).drop("year")
    path = new_folder(spark, "stream")
    write_stream(prices, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.schema(prices.schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# Every payload record twice: the first copy of a tenth day has a price below zero, and all
# second copies another price.
_COPIES = """SELECT series, ts, CASE WHEN day(ts) = 10 THEN -1 ELSE selling_price END AS selling_price, buying_price
    FROM ({judged}) WHERE NOT absent AND NOT unreadable""".format(judged=_JUDGED)


def _changed(record: Column, price: str) -> Column:
    return F.map_concat(F.map_filter(record, lambda k, v: k != SELL_FIELD), F.create_map(F.lit(SELL_FIELD), F.lit(price)))


def _later_copy(record: Column) -> Column:
    return F.when(record[SELL_FIELD] == "n/a", record).otherwise(_changed(record, "5"))


def _deliver(payloads: DataFrame, records: Column, folder: str) -> None:
    """Payload documents with these records as files of a folder."""
    text = F.to_json(F.struct("responseCode", F.struct(records.alias("priceList")).alias("data")))
    files = payloads.select("series", "year", text.alias("value")).write.mode("append").partitionBy("series", "year")
    files.option("maxRecordsPerFile", 1).text(folder)


@query("stream_first_copies", f"SELECT series, ts, selling_price, buying_price, selling_price - buying_price AS spread FROM ({_COPIES}) WHERE selling_price > 0")
def _stream_first(spark: SparkSession, folder: str) -> DataFrame:
    """Copies that differ, also across deliveries: the first one counts, even where it is invalid."""
    source, target = new_folder(spark, "arriving"), new_folder(spark, "landed-stream")
    tenth = lambda r: F.substring(r[TIME_FIELD], 9, 2) == "10"
    kept = F.transform("data.priceList", lambda r: F.when(tenth(r), _changed(r, "-1")).otherwise(r))
    later = F.transform("data.priceList", _later_copy)
    parsed = parse_payloads(payload_text(spark, folder))
    for price_list in (F.concat(kept, later), later):
        _deliver(parsed, price_list, source)
        land_price_stream(spark, source, target, f"{target}/checkpoint", ["series", "year"]).awaitTermination()
    return landed_prices(spark, target).drop("year").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# The years up to this one arrive first; then all years do, with other prices.
_FIRST_YEARS = 1995


@query(
    "stream_arrivals",
    f"""WITH good AS (SELECT * FROM ({_JUDGED}) WHERE NOT absent AND NOT unreadable),
        closed AS (SELECT max(ts) - INTERVAL 60 DAY AS until FROM good WHERE year <= {_FIRST_YEARS})
        SELECT 'price' AS kind, series, ts, CASE WHEN year <= {_FIRST_YEARS} THEN selling_price ELSE 5 END AS selling_price, NULL AS reason, 1 AS n FROM good
        UNION ALL SELECT 'late', series, ts, 5, NULL, 1 FROM good, closed WHERE ts <= until
        UNION ALL SELECT 'quarantined', series, ts, NULL, CASE WHEN unreadable THEN 'bad_selling_price' ELSE 'bad_buying_price' END,
                         CASE WHEN year <= {_FIRST_YEARS} THEN 2 ELSE 1 END FROM ({_JUDGED}) WHERE absent OR unreadable
        UNION ALL SELECT 'rejected', series, make_timestamp(year, 1, 1, 0, 0, 0), NULL, reject_reason, CASE WHEN year <= {_FIRST_YEARS} THEN 2 ELSE 1 END
                  FROM ({_PAYLOADS}) WHERE reject_reason IS NOT NULL""",
)
def _stream_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """All kinds of rows of two deliveries: the second repeats the first with other prices and brings later years."""
    source, target = new_folder(spark, "arriving"), new_folder(spark, "landed-stream")
    parsed = parse_payloads(payload_text(spark, folder))
    for payloads, price_list in ((parsed.filter(F.col("year") <= _FIRST_YEARS), F.col("data.priceList")), (parsed, F.transform("data.priceList", _later_copy))):
        _deliver(payloads, price_list, source)
        land_price_stream(spark, source, target, f"{target}/checkpoint", ["series", "year"], watermark="60 days").awaitTermination()
    every = spark.read.parquet(target)
    of_year = F.make_timestamp_ntz(F.col("year").cast("int"), *[F.lit(x) for x in (1, 1, 0, 0, 0)])
    ts = F.when(F.col("kind") == "rejected", of_year).otherwise(F.col("ts").cast("timestamp_ntz")).alias("ts")
    price = F.when(F.col("kind").isin("price", "late"), F.col("selling_price")).alias("selling_price")
    return every.groupBy(F.col("kind").cast("string").alias("kind"), "series", ts, price, "reason").agg(F.count(F.lit(1)).cast("int").alias("n"))
