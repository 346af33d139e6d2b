"""Queries over the sources, cleaning and quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.cleaning import (
    dedupe_first,
    fill_missing,
    iqr_bounds,
    iqr_filter,
    latest_days,
    positive_prices,
    price_summary,
    quality_report,
    require_min_rows,
    sort_by_time,
    split_bad_records,
    zscore_outliers,
)
from tidemark.plans.catalog.registry import query, rounded, rounded_sql
from tidemark.plans.views import (
    ARRIVAL,
    PRICES_LINEITEM,
    PRICES_ORDERS,
    TICKS_EVENTS,
    TICKS_LINEITEM,
    prices_lineitem,
    prices_orders,
    table,
    ticks_events,
    ticks_lineitem,
)
from tidemark.schemas import BUY_FIELD, SELL_FIELD, SUCCESS_CODE, TIME_FIELD
from tidemark.session import new_folder
from tidemark.sources.payloads import (
    explode_records,
    land_payloads,
    latest_snapshot,
    parse_payloads,
    read_price_payloads,
    to_payload_text,
    validate_payload,
)
from tidemark.sources.tables import read_prices, write_prices

KEY = ["series"]
BLOCK = 512


def payload_text(spark: SparkSession, folder: str) -> DataFrame:
    """Daily prices as JSON payloads, one per series and year, some of them defective.

    1998 carries a failure code; the third of most months lacks the buying
    price; on the seventeenth the selling price is not a number.
    """
    prices = prices_lineitem(spark, folder)
    day, month, year = F.dayofmonth("ts"), F.month("ts"), F.year("ts")
    absent = (day == 3) & ((month > 1) | (year % 2 == 1))
    records = prices.select(
        "series",
        year.alias("year"),
        F.unix_date(F.col("ts").cast("date")).alias("ordinal"),
        F.when(day == 17, "n/a").otherwise(F.col("selling_price").cast("string")).alias(SELL_FIELD),
        F.when(~absent, F.col("buying_price").cast("string")).alias(BUY_FIELD),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias(TIME_FIELD),
    )
    code = F.when(F.col("year") == 1998, "5000000500").otherwise(SUCCESS_CODE)
    return to_payload_text(records, ["series", "year"], code)


_RECORDS = f"""
SELECT series, year(ts) AS year, ts, selling_price, buying_price,
       (day(ts) = 3 AND (month(ts) > 1 OR year(ts) % 2 = 1)) AS absent, day(ts) = 17 AS unreadable,
       row_number() OVER (PARTITION BY series, year(ts) ORDER BY ts) AS place
FROM ({PRICES_LINEITEM})"""

_PAYLOADS = f"""
SELECT series, year,
       CASE WHEN year = 1998 THEN 'response_code'
            WHEN bool_or(absent AND place <= 5) THEN 'missing_{BUY_FIELD}' END AS reject_reason
FROM ({_RECORDS}) GROUP BY series, year"""


@query("validate_payload", f"SELECT series, year, reject_reason, reject_reason IS NULL AS is_valid FROM ({_PAYLOADS})")
def _validate(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate_payload(parse_payloads(payload_text(spark, folder)))
    return checked.select("series", "year", "reject_reason", "is_valid")


def _valid_records(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate_payload(parse_payloads(payload_text(spark, folder)))
    return explode_records(checked.filter("is_valid"), ["series", "year"])


_JUDGED = f"SELECT r.* FROM ({_RECORDS}) r JOIN ({_PAYLOADS}) p ON r.series = p.series AND r.year = p.year WHERE p.reject_reason IS NULL"


@query(
    "payload_prices",
    f"""SELECT series, year, ts, selling_price, buying_price, selling_price - buying_price AS spread
        FROM ({_JUDGED}) WHERE NOT absent AND NOT unreadable""",
)
def _payload_prices(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = split_bad_records(_valid_records(spark, folder), ["series", "year"])
    return good.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "quarantined_records",
    f"""SELECT series, year, place - 1 AS ordinal, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "{TIME_FIELD}",
               CASE WHEN unreadable THEN 'bad_selling_price' ELSE 'bad_buying_price' END AS reason
        FROM ({_JUDGED}) WHERE absent OR unreadable""",
)
def _quarantined(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = split_bad_records(_valid_records(spark, folder), ["series", "year"], ["ordinal"])
    return bad.select("series", "year", F.col("ordinal").cast("long").alias("ordinal"), TIME_FIELD, "reason")


@query(
    "payload_files",
    f"""SELECT series, year, reject_reason, (SELECT count(*) FROM ({_RECORDS}) r WHERE r.series = p.series AND r.year = p.year) AS n_records
        FROM ({_PAYLOADS}) p""",
)
def _payload_files(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads written as JSON documents and read back as landed files."""
    path = new_folder(spark, "payload-files")
    documents = payload_text(spark, folder).repartition("series", "year")
    documents.write.partitionBy("series", "year").option("maxRecordsPerFile", 1).text(path)
    checked = validate_payload(read_price_payloads(spark, path))
    place = F.col("source")
    return checked.select(
        F.regexp_extract(place, "series=([^/]+)", 1).alias("series"),
        F.regexp_extract(place, "year=([0-9]+)", 1).cast("long").alias("year"),
        "reject_reason",
        F.size("data.priceList").cast("long").alias("n_records"),
    )


@query(
    "latest_snapshot",
    f"""SELECT series, year, ingest_ts, ingest_ts > TIMESTAMP '2001-12-01 00:00:00' - INTERVAL 45 DAY AS is_fresh
        FROM (SELECT r.series, r.year, max(r.ts) AS ingest_ts,
                     row_number() OVER (PARTITION BY r.series ORDER BY max(r.ts) DESC) AS place
              FROM ({_JUDGED}) r GROUP BY r.series, r.year) WHERE place = 1""",
)
def _latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Valid payloads landed in a table; the newest of each series, marked fresh or stale."""
    checked = validate_payload(parse_payloads(payload_text(spark, folder))).filter("is_valid")
    arrival = F.to_timestamp(F.array_max(F.transform("data.priceList", lambda r: r[TIME_FIELD])))
    path = new_folder(spark, "landed")
    land_payloads(checked.select("series", "year", arrival.alias("ingest_ts"), "responseCode", "data"), path)
    now = F.lit("2001-12-01 00:00:00").cast("timestamp")
    latest = latest_snapshot(spark.read.parquet(path), KEY, now, 45 * 86_400, stale_ok=True)
    return latest.select("series", "year", F.col("ingest_ts").cast("timestamp_ntz").alias("ingest_ts"), "is_fresh")


@query("price_table", PRICES_LINEITEM)
def _price_table(spark: SparkSession, folder: str) -> DataFrame:
    return sort_by_time(prices_lineitem(spark, folder), KEY)


@query("stored_prices", f"SELECT series, ts, selling_price, year(ts) AS year FROM ({PRICES_ORDERS}) WHERE year(ts) >= 1997")
def _stored_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Prices written by year and read back; the filter prunes whole folders."""
    path = new_folder(spark, "prices")
    write_prices(prices_orders(spark, folder), path)
    return read_prices(spark, path).filter(F.col("year") >= 1997).withColumn("year", F.col("year").cast("long"))


_FIRST = f"""
SELECT series, ts, l_orderkey, l_linenumber, selling_price, buying_price
FROM (SELECT *, row_number() OVER (PARTITION BY series, ts ORDER BY {", ".join(ARRIVAL)}) AS copy FROM ({TICKS_LINEITEM}))
WHERE copy = 1"""


@query("dedupe_first", _FIRST)
def _dedupe(spark: SparkSession, folder: str) -> DataFrame:
    first = dedupe_first(ticks_lineitem(spark, folder), KEY, "ts", ARRIVAL)
    return first.select("series", "ts", "l_orderkey", "l_linenumber", "selling_price", "buying_price")


@query(
    "positive_prices",
    "SELECT event_id, value AS selling_price, value - 25 AS buying_price FROM events WHERE value > 0 AND value - 25 > 0",
)
def _positive(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    return positive_prices(
        table(spark, folder, "events").select("event_id", value.alias("selling_price"), (value - 25).alias("buying_price"))
    )


@query(
    "iqr_bounds",
    rounded_sql(
        """SELECT series, q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
           FROM (SELECT event_type AS series, quantile_cont(value, CAST(0.25 AS DOUBLE)) AS q1,
                        quantile_cont(value, CAST(0.75 AS DOUBLE)) AS q3 FROM events GROUP BY event_type)""",
        {6: ["q1", "q3", "lower", "upper"]},
        ["series", "q1", "q3", "lower", "upper"],
    ),
)
def _iqr_bounds(spark: SparkSession, folder: str) -> DataFrame:
    values = table(spark, folder, "events").select(F.col("event_type").alias("series"), "value")
    return rounded(iqr_bounds(values, KEY, "value"), {6: ["q1", "q3", "lower", "upper"]})


def _iqr_sql(source: str, columns: str) -> str:
    return f"""
WITH base AS ({source}),
b1 AS (SELECT series, quantile_cont(selling_price, CAST(0.25 AS DOUBLE)) AS q1, quantile_cont(selling_price, CAST(0.75 AS DOUBLE)) AS q3
       FROM base GROUP BY series),
k1 AS (SELECT base.* FROM base JOIN b1 USING (series)
       WHERE selling_price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)),
b2 AS (SELECT series, quantile_cont(buying_price, CAST(0.25 AS DOUBLE)) AS q1, quantile_cont(buying_price, CAST(0.75 AS DOUBLE)) AS q3
       FROM k1 GROUP BY series)
SELECT {columns} FROM k1 JOIN b2 USING (series)
WHERE buying_price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"""


@query("iqr_filter", _iqr_sql(TICKS_EVENTS, "series, ts, selling_price, buying_price"))
def _iqr(spark: SparkSession, folder: str) -> DataFrame:
    return iqr_filter(ticks_events(spark, folder), KEY).drop("spread")


@query("iqr_filter_ticks", _iqr_sql(TICKS_LINEITEM, "series, ts, l_orderkey, l_linenumber, selling_price, buying_price"))
def _iqr_ticks(spark: SparkSession, folder: str) -> DataFrame:
    kept = iqr_filter(ticks_lineitem(spark, folder), KEY)
    return kept.select("series", "ts", "l_orderkey", "l_linenumber", "selling_price", "buying_price")


def _with_gaps(df: DataFrame) -> DataFrame:
    hole = F.pmod(F.unix_seconds(F.col("ts").cast("timestamp")).cast("long"), F.lit(7)) < 3
    return df.withColumns({c: F.when(~hole, F.col(c)) for c in ("selling_price", "spread")})


def _filled_sql(source: str) -> str:
    hole = "CAST(floor(epoch(ts)) AS BIGINT) % 7 < 3"
    return f"""
WITH gaps AS (SELECT series, ts, buying_price,
                     CASE WHEN NOT {hole} THEN selling_price END AS selling_price,
                     CASE WHEN NOT {hole} THEN spread END AS spread FROM ({source}))
SELECT series, ts, buying_price,
       coalesce(selling_price, last_value(selling_price IGNORE NULLS) OVER past, first_value(selling_price IGNORE NULLS) OVER ahead) AS selling_price,
       coalesce(spread, last_value(spread IGNORE NULLS) OVER past, first_value(spread IGNORE NULLS) OVER ahead) AS spread
FROM gaps
WINDOW past AS (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       ahead AS (PARTITION BY series ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


@query("fill_missing", _filled_sql(PRICES_LINEITEM).replace("CAST(floor(epoch(ts)) AS BIGINT) % 7", "CAST(floor(epoch(ts)) AS BIGINT) // 86400 % 7"))
def _fill(spark: SparkSession, folder: str) -> DataFrame:
    hole = F.pmod(F.unix_date(F.col("ts").cast("date")), F.lit(7)) < 3
    gaps = prices_lineitem(spark, folder)
    gaps = gaps.withColumns({c: F.when(~hole, F.col(c)) for c in ("selling_price", "spread")})
    return fill_missing(gaps, KEY, "ts", ["selling_price", "spread"], blocks=None)


@query("fill_missing_blocks", _filled_sql(TICKS_EVENTS))
def _fill_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same over long tick series, block by block with carries."""
    gaps = _with_gaps(ticks_events(spark, folder))
    return fill_missing(gaps, KEY, "ts", ["selling_price", "spread"], blocks=BLOCK)


_STATS = [f"{c}_{s}" for c in ("selling_price", "buying_price") for s in ("mean", "std")]


@query(
    "price_summary",
    rounded_sql(
        f"""SELECT series, count(*) AS total_records, min(ts) AS start, max(ts) AS finish,
                   min(selling_price) AS selling_price_min, max(selling_price) AS selling_price_max,
                   avg(selling_price) AS selling_price_mean, stddev_pop(selling_price) AS selling_price_std,
                   min(buying_price) AS buying_price_min, max(buying_price) AS buying_price_max,
                   avg(buying_price) AS buying_price_mean, stddev_pop(buying_price) AS buying_price_std
            FROM ({TICKS_LINEITEM}) GROUP BY series""",
        {4: _STATS},
        ["series", "total_records", "start", "finish", *[f"{c}_{f}" for c in ("selling_price", "buying_price") for f in ("min", "max", "mean", "std")]],
    ),
)
def _summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(price_summary(ticks_lineitem(spark, folder), KEY), {4: _STATS})


@query(
    "quality_report",
    """WITH r AS (SELECT l_returnflag AS series, CAST(floor(l_extendedprice) AS BIGINT) AS p,
                         l_discount = 0 AS no_buy, month(l_shipdate) = 2 AS no_date, l_shipdate AS d FROM lineitem),
       m AS (SELECT series, avg(CAST(p AS DOUBLE)) AS a, stddev_pop(CAST(p AS DOUBLE)) AS s FROM r GROUP BY series),
       c AS (SELECT series, greatest(60 - count(*), 0) AS insufficient_rows, 0 AS missing_selling_price,
                    count(*) FILTER (no_buy) AS missing_buying_price, count(*) FILTER (no_date) AS missing_dates,
                    count(*) FILTER (NOT no_date) - count(DISTINCT CASE WHEN NOT no_date THEN d END) AS duplicate_dates,
                    count(*) FILTER (abs(p - a) > 3 * s) AS outliers
             FROM r JOIN m USING (series) GROUP BY series)
       SELECT series, "check", CAST(n_bad AS BIGINT) AS n_bad, n_bad = 0 AS passed
       FROM (UNPIVOT c ON insufficient_rows, missing_selling_price, missing_buying_price, missing_dates, duplicate_dates, outliers
             INTO NAME "check" VALUE n_bad)""",
)
def _quality(spark: SparkSession, folder: str) -> DataFrame:
    records = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("series"),
        F.floor("l_extendedprice").cast("string").alias(SELL_FIELD),
        F.when(F.col("l_discount") != 0, F.col("l_discount").cast("string")).alias(BUY_FIELD),
        F.when(F.month("l_shipdate") == 2, "").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias(TIME_FIELD),
    )
    return quality_report(records, KEY)


_FAR = """SELECT event_type AS series, event_id, value, abs(value - m) > 3 * s AS is_outlier
          FROM (SELECT *, avg(value) OVER (PARTITION BY event_type) AS m, stddev_pop(value) OVER (PARTITION BY event_type) AS s FROM events)"""


@query("zscore_outliers", _FAR)
def _zscore(spark: SparkSession, folder: str) -> DataFrame:
    values = table(spark, folder, "events").select(F.col("event_type").alias("series"), "event_id", "value")
    return zscore_outliers(values, KEY, "value")


@query("drop_outliers", f"SELECT series, event_id, value FROM ({_FAR}) WHERE NOT is_outlier")
def _drop_outliers(spark: SparkSession, folder: str) -> DataFrame:
    values = table(spark, folder, "events").select(F.col("event_type").alias("series"), "event_id", "value")
    return zscore_outliers(values, KEY, "value", action="drop")


@query(
    "require_min_rows",
    "SELECT user_id, event_id, value FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE n >= 65",
)
def _min_rows(spark: SparkSession, folder: str) -> DataFrame:
    return require_min_rows(table(spark, folder, "events").select("user_id", "event_id", "value"), ["user_id"], 65)[0]


@query("too_short_series", "SELECT user_id, count(*) AS n_rows FROM events GROUP BY user_id HAVING count(*) < 65")
def _rejects(spark: SparkSession, folder: str) -> DataFrame:
    return require_min_rows(table(spark, folder, "events").select("user_id"), ["user_id"], 65)[1]


@query(
    "latest_days",
    f"SELECT series, ts, selling_price FROM (SELECT *, max(ts) OVER (PARTITION BY series) AS last FROM ({PRICES_ORDERS})) WHERE ts >= last - INTERVAL 365 DAY",
)
def _latest_days(spark: SparkSession, folder: str) -> DataFrame:
    return latest_days(prices_orders(spark, folder), KEY, "ts", 365)
