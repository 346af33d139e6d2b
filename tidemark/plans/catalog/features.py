"""Queries over indicators, scalers, sequences and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.cleaning import dedupe_first, iqr_filter
from tidemark.operators.features import (
    add_indicators,
    bollinger,
    ema,
    lag_features,
    macd,
    moving_averages,
    price_changes,
    rsi_sma,
    with_lookback,
)
from tidemark.operators.blocks import row_numbers
from tidemark.operators.reporting import indicator_panel
from tidemark.operators.scaling import apply_scaler, fit_scaler, inverse_price, minmax_columns
from tidemark.operators.sequences import (
    chronological_split,
    concat_splits,
    holdout_split,
    latest_window,
    make_sequences,
)
from tidemark.plans.catalog.cleaning import BLOCK, KEY, _iqr_sql
from tidemark.plans.catalog.registry import query, rounded, rounded_sql, rounding, sql_round
from tidemark.plans.preprocess import prepare
from tidemark.plans.views import (
    ARRIVAL,
    PRICES_LINEITEM,
    PRICES_ORDERS,
    TICKS_EVENTS,
    TICKS_LINEITEM,
    prices_lineitem,
    prices_orders,
    ticks_events,
    ticks_lineitem,
)
from tidemark.schemas import FEATURES
from tidemark.session import new_folder, stored
from tidemark.sources.tables import write_bucketed

MONEY = ["ma_short", "ma_long", "volatility", "bb_upper", "bb_lower"]
SHARE = ["price_ma_ratio", "roc", "bb_position", "rsi", "day_sin", "day_cos", "month_sin", "month_cos"]
PLACES = {4: MONEY, 6: SHARE}


def indicators_sql(source: str) -> str:
    """All 24 features, unrounded."""
    return f"""
WITH p AS ({source}),
s1 AS (SELECT p.*,
  CASE WHEN count(selling_price) OVER w10 = 10 THEN avg(selling_price) OVER w10 END AS ma_short,
  CASE WHEN count(selling_price) OVER w20 = 20 THEN avg(selling_price) OVER w20 END AS ma_long,
  CASE WHEN count(selling_price) OVER w20 = 20 THEN stddev_samp(selling_price) OVER w20 END AS volatility,
  selling_price / nullif(lag(selling_price, 5) OVER w, 0) - 1 AS roc,
  coalesce(greatest(selling_price - lag(selling_price) OVER w, 0), 0) AS up,
  coalesce(greatest(lag(selling_price) OVER w - selling_price, 0), 0) AS down,
  lag(selling_price, 1) OVER w AS price_lag_1, lag(spread, 1) OVER w AS spread_lag_1,
  lag(selling_price, 3) OVER w AS price_lag_3, lag(spread, 3) OVER w AS spread_lag_3,
  lag(selling_price, 7) OVER w AS price_lag_7, lag(spread, 7) OVER w AS spread_lag_7
  FROM p WINDOW w AS (PARTITION BY series ORDER BY ts),
    w10 AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
    w20 AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
s2 AS (SELECT s1.*, avg(up) OVER w14 AS gain, avg(down) OVER w14 AS loss, count(*) OVER w14 AS seen,
    max(up) OVER w14 > 0 AS rose, max(down) OVER w14 > 0 AS fell
  FROM s1 WINDOW w14 AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
features AS (SELECT series, ts, selling_price, buying_price, spread, ma_short, ma_long,
  selling_price / nullif(ma_short, 0) AS price_ma_ratio, volatility, roc,
  ma_long + 2 * volatility AS bb_upper, ma_long - 2 * volatility AS bb_lower,
  (selling_price - (ma_long - 2 * volatility)) / nullif((ma_long + 2 * volatility) - (ma_long - 2 * volatility), 0) AS bb_position,
  CASE WHEN seen < 14 THEN NULL WHEN fell THEN 100 - 100 / (1 + gain / loss) WHEN rose THEN 100 END AS rsi,
  isodow(ts) - 1 AS day_of_week, month(ts) AS month,
  sin(2 * pi() * (isodow(ts) - 1) / 7) AS day_sin, cos(2 * pi() * (isodow(ts) - 1) / 7) AS day_cos,
  sin(2 * pi() * month(ts) / 12) AS month_sin, cos(2 * pi() * month(ts) / 12) AS month_cos,
  price_lag_1, spread_lag_1, price_lag_3, spread_lag_3, price_lag_7, spread_lag_7 FROM s2)"""


def _select(places: dict, columns: list[str]) -> str:
    text = rounding(places, columns)
    return text.replace("day_of_week", "CAST(day_of_week AS INTEGER) AS day_of_week").replace(
        "month,", "CAST(month AS INTEGER) AS month,"
    )


_ALL = ["series", "ts", *FEATURES]
_INDICATORS = f"SELECT {_select(PLACES, _ALL)} FROM features"


@query("indicators", indicators_sql(PRICES_LINEITEM) + _INDICATORS)
def _indicators(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(add_indicators(prices_lineitem(spark, folder), KEY, blocks=None), PLACES)


@query("indicators_blocks", indicators_sql(TICKS_EVENTS) + _INDICATORS)
def _indicators_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Few, very long tick series, cut into even blocks."""
    return rounded(add_indicators(ticks_events(spark, folder), KEY, blocks=BLOCK), PLACES)


@query("bucketed_indicators", indicators_sql(PRICES_LINEITEM) + _INDICATORS)
def _bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Indicators over a catalog table laid out by series: its windows need no shuffle."""
    path = new_folder(spark, "bucketed")
    name = "prices_" + path.rsplit("-", 1)[1]
    table = write_bucketed(prices_lineitem(spark, folder), name, KEY, buckets=8, path=path)
    return rounded(add_indicators(table, KEY, blocks=None), PLACES)


_FIRST_TICKS = f"""
SELECT series, ts, selling_price, buying_price, spread FROM
 (SELECT *, row_number() OVER (PARTITION BY series, ts ORDER BY {", ".join(ARRIVAL)}) AS copy FROM ({TICKS_LINEITEM}))
WHERE copy = 1 AND selling_price > 0 AND buying_price > 0"""
_CLEAN = _iqr_sql(_FIRST_TICKS, "series, ts, selling_price, buying_price, spread")


@query("clean_indicators", indicators_sql(_CLEAN) + _INDICATORS)
def _clean_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """First tick of each day, cleaned, with indicators."""
    first = dedupe_first(ticks_lineitem(spark, folder), KEY, "ts", ARRIVAL)
    clean = iqr_filter(stored(first.select("series", "ts", "selling_price", "buying_price", "spread")), KEY)
    return rounded(add_indicators(clean, KEY, blocks=None), PLACES)


_FILLED = ", ".join(
    f"coalesce({c}, last_value({c} IGNORE NULLS) OVER past, first_value({c} IGNORE NULLS) OVER ahead) AS {c}" for c in FEATURES
)
_RANGED = minmax_columns(FEATURES)


def _scaled(c: str) -> str:
    if c in _RANGED:
        value = f"({c} - min({c}) OVER s) / (max({c}) OVER s - min({c}) OVER s)"
    else:
        value = f"({c} - avg({c}) OVER s) / stddev_pop({c}) OVER s"
    return f"CASE WHEN min({c}) OVER s = max({c}) OVER s THEN 0 ELSE {value} END AS {c}"


_SCALED = ", ".join(_scaled(c) for c in FEATURES)


def _prepared_sql(source: str) -> str:
    return f"""{indicators_sql(source)},
filled AS (SELECT * FROM (SELECT series, ts, {_FILLED} FROM features
  WINDOW past AS (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY series ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in FEATURES)}),
scaled AS (SELECT series, ts, {_SCALED} FROM filled WINDOW s AS (PARTITION BY series))"""


@query("scaled_features", _prepared_sql(_CLEAN) + f"SELECT {rounding({6: FEATURES}, _ALL)} FROM scaled")
def _scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks to scaled features, end to end."""
    prepared = prepare(ticks_lineitem(spark, folder), KEY, "ts", ARRIVAL, block_rows=None)
    return rounded(prepared.scaled, {6: FEATURES})


@query("scaled_features_blocks", _prepared_sql(_iqr_sql(TICKS_EVENTS, "series, ts, selling_price, buying_price, spread")) + f"SELECT {rounding({6: FEATURES}, _ALL)} FROM scaled")
def _scaled_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same over long tick series, in blocks throughout."""
    return rounded(prepare(ticks_events(spark, folder), KEY, block_rows=BLOCK).scaled, {6: FEATURES})


_SMA = ["sma_10", "sma_20", "sma_50"]


@query(
    "moving_averages",
    rounded_sql(
        f"""SELECT series, ts, {", ".join(f"CASE WHEN count(*) OVER w{n} = {n} THEN avg(selling_price) OVER w{n} END AS sma_{n}" for n in (10, 20, 50))}
            FROM ({PRICES_ORDERS}) WINDOW {", ".join(f"w{n} AS (PARTITION BY series ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (10, 20, 50))}""",
        {4: _SMA},
        ["series", "ts", *_SMA],
    ),
)
def _sma(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(moving_averages(prices_orders(spark, folder), KEY, "ts", "selling_price", blocks=None).drop("selling_price"), {4: _SMA})


_STEPS = (1, 5, 10, 20)
_CHANGES = [f"change_{k}" for k in _STEPS]


def _changes_sql(source: str) -> str:
    made = ", ".join(f"selling_price / nullif(lag(selling_price, {k}) OVER w, 0) - 1 AS change_{k}" for k in _STEPS)
    return f"""SELECT {rounding({6: _CHANGES}, ["series", "ts", *_CHANGES])} FROM
        (SELECT series, ts, {made} FROM ({source}) WINDOW w AS (PARTITION BY series ORDER BY ts))"""


@query("price_changes", _changes_sql(TICKS_EVENTS))
def _changes(spark: SparkSession, folder: str) -> DataFrame:
    made = price_changes(ticks_events(spark, folder), KEY, "ts", "selling_price", _STEPS, BLOCK)
    return rounded(made.select("series", "ts", *_CHANGES), {6: _CHANGES})


_LAGS = (1, 2, 3, 5, 10)


@query(
    "lag_features",
    f"""SELECT series, ts, {", ".join(f"lag(selling_price, {k}) OVER w AS price_lag_{k}" for k in _LAGS)}
        FROM ({TICKS_EVENTS}) WINDOW w AS (PARTITION BY series ORDER BY ts)""",
)
def _lags(spark: SparkSession, folder: str) -> DataFrame:
    made = lag_features(ticks_events(spark, folder), KEY, "ts", "selling_price", _LAGS, "price", BLOCK)
    return made.select("series", "ts", *[f"price_lag_{k}" for k in _LAGS])


_BANDS = ["bb_upper", "bb_lower", "bb_position"]


@query(
    "bollinger",
    rounded_sql(
        f"""SELECT series, ts, m + 1.5 * s AS bb_upper, m - 1.5 * s AS bb_lower,
                   (selling_price - (m - 1.5 * s)) / nullif((m + 1.5 * s) - (m - 1.5 * s), 0) AS bb_position
            FROM (SELECT series, ts, selling_price, CASE WHEN count(*) OVER w = 30 THEN avg(selling_price) OVER w END AS m,
                         CASE WHEN count(*) OVER w = 30 THEN stddev_samp(selling_price) OVER w END AS s
                  FROM ({TICKS_EVENTS}) WINDOW w AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))""",
        {4: _BANDS[:2], 6: _BANDS[2:]},
        ["series", "ts", *_BANDS],
    ),
)
def _bollinger(spark: SparkSession, folder: str) -> DataFrame:
    made = bollinger(ticks_events(spark, folder), KEY, "ts", "selling_price", 30, 1.5, BLOCK)
    return rounded(made.select("series", "ts", *_BANDS), {4: _BANDS[:2], 6: _BANDS[2:]})


@query(
    "rsi",
    f"""WITH d AS (SELECT series, ts, selling_price - lag(selling_price) OVER w AS d FROM ({TICKS_EVENTS}) WINDOW w AS (PARTITION BY series ORDER BY ts)),
        g AS (SELECT series, ts, avg(greatest(coalesce(d, 0), 0)) OVER w AS up, avg(greatest(coalesce(-d, 0), 0)) OVER w AS down, count(*) OVER w AS n
              FROM d WINDOW w AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 20 PRECEDING AND CURRENT ROW))
        SELECT series, ts, {sql_round("CASE WHEN n < 21 THEN NULL WHEN down > 0 THEN 100 - 100 / (1 + up / down) WHEN up > 0 THEN 100 END", 6, "rsi")} FROM g""",
)
def _rsi(spark: SparkSession, folder: str) -> DataFrame:
    made = rsi_sma(ticks_events(spark, folder), KEY, "ts", "selling_price", 21, BLOCK)
    return rounded(made.select("series", "ts", "rsi"), {6: ["rsi"]})


def _ema_sql(name: str, source: str, column: str, n: int) -> str:
    """Recursive tables `name`: the recurrence itself, row by row."""
    a = f"(2 / CAST({n + 1} AS DOUBLE))"
    return f"""{name} AS (SELECT series, i, {column} AS e FROM {source} WHERE i = 1
  UNION ALL SELECT s.series, s.i, {a} * s.{column} + (1 - {a}) * r.e FROM {name} r JOIN {source} s ON s.series = r.series AND s.i = r.i + 1)"""


def _numbered(source: str) -> str:
    return f"x AS MATERIALIZED (SELECT series, ts, selling_price, row_number() OVER (PARTITION BY series ORDER BY ts) AS i FROM ({source}))"


@query(
    "ema",
    f"""WITH RECURSIVE {_numbered(PRICES_ORDERS)}, {_ema_sql("e12", "x", "selling_price", 12)}, {_ema_sql("e26", "x", "selling_price", 26)}
        SELECT x.series, x.ts, {sql_round("e12.e", 4, "ema_12")}, {sql_round("e26.e", 4, "ema_26")}
        FROM x JOIN e12 USING (series, i) JOIN e26 USING (series, i)""",
)
def _ema(spark: SparkSession, folder: str) -> DataFrame:
    made = ema(prices_orders(spark, folder), KEY, "ts", "selling_price", blocks=None)
    return rounded(made.drop("selling_price"), {4: ["ema_12", "ema_26"]})


# Every seventh price is unknown, and the first five.
_GAPS = "CASE WHEN i > 5 AND i % 7 <> 0 THEN selling_price END"


def _gaps_sql(source: str) -> str:
    return f"""WITH RECURSIVE g AS MATERIALIZED (SELECT series, ts, {_GAPS} AS selling_price FROM
          (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) AS i FROM ({source}))),
        {_numbered("SELECT * FROM g WHERE selling_price IS NOT NULL")}, {_ema_sql("e12", "x", "selling_price", 12)}, {_ema_sql("e26", "x", "selling_price", 26)},
        m AS MATERIALIZED (SELECT series, i, e12.e - e26.e AS macd FROM e12 JOIN e26 USING (series, i)), {_ema_sql("s9", "m", "macd", 9)}
        SELECT g.series, g.ts, {sql_round("e12.e", 4, "ema_12")}, {sql_round("macd", 4, "macd")}, {sql_round("s9.e", 4, "macd_signal")}
        FROM g LEFT JOIN x USING (series, ts) LEFT JOIN e12 USING (series, i) LEFT JOIN m USING (series, i) LEFT JOIN s9 USING (series, i)"""


def _with_gaps(prices: DataFrame, blocks: int | None) -> DataFrame:
    gaps = row_numbers(prices.select("series", "ts", "selling_price"), KEY, "ts", "i", blocks)
    known = F.when((F.col("i") + 1 > 5) & ((F.col("i") + 1) % 7 != 0), F.col("selling_price"))
    gaps = stored(gaps.select("series", "ts", known.alias("selling_price")))
    made = ema(macd(gaps, KEY, "ts", "selling_price", blocks=blocks), KEY, "ts", "selling_price", (12,), blocks)
    places = ["ema_12", "macd", "macd_signal"]
    return rounded(made.select("series", "ts", *places), {4: places})


@query("averages_with_gaps", _gaps_sql(PRICES_LINEITEM))
def _gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Averages of a series with unknown prices, also at its start."""
    return _with_gaps(prices_lineitem(spark, folder), None)


@query("averages_with_gaps_blocks", _gaps_sql(TICKS_EVENTS))
def _gaps_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return _with_gaps(ticks_events(spark, folder), BLOCK)


_MACD = ["macd", "macd_signal", "macd_histogram"]


def _macd_sql(source: str) -> str:
    return f"""WITH RECURSIVE {_numbered(source)}, {_ema_sql("e12", "x", "selling_price", 12)}, {_ema_sql("e26", "x", "selling_price", 26)},
        m AS MATERIALIZED (SELECT series, i, e12.e - e26.e AS macd FROM e12 JOIN e26 USING (series, i)), {_ema_sql("s9", "m", "macd", 9)}
        SELECT x.series, x.ts, {sql_round("macd", 4, "macd")}, {sql_round("s9.e", 4, "macd_signal")},
               {sql_round("macd - s9.e", 4, "macd_histogram")}
        FROM x JOIN m USING (series, i) JOIN s9 USING (series, i)"""


@query("macd", _macd_sql(PRICES_LINEITEM))
def _macd(spark: SparkSession, folder: str) -> DataFrame:
    made = macd(prices_lineitem(spark, folder), KEY, "ts", "selling_price", blocks=None)
    return rounded(made.select("series", "ts", *_MACD), {4: _MACD})


@query("macd_blocks", _macd_sql(TICKS_EVENTS))
def _macd_blocks(spark: SparkSession, folder: str) -> DataFrame:
    made = macd(ticks_events(spark, folder), KEY, "ts", "selling_price", blocks=BLOCK)
    return rounded(made.select("series", "ts", *_MACD), {4: _MACD})


_PANEL = ["price", "ma_short", "ma_long", "rsi", "bb_upper", "bb_lower"]


@query(
    "indicator_panel",
    indicators_sql(PRICES_LINEITEM)
    + f"""SELECT {rounding({4: _PANEL[1:3] + _PANEL[4:], 6: ["rsi"]}, ["series", "ts", *_PANEL, "rsi_state"])} FROM
        (SELECT *, selling_price AS price, CASE WHEN rsi > 70 THEN 'overbought' WHEN rsi < 30 THEN 'oversold' WHEN rsi IS NOT NULL THEN 'neutral' END AS rsi_state FROM features)""",
)
def _panel(spark: SparkSession, folder: str) -> DataFrame:
    panel = indicator_panel(add_indicators(prices_lineitem(spark, folder), KEY, blocks=None), KEY)
    return rounded(panel, {4: _PANEL[1:3] + _PANEL[4:], 6: ["rsi"]})


@query(
    "recent_indicators",
    indicators_sql(PRICES_LINEITEM) + f"SELECT {_select(PLACES, _ALL)} FROM features WHERE ts >= TIMESTAMP '2001-01-01'",
)
def _recent(spark: SparkSession, folder: str) -> DataFrame:
    """Indicators of one year, from that year's rows and the rows just before it."""
    prices = with_lookback(prices_lineitem(spark, folder), KEY, "ts", "2001-01-01")
    made = add_indicators(prices, KEY, blocks=None).filter(F.col("ts") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return rounded(made, PLACES)


_FIT = ["selling_price", "buying_price", "spread", "ratio"]


def _with_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("ratio", F.col("buying_price") / F.col("selling_price"))


@query(
    "fit_scaler",
    f"""WITH p AS (SELECT *, buying_price / selling_price AS ratio FROM ({TICKS_LINEITEM}))
        SELECT series, feature, method, {sql_round("center", 4, "center")}, {sql_round("scale", 4, "scale")} FROM (
        {" UNION ALL ".join(f"SELECT series, '{c}' AS feature, 'minmax' AS method, min({c}) AS center, max({c}) - min({c}) AS scale FROM p GROUP BY series" for c in _FIT[:3])}
        UNION ALL SELECT series, 'ratio', 'zscore', avg(ratio), stddev_pop(ratio) FROM p GROUP BY series)""",
)
def _fit(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(fit_scaler(_with_ratio(ticks_lineitem(spark, folder)), KEY, _FIT), {4: ["center", "scale"]})


def _scaled_sql(over: str) -> str:
    made = ", ".join(
        [f"(({c} - min({c}) OVER s) / nullif(max({c}) OVER s - min({c}) OVER s, 0)) AS {c}" for c in _FIT[:3]]
        + ["(ratio - avg(ratio) OVER s) / nullif(stddev_pop(ratio) OVER s, 0) AS ratio"]
    )
    return f"""SELECT {rounding({6: _FIT}, ["series", "ts", *_FIT])} FROM (SELECT series, ts, {made} FROM
        (SELECT *, buying_price / selling_price AS ratio FROM ({PRICES_LINEITEM})) WINDOW s AS ({over}))"""


@query("apply_scaler", _scaled_sql("PARTITION BY series"))
def _apply(spark: SparkSession, folder: str) -> DataFrame:
    prices = _with_ratio(prices_lineitem(spark, folder))
    return rounded(apply_scaler(prices, fit_scaler(prices, KEY, _FIT), _FIT), {6: _FIT})


@query("apply_scaler_global", _scaled_sql(""))
def _apply_global(spark: SparkSession, folder: str) -> DataFrame:
    """One scaler for all series."""
    prices = _with_ratio(prices_lineitem(spark, folder))
    return rounded(apply_scaler(prices, fit_scaler(prices, KEY, _FIT, scope="global"), _FIT), {6: _FIT})


@query("inverse_price", f"SELECT {rounding({4: ['selling_price']}, ['series', 'ts', 'selling_price'])} FROM ({TICKS_LINEITEM})")
def _inverse(spark: SparkSession, folder: str) -> DataFrame:
    ticks = ticks_lineitem(spark, folder).select("series", "ts", "selling_price")
    scaler = stored(fit_scaler(ticks, KEY, ["selling_price"]))
    scaled = apply_scaler(ticks, scaler, ["selling_price"])
    return rounded(inverse_price(scaled, "selling_price", scaler), {4: ["selling_price"]})


@query(
    "scaler_of_some_series",
    f"""WITH t AS (SELECT series, ts, selling_price AS x FROM ({PRICES_LINEITEM})), s AS (SELECT series, avg(x) AS m, stddev_pop(x) AS d FROM t WHERE series <> 'N' GROUP BY series)
        SELECT series, ts, {sql_round("CASE WHEN m IS NULL THEN x ELSE (x - m) / d END", 4, "scaled")}, {sql_round("x", 4, "back")} FROM t LEFT JOIN s USING (series)""",
)
def _some_series(spark: SparkSession, folder: str) -> DataFrame:
    """A scaler fitted on some series and applied to all: rows of the others stay, unscaled."""
    prices = prices_lineitem(spark, folder).select("series", "ts", "selling_price")
    scaler = stored(fit_scaler(prices.filter("series <> 'N'"), KEY, ["selling_price"], "zscore"))
    scaled = apply_scaler(prices, scaler, ["selling_price"])
    both = scaled.withColumn("scaled", F.col("selling_price"))
    back = inverse_price(both, "selling_price", scaler).withColumnRenamed("selling_price", "back")
    return rounded(back.select("series", "ts", "scaled", "back"), {4: ["scaled", "back"]})


def _method_sql(method: str, where: str) -> str:
    center, scale = {"minmax": ("min(x)", "max(x) - min(x)"), "zscore": ("avg(x)", "stddev_pop(x)")}[method]
    parts = " UNION ALL ".join(f"SELECT series, '{c}' AS feature, {c} AS x, split FROM p" for c in _FIT[:3])
    return f"""WITH p AS (SELECT t.*, s.split FROM ({PRICES_LINEITEM}) t JOIN ({_split_sql(PRICES_LINEITEM)}) s USING (series, ts))
        SELECT series, feature, '{method}' AS method, {sql_round(center, 4, "center")}, {sql_round(scale, 4, "scale")} FROM ({parts}) WHERE {where} GROUP BY series, feature"""


def _split_sql(source: str) -> str:
    return f"""SELECT series, ts, i AS seq_no,
        CASE WHEN i < n - CAST(floor(n * CAST(0.1 AS DOUBLE)) AS BIGINT) - CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT) THEN 'train'
             WHEN i < n - CAST(floor(n * CAST(0.1 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split
        FROM (SELECT series, ts, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM ({source}))"""


def _fit_by(method: str, fit_on: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        split = chronological_split(prices_lineitem(spark, folder), KEY, "ts", blocks=None)
        return rounded(fit_scaler(split, KEY, _FIT[:3], method, fit_on=fit_on), {4: ["center", "scale"]})

    return run


query("fit_scaler_minmax", _method_sql("minmax", "true"))(_fit_by("minmax", "all"))
query("fit_scaler_zscore", _method_sql("zscore", "true"))(_fit_by("zscore", "all"))
query("fit_scaler_train_only", _method_sql("zscore", "split = 'train'"))(_fit_by("zscore", "train"))

_SEQ = ("selling_price", "buying_price", "spread")


def _sequences_sql(source: str, length: int) -> str:
    x = f"flatten(list([{', '.join(_SEQ)}]) OVER w)"
    return f"""SELECT series, target_ts, len(x) AS x_size, x[1] AS x_first, x[len(x)] AS x_last, {sql_round("list_sum(x)", 4, "x_sum")}, y
        FROM (SELECT series, ts AS target_ts, {x} AS x, selling_price AS y, count(*) OVER w AS n FROM ({source})
              WINDOW w AS (PARTITION BY series ORDER BY ts ROWS BETWEEN {length} PRECEDING AND 1 PRECEDING)) WHERE n = {length}"""


def _described(sequences: DataFrame) -> DataFrame:
    others = [c for c in sequences.columns if c != "x"]
    made = sequences.select(
        *others,
        F.size("x").cast("long").alias("x_size"),
        F.element_at("x", 1).alias("x_first"),
        F.element_at("x", -1).alias("x_last"),
        F.aggregate("x", F.lit(0.0), lambda a, v: a + v).alias("x_sum"),
    )
    return rounded(made, {4: ["x_sum"]})


@query("make_sequences", _sequences_sql(PRICES_LINEITEM, 60))
def _sequences(spark: SparkSession, folder: str) -> DataFrame:
    return _described(make_sequences(prices_lineitem(spark, folder), KEY, "ts", _SEQ, "selling_price", 60, None))


@query("make_sequences_blocks", _sequences_sql(TICKS_EVENTS, 20))
def _sequences_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return _described(make_sequences(ticks_events(spark, folder), KEY, "ts", _SEQ, "selling_price", 20, BLOCK))


@query("chronological_split", _split_sql(TICKS_EVENTS))
def _split(spark: SparkSession, folder: str) -> DataFrame:
    return chronological_split(ticks_events(spark, folder).select("series", "ts"), KEY, "ts", blocks=BLOCK)


@query(
    "holdout_split",
    f"""SELECT series, ts, i AS seq_no, CASE WHEN i < floor(n * (CAST(1 AS DOUBLE) - CAST(0.2 AS DOUBLE))) THEN 'train' ELSE 'val' END AS split
        FROM (SELECT series, ts, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM ({TICKS_EVENTS}))""",
)
def _holdout(spark: SparkSession, folder: str) -> DataFrame:
    return holdout_split(ticks_events(spark, folder).select("series", "ts"), KEY, "ts", blocks=BLOCK)


@query("concat_splits", f"SELECT * FROM ({_split_sql(PRICES_ORDERS)}) WHERE split IN ('train', 'val')")
def _concat(spark: SparkSession, folder: str) -> DataFrame:
    return concat_splits(chronological_split(prices_orders(spark, folder).select("series", "ts"), KEY, "ts", blocks=None))


@query(
    "latest_window",
    f"""SELECT series, max(ts) AS last_ts, 3 * count(*) AS x_size, arg_min(selling_price, ts) AS x_first, arg_max(spread, ts) AS x_last,
               {sql_round("sum(selling_price + buying_price + spread)", 4, "x_sum")}
        FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts DESC) AS i FROM ({TICKS_EVENTS})) WHERE i <= 60 GROUP BY series""",
)
def _latest(spark: SparkSession, folder: str) -> DataFrame:
    windows, _ = latest_window(ticks_events(spark, folder), KEY, "ts", _SEQ, 60)
    return _described(windows)
