"""The forecaster with one hidden unit, two features and short windows: small enough for SQL.

One unit makes the readout a straight line, so every step from encoding to the forecast
of a loaded model is checked by value, over all series and rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.recurrent import EncoderSpec, layer_weights
from tidemark.operators.forecasting import (
    SHARES,
    Forecaster,
    Sweep,
    Trial,
    encode_series,
    fit_forecaster,
    forecast,
    predict,
    sweep,
)
from tidemark.operators.reporting import best_model, run_summary
from tidemark.operators.scaling import apply_scaler, fit_scaler
from tidemark.operators.sequences import chronological_split, latest_window
from tidemark.plans.catalog.cleaning import KEY
from tidemark.plans.catalog.registry import query, rounded, rounding, sql_round
from tidemark.plans.views import PRICES_LINEITEM, prices_lineitem
from tidemark.session import new_folder, stored
from tidemark.sources.models import latest_model, load_model, save_model

TWO = ["selling_price", "spread"]
LENGTH, HORIZON = 5, 3
SPEC = EncoderSpec(1, 1, 3)
TRIALS = [Trial(f"seed_{s}", EncoderSpec(1, 1, s), 0.0) for s in (3, 5, 8)]


def _encode_sql(window: str, spec: EncoderSpec) -> str:
    """The hidden state after a list of (p, s, h, c) rows, as one expression."""
    inputs, recurrent = layer_weights(spec, len(TWO))[0]
    forget, take, candidate, out = (
        f"({float(inputs[0, g])!r} * b.p + {float(inputs[1, g])!r} * b.s + {float(recurrent[0, g])!r} * a.h)" for g in range(4)
    )
    sigmoid = lambda z: f"(1 / (1 + exp(-{z})))"
    cell = f"({sigmoid(forget)} * a.c + {sigmoid(take)} * tanh{candidate})"
    step = f"{{'p': b.p, 's': b.s, 'h': {sigmoid(out)} * tanh({cell}), 'c': {cell}}}"
    return f"list_reduce(list_prepend({_row('0.0::DOUBLE', '0.0::DOUBLE')}, {window}), lambda a, b: {step}).h"


def _row(p: str, s: str) -> str:
    return f"{{'p': {p}, 's': {s}, 'h': 0.0::DOUBLE, 'c': 0.0::DOUBLE}}"


def _split(of: str) -> str:
    test, val = (f"CAST(floor({of} * CAST({share} AS DOUBLE)) AS BIGINT)" for share in (0.1, 0.2))
    return f"CASE WHEN i < {of} - {test} - {val} THEN 'train' WHEN i < {of} - {test} THEN 'val' ELSE 'test' END"


_SCALED = f"""prices AS MATERIALIZED ({PRICES_LINEITEM}),
ranges AS (SELECT series, min(selling_price) AS lo, max(selling_price) - min(selling_price) AS span, min(spread) AS s_lo, max(spread) - min(spread) AS s_span FROM prices GROUP BY series),
scaled AS MATERIALIZED (SELECT series, ts, (selling_price - lo) / span AS p, (spread - s_lo) / s_span AS s,
    row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM prices JOIN ranges USING (series)),
framed AS MATERIALIZED (SELECT * FROM (SELECT series, ts AS target_ts, i AS row_no, n AS n_rows, p AS y, list({_row('p', 's')}) OVER w AS x, count(*) OVER w AS k FROM scaled
    WINDOW w AS (PARTITION BY series ORDER BY ts ROWS BETWEEN {LENGTH} PRECEDING AND 1 PRECEDING)) WHERE k = {LENGTH})"""

_FITTED = f"""{_SCALED},
encoded AS MATERIALIZED (SELECT series, target_ts, y, {_encode_sql('x', SPEC)} AS h, row_number() OVER (PARTITION BY series ORDER BY target_ts) - 1 AS i,
    count(*) OVER (PARTITION BY series) AS n FROM framed),
parted AS MATERIALIZED (SELECT *, {_split('n')} AS split FROM encoded),
line AS MATERIALIZED (SELECT regr_slope(y, h) AS slope, regr_intercept(y, h) AS level FROM parted WHERE split <> 'test')"""


def _scaled(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    prices = stored(prices_lineitem(spark, folder))
    scaler = stored(fit_scaler(prices, KEY, TWO, "minmax"))
    return stored(apply_scaler(prices, scaler, TWO)), scaler


def _fitted(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, Forecaster]:
    scaled, scaler = _scaled(spark, folder)
    encoded = stored(encode_series(scaled, KEY, "ts", SPEC, TWO, "selling_price", LENGTH, None))
    split = stored(chronological_split(encoded, KEY, blocks=None))
    return scaled, split, fit_forecaster(split.filter("split <> 'test'"), SPEC, scaler, 0.0, TWO, LENGTH)


@query("small_encoding", f"WITH {_FITTED} SELECT series, target_ts, {sql_round('h', 6, 'h')} FROM encoded")
def _small_encoding(spark: SparkSession, folder: str) -> DataFrame:
    encoded = encode_series(_scaled(spark, folder)[0], KEY, "ts", SPEC, TWO, "selling_price", LENGTH, None)
    return rounded(encoded.select("series", "target_ts", F.element_at("h", 1).alias("h")), {6: ["h"]})


@query("small_fit", f"WITH {_FITTED} SELECT {sql_round('slope', 6, 'slope')}, {sql_round('level', 6, 'level')} FROM line")
def _small_fit(spark: SparkSession, folder: str) -> DataFrame:
    """The readout, as shown by the predictions for encodings of 0 and 1."""
    _, split, forecaster = _fitted(spark, folder)
    probes = split.limit(1).select(F.lit(None).cast("timestamp_ntz").alias("target_ts"), F.lit(0.0).alias("y"), F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("v"))
    forecaster.scaler = None
    at = predict(probes.withColumn("h", F.array("v")), forecaster, []).select("y_pred")
    ends = at.agg(F.sort_array(F.collect_list("y_pred")).alias("e"))
    rising = float(forecaster.readout.coefficients[0]) >= 0
    first, second = ("e[0]", "e[1]") if rising else ("e[1]", "e[0]")
    return rounded(ends.selectExpr(f"{second} - {first} AS slope", f"{first} AS level"), {6: ["slope", "level"]})


@query(
    "small_predictions",
    f"""WITH {_FITTED} SELECT 'lstm' AS model, series, target_ts AS ts, {sql_round('y * span + lo', 2, 'y_true')}, {sql_round('(slope * h + level) * span + lo', 2, 'y_pred')}
        FROM parted JOIN ranges USING (series), line WHERE split = 'test'""",
)
def _small_predictions(spark: SparkSession, folder: str) -> DataFrame:
    _, split, forecaster = _fitted(spark, folder)
    return rounded(predict(split.filter("split = 'test'"), forecaster, KEY), {2: ["y_true", "y_pred"]})


_FORECAST = f"""WITH RECURSIVE {_FITTED},
        latest AS (SELECT series, max(ts) AS last_ts, list({_row('p', 's')} ORDER BY ts) AS x FROM scaled WHERE i >= n - {LENGTH} GROUP BY series),
        ahead AS (SELECT series, last_ts, 0 AS step, x, 0.0::DOUBLE AS z FROM latest
          UNION ALL SELECT series, last_ts, step + 1, list_append(x[2:], {_row('z', f'x[{LENGTH}].s')}), z
          FROM (SELECT a.series, a.last_ts, a.step, a.x, l.slope * {_encode_sql('a.x', SPEC)} + l.level AS z FROM ahead a, line l WHERE a.step < {HORIZON}))
        SELECT series, CAST(step AS INTEGER) AS step, last_ts + to_days(CAST(step AS INTEGER)) AS ts, {sql_round('z * span + lo', 2, 'y_pred')}
        FROM ahead JOIN ranges USING (series) WHERE step > 0"""


@query("small_forecast", _FORECAST)
def _small_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """A model saved, found and loaded again, forecasting from each series' last rows."""
    scaled, _, forecaster = _fitted(spark, folder)
    models = new_folder(spark, "models")
    save_model(spark, forecaster, f"{models}/small")
    return _forecast_of_latest(spark, scaled, models)


def _forecast_of_latest(spark: SparkSession, scaled: DataFrame, models: str) -> DataFrame:
    loaded = load_model(spark, latest_model(spark, models))
    windows, _ = latest_window(scaled, KEY, "ts", TWO, LENGTH)
    return rounded(forecast(windows, loaded, KEY, HORIZON), {2: ["y_pred"]})


@query("published_forecast", _FORECAST)
def _published_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """A model saved over an older one, then a third save that breaks off: the second is the one that is loaded."""
    scaled, split, forecaster = _fitted(spark, folder)
    other = fit_forecaster(split.filter("split = 'val'"), SPEC, forecaster.scaler, 10.0, TWO, LENGTH)
    models = new_folder(spark, "models")
    save_model(spark, other, f"{models}/small")
    save_model(spark, forecaster, f"{models}/small")
    other.readout.write().save(f"{models}/small/versions/broken-off/readout")
    return _forecast_of_latest(spark, scaled, models)


_TRIED = f"""{_SCALED},
tried AS MATERIALIZED ({" UNION ALL ".join(f"SELECT '{t.name}' AS trial, series, y, row_no AS i, n_rows AS n, {_encode_sql('x', t.spec)} AS h FROM framed" for t in TRIALS)}),
lasts AS (SELECT series, max(i) AS last FROM (SELECT series, i, {_split('n')} AS split FROM scaled) WHERE split = 'train' GROUP BY series),
parted AS MATERIALIZED (SELECT *, {_split('n')} AS split, i / last AS share FROM tried JOIN lasts USING (series)),
lines AS MATERIALIZED ({" UNION ALL ".join(f"SELECT trial, {k} AS step, regr_slope(y, h) AS slope, regr_intercept(y, h) AS level, CAST({s} AS DOUBLE) AS upto FROM parted WHERE split = 'train' AND share <= CAST({s} AS DOUBLE) GROUP BY trial" for k, s in enumerate(SHARES, 1))}),
history AS (SELECT trial AS run_id, step, avg((y - slope * h - level) ** 2) FILTER (split = 'train' AND share <= upto) AS train_loss,
    avg((y - slope * h - level) ** 2) FILTER (split = 'val') AS val_loss FROM parted JOIN lines USING (trial) GROUP BY trial, step),
scored AS (SELECT trial AS model, y * span + lo AS y_true, y * span + lo - ((slope * h + level) * span + lo) AS e
    FROM parted JOIN lines USING (trial) JOIN ranges USING (series) WHERE split = 'val' AND step = {len(SHARES)}),
board AS (SELECT model, count(*) AS n, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 100 * avg(abs(e / y_true)) AS mape, 1 - avg(e * e) / var_pop(y_true) AS r2 FROM scored GROUP BY model)"""
_SCORES = {2: ["mae", "rmse"], 4: ["mape", "r2"]}
_LOSSES = {8: ["best_train_loss", "best_val_loss", "final_train_loss", "final_val_loss"]}


def _tried(spark: SparkSession, folder: str) -> Sweep:
    scaled, scaler = _scaled(spark, folder)
    return sweep(stored(chronological_split(scaled, KEY, "ts", blocks=None)), KEY, TRIALS, scaler, TWO, LENGTH, None)


@query("small_leaderboard", f"WITH {_TRIED} SELECT {rounding(_SCORES, ['model', 'n', 'mae', 'rmse', 'mape', 'r2'])} FROM board")
def _small_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_tried(spark, folder).leaderboard, _SCORES)


@query("small_best_trial", f"WITH {_TRIED} SELECT {rounding(_SCORES, ['model', 'n', 'mae', 'rmse', 'mape', 'r2'])} FROM board b ORDER BY b.r2 DESC, b.model LIMIT 1")
def _small_best(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(best_model(_tried(spark, folder).leaderboard), _SCORES)


@query(
    "small_run_summary",
    f"""WITH {_TRIED} SELECT {rounding(_LOSSES, ['run_id', 'total_steps', *_LOSSES[8]])} FROM (
        SELECT run_id, count(*) AS total_steps, min(train_loss) AS best_train_loss, min(val_loss) AS best_val_loss,
               arg_max(train_loss, step) AS final_train_loss, arg_max(val_loss, step) AS final_val_loss FROM history GROUP BY run_id)""",
)
def _small_runs(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(run_summary(_tried(spark, folder).history), _LOSSES)


# Two layers of two units, and two ridge penalties that share their encodings.
STACKED = EncoderSpec(2, 2, 7)
PENALTIES = {"weak": 0.01, "strong": 0.5}


def _let(name: str, value: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _stacked_row(p: str, s: str, spec: EncoderSpec) -> str:
    zeros = "".join(f", '{x}{layer}{u}': 0.0::DOUBLE" for layer in range(spec.layers) for u in range(spec.hidden) for x in "hc")
    return f"{{'p': {p}, 's': {s}{zeros}}}"


def _stacked_sql(window: str, spec: EncoderSpec) -> str:
    """The last row's states after a list of rows, layer by layer and gate by gate."""
    units, weights = range(spec.hidden), layer_weights(spec, len(TWO))
    sigmoid = lambda z: f"(1 / (1 + exp(-({z}))))"

    def layer(k: int, given: list[str]) -> str:
        if k == spec.layers:
            states = "".join(f", 'h{i}{u}': y{i}.h{u}, 'c{i}{u}': y{i}.c{u}" for i in range(spec.layers) for u in units)
            return f"{{'p': b.p, 's': b.s{states}}}"
        inputs, recurrent = weights[k]

        def gate(g: int, u: int) -> str:
            at = g * spec.hidden + u
            return " + ".join([*[f"{float(inputs[i, at])!r} * {x}" for i, x in enumerate(given)], *[f"{float(recurrent[v, at])!r} * a.h{k}{v}" for v in units]])

        cells = ", ".join(f"'c{u}': {sigmoid(gate(0, u))} * a.c{k}{u} + {sigmoid(gate(1, u))} * tanh({gate(2, u)}), 'o{u}': {sigmoid(gate(3, u))}" for u in units)
        outs = ", ".join(f"'c{u}': x{k}.c{u}, 'h{u}': x{k}.o{u} * tanh(x{k}.c{u})" for u in units)
        return _let(f"x{k}", f"{{{cells}}}", _let(f"y{k}", f"{{{outs}}}", layer(k + 1, [f"y{k}.h{u}" for u in units])))

    start = _stacked_row("0.0::DOUBLE", "0.0::DOUBLE", spec)
    return f"list_reduce(list_prepend({start}, {window}), lambda a, b: {layer(0, ['b.p', 'b.s'])})"


_STACKED = f"""prices AS MATERIALIZED ({PRICES_LINEITEM}),
ranges AS (SELECT series, min(selling_price) AS lo, max(selling_price) - min(selling_price) AS span, min(spread) AS s_lo, max(spread) - min(spread) AS s_span FROM prices GROUP BY series),
scaled AS MATERIALIZED (SELECT series, ts, (selling_price - lo) / span AS p, (spread - s_lo) / s_span AS s,
    row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM prices JOIN ranges USING (series)),
framed AS MATERIALIZED (SELECT * FROM (SELECT series, ts AS target_ts, i, n, p AS y, list({_stacked_row('p', 's', STACKED)}) OVER w AS x, count(*) OVER w AS k FROM scaled
    WINDOW w AS (PARTITION BY series ORDER BY ts ROWS BETWEEN {LENGTH} PRECEDING AND 1 PRECEDING)) WHERE k = {LENGTH}),
encoded AS MATERIALIZED (SELECT series, target_ts, i, n, y, e.h10 AS h0, e.h11 AS h1 FROM (SELECT *, {_stacked_sql('x', STACKED)} AS e FROM framed)),
lasts AS (SELECT series, max(i) AS last FROM (SELECT series, i, {_split('n')} AS split FROM scaled) WHERE split = 'train' GROUP BY series),
parted AS MATERIALIZED (SELECT *, {_split('n')} AS split, i / last AS share FROM encoded JOIN lasts USING (series)),
moments AS ({" UNION ALL ".join(f"SELECT {k} AS step, CAST({s} AS DOUBLE) AS upto, avg(y) AS my, avg(h0) AS m0, avg(h1) AS m1, stddev_pop(y) AS sy, stddev_pop(h0) AS s0, stddev_pop(h1) AS s1, corr(h0, h1) AS r, corr(h0, y) AS r0, corr(h1, y) AS r1 FROM parted WHERE split = 'train' AND share <= CAST({s} AS DOUBLE)" for k, s in enumerate(SHARES, 1))}),
solved AS (SELECT *, sy / s0 * ((1 + z) * r0 - r * r1) / ((1 + z) * (1 + z) - r * r) AS b0, sy / s1 * ((1 + z) * r1 - r * r0) / ((1 + z) * (1 + z) - r * r) AS b1
    FROM (SELECT *, reg / sy AS z FROM moments, (VALUES {", ".join(f"('{n}', CAST({v} AS DOUBLE))" for n, v in PENALTIES.items())}) t(trial, reg))),
lines AS MATERIALIZED (SELECT *, my - b0 * m0 - b1 * m1 AS level FROM solved),
scored AS (SELECT trial AS model, y * span + lo AS y_true, (y - b0 * h0 - b1 * h1 - level) * span AS e
    FROM parted, lines JOIN ranges USING (series) WHERE split = 'val' AND step = {len(SHARES)})""".replace("FROM parted, lines JOIN ranges USING (series)", "FROM parted JOIN ranges USING (series), lines")


@query("stacked_encoding", f"WITH {_STACKED} SELECT series, target_ts, {sql_round('h0', 6, 'h0')}, {sql_round('h1', 6, 'h1')} FROM encoded")
def _stacked_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Two layers of two units, every value of every row."""
    encoded = encode_series(_scaled(spark, folder)[0], KEY, "ts", STACKED, TWO, "selling_price", LENGTH, None)
    return rounded(encoded.select("series", "target_ts", F.element_at("h", 1).alias("h0"), F.element_at("h", 2).alias("h1")), {6: ["h0", "h1"]})


def _ridged(spark: SparkSession, folder: str) -> Sweep:
    scaled, scaler = _scaled(spark, folder)
    trials = [Trial(name, STACKED, reg) for name, reg in PENALTIES.items()]
    return sweep(stored(chronological_split(scaled, KEY, "ts", blocks=None)), KEY, trials, scaler, TWO, LENGTH, None)


@query(
    "stacked_leaderboard",
    f"""WITH {_STACKED} SELECT {rounding(_SCORES, ['model', 'n', 'mae', 'rmse', 'mape', 'r2'])} FROM (
        SELECT model, count(*) AS n, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse, 100 * avg(abs(e / y_true)) AS mape, 1 - avg(e * e) / var_pop(y_true) AS r2 FROM scored GROUP BY model)""",
)
def _stacked_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    """Two coefficients under two ridge penalties, solved from one set of sums."""
    return rounded(_ridged(spark, folder).leaderboard, _SCORES)


_SHARE_LOSSES = {8: ["train_loss", "val_loss"]}


@query(
    "stacked_history",
    f"""WITH {_STACKED} SELECT run_id, step, {sql_round('train_loss', 8, 'train_loss')}, {sql_round('val_loss', 8, 'val_loss')} FROM (
        SELECT trial AS run_id, step, avg((y - b0 * h0 - b1 * h1 - level) ** 2) FILTER (split = 'train' AND share <= upto) AS train_loss,
               avg((y - b0 * h0 - b1 * h1 - level) ** 2) FILTER (split = 'val') AS val_loss FROM parted, lines GROUP BY trial, step)""",
)
def _stacked_history(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_ridged(spark, folder).history.select("run_id", "step", "train_loss", "val_loss"), _SHARE_LOSSES)
