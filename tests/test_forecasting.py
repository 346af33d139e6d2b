import os
import numpy as np
import pytest
from frames import by_time, prices
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.functions.recurrent import EncoderSpec, encode_windows, layer_weights
from tidemark.operators.forecasting import Gram, Trial, encode_sequences, encode_series, fit_forecaster, forecast, gram_sums, predict, sweep
from tidemark.operators.metrics import regression_metrics
from tidemark.operators.reporting import best_model, run_summary
from tidemark.operators.scaling import apply_scaler, fit_scaler, inverse_price
from tidemark.operators.sequences import chronological_split, concat_splits, holdout_split, latest_window, make_sequences
from tidemark.plans.preprocess import fit_and_predict, prepare
from tidemark.sources.models import latest_model, load_model, save_model

KEY = ["series"]
SPEC = EncoderSpec(8, 2, 3)
COLUMNS = ["selling_price", "buying_price", "spread"]


def wave(n, phase=0.0):
    t = np.arange(n)
    return (100 + 10 * np.sin(t / 5 + phase) + np.cos(t / 3)).tolist()


@pytest.fixture(scope="module")
def two(spark):
    a = prices(spark, wave(220), [p * 0.9 for p in wave(220)])
    return a.union(prices(spark, wave(180, 1.0), [p * 0.8 for p in wave(180, 1.0)], series="b")).cache()


def test_constant_column_scales_to_zero(spark):
    df = prices(spark, [7, 7, 7], [1, 2, 3])
    for method in ("minmax", "zscore"):
        scaler = fit_scaler(df, KEY, ["selling_price"], method)
        assert by_time(apply_scaler(df, scaler, ["selling_price"]), "selling_price") == [0.0, 0.0, 0.0]


def test_zscore_uses_the_population_deviation(spark):
    df = prices(spark, [1, 3])
    scaler = fit_scaler(df, KEY, ["selling_price"], "zscore")
    assert by_time(apply_scaler(df, scaler, ["selling_price"]), "selling_price") == [-1.0, 1.0]


def test_scopes_and_inverse(two):
    for scope in ("series", "global"):
        scaler = fit_scaler(two, KEY, COLUMNS, scope=scope)
        scaled = apply_scaler(two, scaler, COLUMNS)
        low, high = scaled.agg(F.min("selling_price"), F.max("selling_price")).first()
        assert (low, high) == (0.0, 1.0)
        back = inverse_price(scaled, "selling_price", scaler)
        assert by_time(back.filter("series = 'a'"), "selling_price") == pytest.approx(wave(220))
    assert inverse_price(two, "selling_price", None) is two


def test_new_data_uses_the_fitted_scaler(spark):
    scaler = fit_scaler(prices(spark, [0, 10]), KEY, ["selling_price"])
    assert by_time(apply_scaler(prices(spark, [5, 20]), scaler, ["selling_price"]), "selling_price") == [0.5, 2.0]


def test_fit_on_train_rows_only(spark):
    df = prices(spark, [1, 3, 100]).withColumn("split", F.when(F.col("selling_price") < 50, "train").otherwise("test"))
    assert fit_scaler(df, KEY, ["selling_price"], fit_on="train").first().scale == 2.0


@pytest.mark.parametrize("n,sizes", [(7, (6, 1, 0)), (100, (70, 20, 10)), (105, (74, 21, 10))])
def test_split_sizes(spark, n, sizes):
    split = chronological_split(prices(spark, range(n)), KEY, "ts", blocks=None)
    found = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert tuple(found.get(s, 0) for s in ("train", "val", "test")) == sizes
    assert concat_splits(split).count() == sizes[0] + sizes[1]
    order = [r.split for r in split.orderBy("ts").collect()]
    assert order == sorted(order, key=["train", "val", "test"].index)
    two_way = holdout_split(prices(spark, range(n)), KEY, "ts", blocks=None)
    assert two_way.filter("split = 'train'").count() == int(n * (1 - 0.2))


def test_sequences_exclude_their_target(spark):
    df = prices(spark, range(1, 11))
    made = make_sequences(df, KEY, features=["selling_price", "spread"], length=4, blocks=None).orderBy("target_ts").collect()
    assert len(made) == 6
    assert made[0].x == [1, 0, 2, 0, 3, 0, 4, 0] and made[0].y == 5.0
    assert make_sequences(df, KEY, features=["spread", "buying_price"], length=10, blocks=None).count() == 0
    other = make_sequences(df, KEY, features=["spread", "buying_price"], length=4, blocks=None)
    assert other.first().y == 0.0  # no selling price among the features: the first one is the target


def gate_by_gate(x, spec):
    """One window, one step, one gate at a time."""
    sequence = list(x)
    for w_in, w_rec in layer_weights(spec, x.shape[1]):
        n = spec.hidden
        h, c, out = np.zeros(n), np.zeros(n), []
        for row in sequence:
            gate = [row @ w_in[:, g * n : (g + 1) * n] + h @ w_rec[:, g * n : (g + 1) * n] for g in range(4)]
            forget, enter, leave = (1 / (1 + np.exp(-gate[g])) for g in (0, 1, 3))
            c = forget * c + enter * np.tanh(gate[2])
            h = leave * np.tanh(c)
            out.append(h)
        sequence = out
    return sequence[-1]


def test_encoder_equals_the_gate_equations():
    x = np.random.default_rng(0).normal(size=(5, 9, 4))
    got = encode_windows(x, SPEC)
    np.testing.assert_allclose(got, [gate_by_gate(w, SPEC) for w in x], rtol=1e-12)


def test_weights_have_the_documented_scale():
    (w_in, w_rec), _ = layer_weights(EncoderSpec(64, 2, 1), 24)
    assert w_in.shape == (24, 256) and w_rec.shape == (64, 256)
    assert np.vstack([w_in, w_rec]).std() == pytest.approx(np.sqrt(2 / 88), rel=0.02)


@pytest.mark.parametrize("blocks", [None, 50])
def test_encoding_in_blocks_equals_encoding_of_sequences(two, blocks):
    direct = encode_series(two, KEY, "ts", SPEC, COLUMNS, length=12, blocks=blocks)
    by_row = encode_sequences(make_sequences(two, KEY, "ts", COLUMNS, length=12, blocks=None), SPEC, 3)
    left = {(r.series, r.target_ts): (r.y, r.h) for r in direct.collect()}
    right = {(r.series, r.target_ts): (r.y, r.h) for r in by_row.collect()}
    assert left.keys() == right.keys() and len(left) == 220 + 180 - 24
    for k, (y, h) in right.items():
        assert left[k][0] == y
        np.testing.assert_allclose(left[k][1], h, rtol=1e-9, atol=1e-12)


@pytest.fixture(scope="module")
def fitted(two):
    scaler = fit_scaler(two, KEY, COLUMNS)
    scaled = apply_scaler(two, scaler, COLUMNS)
    encoded = encode_series(scaled, KEY, "ts", SPEC, COLUMNS, length=12, blocks=None).cache()
    return scaled, encoded, fit_forecaster(encoded, SPEC, scaler, 1e-6, COLUMNS, 12)


def test_readout_is_least_squares(fitted):
    _, encoded, forecaster = fitted
    rows = encoded.collect()
    h, y = np.array([r.h for r in rows]), np.array([r.y for r in rows])
    design = np.column_stack([h, np.ones(len(h))])
    best = np.linalg.lstsq(design, y, rcond=None)[0]
    got = {(r.series, r.target_ts): p for r, p in zip(rows, design @ best)}
    scored = forecaster.readout.transform(encoded.selectExpr("series", "target_ts", "h").withColumn("features", _vector("h")))
    for r in scored.collect():
        assert r.prediction == pytest.approx(got[r.series, r.target_ts], abs=2e-3)


def _vector(c):
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(c)


def test_predictions_are_in_price_units_and_beat_the_mean(fitted):
    _, encoded, forecaster = fitted
    scored = predict(encoded, forecaster, KEY)
    assert scored.columns == ["model", "series", "ts", "y_true", "y_pred"]
    for r in regression_metrics(scored, blocks=None).collect():
        assert r.r2 > 0.95


def test_forecast_repeats_one_step_predictions(fitted):
    scaled, _, forecaster = fitted
    windows, _ = latest_window(scaled, KEY, features=COLUMNS, length=12)
    got = forecast(windows, forecaster, KEY, 3).orderBy("series", "step").collect()
    assert len(got) == 6
    w, b = forecaster.readout.coefficients.toArray(), forecaster.readout.intercept
    scaler = {r.series: r for r in forecaster.scaler.filter("feature = 'selling_price'").collect()}
    for row in windows.collect():
        x, want = np.array(row.x).reshape(12, 3), []
        for _ in range(3):
            y = gate_by_gate(x, SPEC) @ w + b
            want.append(y * scaler[row.series].scale + scaler[row.series].center)
            x = np.vstack([x[1:], [y, x[-1, 1], x[-1, 2]]])
        mine = [r for r in got if r.series == row.series]
        assert [r.y_pred for r in mine] == pytest.approx(want, rel=1e-9)
        assert [(r.ts - row.last_ts).days for r in mine] == [1, 2, 3]


def test_saved_model_predicts_the_same(spark, fitted, tmp_path):
    _, encoded, forecaster = fitted
    save_model(spark, forecaster, f"{tmp_path}/zzz")
    newer = fit_forecaster(encoded, SPEC, None, 1e-6, COLUMNS, 12, "newer")
    save_model(spark, newer, f"{tmp_path}/aaa")
    assert latest_model(spark, str(tmp_path)).endswith("/aaa")
    assert load_model(spark, f"{tmp_path}/aaa").scaler is None
    loaded = load_model(spark, f"{tmp_path}/zzz")
    assert (loaded.spec, loaded.features, loaded.length) == (SPEC, tuple(COLUMNS), 12)
    assert sorted(predict(encoded, loaded, KEY).collect()) == sorted(predict(encoded, forecaster, KEY).collect())


@pytest.mark.parametrize("reg", [0.0, 1e-4, 0.3])
def test_solves_from_sums_equal_the_fit_over_rows(spark, fitted, reg):
    _, encoded, _ = fitted
    parts = encoded.withColumn("part", F.pmod(F.xxhash64("target_ts"), F.lit(3)).cast("int"))
    grams = {r.part: Gram.of(r.sums) for r in gram_sums(parts, "part").collect()}
    whole = grams[0] + grams[1] + grams[2]
    mine, fit = whole.solve(reg), fit_forecaster(encoded, SPEC, None, reg, COLUMNS, 12).readout
    probe = encoded.withColumn("features", array_to_vector("h"))
    a, b = (m.transform(probe).orderBy("target_ts", "series").select("y", "prediction").collect() for m in (mine, fit))
    assert [r.prediction for r in a] == pytest.approx([r.prediction for r in b], rel=1e-6, abs=1e-7)
    residuals = [(r.y - r.prediction) ** 2 for r in a]
    assert whole.loss(mine) == pytest.approx(sum(residuals) / len(residuals), rel=1e-8)


def test_a_save_that_breaks_off_is_never_loaded(spark, fitted, tmp_path):
    _, encoded, forecaster = fitted
    path = f"{tmp_path}/m"
    with pytest.raises(Exception):  # noqa: B017
        load_model(spark, path)
    first = save_model(spark, forecaster, path)
    other = fit_forecaster(encoded, SPEC, None, 1.0, COLUMNS, 12, "other")
    other.readout.write().save(f"{path}/versions/half/readout")  # never published
    assert load_model(spark, path).name == forecaster.name
    second = save_model(spark, other, path)
    assert (load_model(spark, path).name, load_model(spark, path, first).name) == ("other", forecaster.name)
    os.makedirs(f"{path}/published/_temporary/0")
    (tmp_path / "m/published/_temporary/0/part-0.json").write_text('{"version": "half", "fitted_at": "9"')
    assert load_model(spark, path).name == "other" and first != second
    with pytest.raises(FileNotFoundError):
        load_model(spark, path, "half")


def test_sweep_ranks_settings(two):
    scaled = apply_scaler(two, fit_scaler(two, KEY, COLUMNS), COLUMNS)
    split = chronological_split(scaled, KEY, "ts", blocks=None)
    trials = [Trial("tiny", EncoderSpec(2, 1, 1)), Trial("larger", EncoderSpec(12, 2, 1))]
    done = sweep(split, KEY, trials, fit_scaler(two, KEY, COLUMNS), COLUMNS, 12, None)
    board, history = done.leaderboard, done.history
    assert sorted(r.model for r in board.collect()) == ["larger", "tiny"]
    assert done.by_series.count() == 4
    # Price units: the error is of the size of the prices' changes, not of scaled numbers.
    assert all(r.rmse > 0.01 * two.agg(F.stddev("selling_price")).first()[0] for r in board.collect())
    best = best_model(board).first()
    assert best.r2 == max(r.r2 for r in board.collect())
    runs = {r.run_id: r for r in run_summary(history).collect()}
    assert runs["larger"].best_val_loss <= runs["tiny"].best_val_loss
    assert runs["tiny"].total_steps == 4


def test_whole_chain(spark, two):
    raw = two.withColumn("arrival", F.unix_seconds("ts"))
    prepared = prepare(raw, KEY, arrival=["arrival"], block_rows=64)
    plain = prepare(raw, KEY, arrival=["arrival"], block_rows=None)
    # Sums are taken in another order, so the scalers agree to rounding only.
    for c in ("selling_price", "rsi", "volatility"):
        assert by_time(prepared.scaled.filter("series = 'b'"), c) == pytest.approx(by_time(plain.scaled.filter("series = 'b'"), c))
    done = fit_and_predict(prepared, KEY, SPEC, 12, blocks=64)
    assert done.predictions.count() == int(208 * 0.1) + int(168 * 0.1)
