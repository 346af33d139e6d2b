"""Leaderboards, run summaries and the tables behind plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.normal import with_normal_quantile
from tidemark.functions.numeric import aggregate_apart, attach, correlation, key_join
from tidemark.operators.blocks import BLOCK, BLOCK_ROWS, Blocks, assign_blocks, before_blocks
from tidemark.schemas import REGRESSION_PANEL, SUMMARY_ORDER, TRADING_PANEL
from tidemark.session import stored

COPY_CHUNK = 10_000


def top_metrics(metrics: DataFrame, group: Sequence[str], n: int = 5) -> DataFrame:
    """The first `n` metrics present, in the fixed order of importance."""
    place = F.array_position(F.lit(list(SUMMARY_ORDER)), F.col("metric"))
    known = metrics.withColumn("_place", place).filter(F.col("_place") > 0)
    w = Window.partitionBy(*group).orderBy("_place")
    ranked = known.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    return ranked.select(*group, "rank", "metric", "value")


def best_model(leaderboard: DataFrame, by: str = "r2") -> DataFrame:
    return leaderboard.filter(F.col(by).isNotNull()).orderBy(F.col(by).desc(), *_tie_break(leaderboard, by)).limit(1)


def _tie_break(df: DataFrame, by: str) -> list[str]:
    return [c for c, kind in df.dtypes if kind == "string" and c != by]


def head_forecast(df: DataFrame, keys: Sequence[str], ts: str = "ts", n: int = 5) -> DataFrame:
    """First `n` rows of each series and how many more there are."""
    w = Window.partitionBy(*keys).orderBy(ts)
    head = df.withColumn("step", F.row_number().over(w)).filter(F.col("step") <= n)
    sizes = df.groupBy(*keys).agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("remaining"))
    return attach(head, sizes, keys)


def rank_features(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, feature, importance) by falling importance."""
    return df.orderBy(*keys, F.col("importance").desc(), "feature")


def run_summary(history: DataFrame) -> DataFrame:
    """Per run: steps, best and final losses and, when `seconds` is there, steps per second."""
    timed = "seconds" in history.columns
    speed = [F.try_divide(F.count(F.lit(1)), F.sum("seconds")).alias("steps_per_second")] if timed else []
    return history.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_steps"),
        F.min("train_loss").alias("best_train_loss"),
        F.min("val_loss").alias("best_val_loss"),
        F.max_by("train_loss", "step").alias("final_train_loss"),
        F.max_by("val_loss", "step").alias("final_val_loss"),
        *speed,
    )


def residual_table(df: DataFrame, group: Sequence[str], ts: str = "ts") -> DataFrame:
    return df.select(*group, ts, "y_pred", (F.col("y_true") - F.col("y_pred")).alias("residual"))


def histogram(df: DataFrame, column: str, bins: int = 50, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, bin, lower, upper, n): equal-width bins, the last one closed on the right, empty ones kept.

    A constant column gets a range of one around its value. Numbers that are not finite
    have no place in a range: where a key has any, they are counted in a row with NULL bin.
    """
    keys = list(keys)
    given = df.select(*keys, F.col(column).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    finite = ~F.isnan("_v") & (F.abs("_v") < float("inf"))
    odd = given.filter(~finite).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    none = F.lit(None).cast("double")
    odd = odd.select(*keys, F.lit(None).cast("int").alias("bin"), none.alias("lower"), none.alias("upper"), "n")
    values = given.filter(finite)
    span = values.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    flat = F.when(F.col("_lo") == F.col("_hi"), 0.5).otherwise(0.0)
    span = span.select(*keys, (F.col("_lo") - flat).alias("_lo"), (F.col("_hi") + flat).alias("_hi"))
    span = stored(span.filter("_lo IS NOT NULL"), "span")
    place = F.floor((F.col("_v") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo")))
    placed = attach(values, span, keys).select(*keys, F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
    counts = aggregate_apart(placed, [*keys, "bin"], F.count(F.lit(1)).alias("_n"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    frame = span.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return key_join(frame, counts, keys, "left", ["bin"]).select(
        *keys,
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("lower"),
        F.when(F.col("bin") == bins - 1, F.col("_hi")).otherwise(F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    ).union(odd)


def _median_position(i: Column, n: Column) -> Column:
    """Filliben's estimate of the median of the i-th order statistic of n uniforms."""
    last = F.pow(F.lit(0.5), 1.0 / n)
    return F.when(i == n, last).when(i == 1, 1.0 - last).otherwise((i - 0.3175) / (n + 0.365))


def qq_points(df: DataFrame, column: str, keys: Sequence[str], blocks: Blocks = BLOCK_ROWS) -> DataFrame:
    """(keys, rank, theoretical, ordered): normal probability plot.

    Equal values are counted first (and stored, for the passes that rank them) and
    ranked once, in blocks along the value;
    their copies are produced afterwards, COPY_CHUNK at a time, so one
    frequent value is spread over many rows of work.
    """
    keys = list(keys)
    values = df.select(*keys, F.col(column).cast("double").alias("ordered")).filter(F.col("ordered").isNotNull())
    counted = stored(values.groupBy(*keys, "ordered").agg(F.count(F.lit(1)).alias("_copies")), "counted")
    blocked = assign_blocks(counted, keys, "ordered", 0, blocks)
    w = Window.partitionBy(*keys, BLOCK).orderBy("ordered")
    upto = F.sum("_copies").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ranked = blocked.withColumn("_rank", upto - F.col("_copies")).select(*keys, BLOCK, "ordered", "_copies", "_rank")
    if blocks is not None:
        # Sums per block need the layout only, not the order inside a block.
        ends = blocked.groupBy(*keys, BLOCK).agg(F.sum("_copies").alias("_sum"))
        before = before_blocks(ends, keys, {"_before": ("sum", "_sum")}).drop("_sum")
        ranked = key_join(ranked, stored(before, "ranks"), keys, exact=[BLOCK])
        ranked = ranked.withColumn("_rank", F.col("_rank") + F.coalesce("_before", F.lit(0)))
    sizes = counted.groupBy(*keys).agg(F.sum("_copies").alias("_n"))
    chunks = attach(ranked, sizes, keys).select(
        *keys, "ordered", "_rank", "_copies", "_n",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(COPY_CHUNK).cast("long"))).alias("_from"),
    )
    stop = F.least(F.col("_from") + COPY_CHUNK, F.col("_copies")) - 1
    copies = chunks.select("*", F.explode(F.sequence(F.col("_from"), stop)).alias("_copy"))
    placed = copies.withColumn("rank", F.col("_rank") + F.col("_copy") + 1)
    placed = placed.withColumn("_p", _median_position(F.col("rank"), F.col("_n")))
    return with_normal_quantile(placed, "_p", "theoretical").select(*keys, "rank", "theoretical", "ordered")


def qq_fit(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, slope, intercept, r) of the line through a probability plot."""
    return points.groupBy(*keys).agg(
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"),
        correlation(F.col("theoretical"), F.col("ordered")).alias("r"),
    )


def plot_r2(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Squared correlation of truth and forecast, as shown on a scatter plot (not the r2 metric)."""
    return df.groupBy(*group).agg(F.pow(correlation(F.col("y_true"), F.col("y_pred")), F.lit(2)).alias("plot_r2"))


def metric_panel(metrics: DataFrame, panel: str = "regression") -> DataFrame:
    names = {"regression": REGRESSION_PANEL, "trading": TRADING_PANEL}[panel]
    return metrics.filter(F.col("metric").isin(*names))


def indicator_panel(df: DataFrame, keys: Sequence[str], ts: str = "ts", high: float = 70, low: float = 30) -> DataFrame:
    """Price, averages, RSI with its state, bands, and MACD and volume where present."""
    present = [
        c
        for c in ("ma_short", "ma_long", "ema_20", "rsi", "macd", "macd_signal", "macd_histogram", "bb_upper", "bb_lower", "volume")
        if c in df.columns
    ]
    state = F.when(F.col("rsi") > high, "overbought").when(F.col("rsi") < low, "oversold").when(F.col("rsi").isNotNull(), "neutral")
    return df.select(*keys, ts, F.col("selling_price").alias("price"), *present, state.alias("rsi_state"))


def summary_table(
    metrics: DataFrame, runs: DataFrame | None = None, params: dict[str, object] | None = None, group: Sequence[str] = ()
) -> DataFrame:
    """(section, group, name, value) as text, numbers with four decimals.

    `group` names the metrics' group columns; a section without them has NULL there, but
    the run of a training section stands in the first of them.
    """
    absent = [F.lit(None).cast("string").alias(g) for g in group]
    tables = [
        metrics.select(
            F.lit("Performance Metrics").alias("section"),
            *[F.col(g).cast("string").alias(g) for g in group],
            F.col("metric").alias("name"),
            F.format_string("%.4f", F.col("value")).alias("value"),
        )
    ]
    if runs is not None:
        # Labels of the training section.
        lines = {
            "Final Training Loss": F.format_string("%.4f", F.col("final_train_loss")),
            "Final Validation Loss": F.format_string("%.4f", F.col("final_val_loss")),
            "Best Validation Loss": F.format_string("%.4f", F.col("best_val_loss")),
            "Total Epochs": F.col("total_steps").cast("string"),
        }
        entries = F.array(*[F.struct(F.lit(k).alias("name"), v.alias("value")) for k, v in lines.items()])
        run = [F.col("run_id").alias(group[0]), *absent[1:]] if group else []
        tables.append(runs.select(F.lit("Training Summary").alias("section"), *run, F.inline(entries)))
    if params:
        lines = F.array(*[F.struct(F.lit(str(k)).alias("name"), F.lit(str(v)).alias("value")) for k, v in params.items()])
        tables.append(metrics.sparkSession.range(1).select(F.lit("Model Configuration").alias("section"), *absent, F.inline(lines)))
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


def write_summary(summary: DataFrame, path: str) -> None:
    """Lines of text: `section / name: value`, with the group in brackets after the section where there is one.

    Other columns than section, name and value are the group's, as `summary_table` leaves them.
    """
    group = [c for c in summary.columns if c not in ("section", "name", "value")]
    shown = F.concat_ws(", ", F.lit(None).cast("string"), *[F.concat(F.lit(f"{c}="), F.col(c)) for c in group])
    section = F.when(shown == "", F.col("section")).otherwise(F.concat("section", F.lit(" ["), shown, F.lit("]")))
    line = F.concat(section, F.lit(" / "), "name", F.lit(": "), "value").alias("value")
    summary.orderBy("section", *group, "name").select(line).coalesce(1).write.mode("overwrite").text(path)
