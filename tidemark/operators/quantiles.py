"""Exact interpolated quantiles per group by repeated cutting, without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import aggregate_apart, attach, key_join
from tidemark.session import stored

ACCURACY = 100_000
# Buckets of the first round between a number and its double, and of a bucket that is cut again.
PER_OCTAVE, PARTS = 64, 1 << 20
# Above the bucket of every finite number, and of every infinite one.
INFINITE, NOT_A_NUMBER = 1 << 22, 1 << 23


def _magnitude(per_octave: int) -> Column:
    """A whole number that never falls as `_v` grows: its logarithm, mirrored for numbers below zero."""
    # The logarithm of zero is NULL.
    positive = f"least(floor(log2(abs(_v)) * {float(per_octave)}), {INFINITE}L) + {1100 * per_octave}L"
    return F.expr(f"CASE WHEN isnan(_v) THEN {NOT_A_NUMBER}L WHEN _v = 0 THEN 0L WHEN _v < 0 THEN -({positive}) ELSE {positive} END")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    probabilities: Sequence[float],
    per_octave: int = PER_OCTAVE,
    parts: int = PARTS,
) -> DataFrame:
    """(keys, q0, q1, ...): linear interpolation between the two nearest order statistics.

    Values are counted in buckets that follow their order, first by logarithm. Only the
    buckets that hold a wanted rank are cut again, each into `parts` equal steps from its
    least to its greatest value, until every one of them holds a single value: twice for
    most data, five times at most, as every round adds twenty bits to a number's leading
    ones. Counts combine map-side, so a hot group sends a task's buckets, not its rows; a
    key has at most 2200 * `per_octave` buckets on either side of zero, and later `parts`
    for each of its ranks, whatever its number of rows. NULLs are left out, NaN counts as
    the greatest number.
    """
    keys = list(keys)
    values = df.select(*keys, F.col(column).cast("double").alias("_v")).filter("_v IS NOT NULL")
    rows = values.select("*", F.lit(0).alias("_parent"), _magnitude(per_octave).alias("_bucket"))
    # The two order statistics around each quantile, numbered from 0.
    at = [f"{float(p)!r}D * (_n - 1)" for p in probabilities]
    ranks = ", ".join(f"struct({i} AS i, {f}({x}) AS rank)" for i, x in enumerate(at) for f in ("floor", "ceil"))
    group = Window.partitionBy(*keys, "_parent")
    upto = F.sum("_copies").over(group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    state = None
    while True:
        counted = (F.count(F.lit(1)).alias("_copies"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        counts = aggregate_apart(rows, [*keys, "_parent", "_bucket"], *counted)
        counts = counts.repartition(*keys) if keys else counts.repartition(1)
        if state is None:
            counts = counts.withColumns({"_n": F.sum("_copies").over(group), "_before": F.lit(0).cast("long"), "_upto": upto})
            counts = counts.withColumn("_wanted", F.expr(f"array({ranks})"))
        else:
            before, wanted = (F.expr(f"_chosen[_parent].{c}") for c in ("from", "wanted"))
            counts = _meet(counts, state, keys).withColumns({"_before": before, "_wanted": wanted, "_upto": upto})
        placed = counts.withColumn("_from", F.expr("_before + _upto - _copies"))
        bucket = "struct(_least AS least, _most AS most, _from AS from, filter(_wanted, r -> r.rank >= _from AND r.rank < _from + _copies) AS wanted)"
        chosen = placed.select(*keys, "_n", F.expr(bucket).alias("_b")).filter("size(_b.wanted) > 0")
        chosen = chosen.groupBy(*keys).agg(F.max("_n").alias("_n"), F.collect_list("_b").alias("_chosen"))
        told = Observation()
        state = stored(chosen.observe(told, F.expr("count_if(exists(_chosen, b -> b.least < b.most)) AS open")), "ranks")
        if not told.get["open"]:
            break
        rows = _cut_again(values, state, keys, 2 * len(probabilities), parts)

    def quantile(i: int) -> Column:
        # The lesser rank holds the lesser value.
        own = f"transform(filter(_chosen, b -> exists(b.wanted, r -> r.i = {i})), b -> b.least)"
        lower, upper = f"array_min({own})", f"array_max({own})"
        between = f"{lower} + ({upper} - {lower}) * ({at[i]} - floor({at[i]}))"
        return F.expr(f"CASE WHEN {lower} = {upper} THEN {lower} ELSE {between} END").alias(f"q{i}")

    return state.select(*keys, *[quantile(i) for i in range(len(probabilities))])


def _meet(df: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on keys; the state's size is known, so a small one is broadcast."""
    return key_join(df, state, keys) if keys else attach(df, state, keys)


def _cut_again(values: DataFrame, state: DataFrame, keys: Sequence[str], most: int, parts: int) -> DataFrame:
    """Rows inside chosen buckets with the bucket's place in the state and their step between its ends; no other row is kept.

    Buckets of one value are met again as they are, so that every key stays in the state.
    """
    met = _meet(values, state.select(*keys, "_chosen"), keys)
    places = " ".join(f"WHEN _v >= get(_chosen, {i}).least AND _v <= get(_chosen, {i}).most THEN {i}" for i in range(most))
    inside = met.select(*keys, "_v", "_chosen", F.expr(f"CASE {places} END").alias("_parent")).filter("_parent IS NOT NULL")
    inside = inside.select(*keys, "_v", "_parent", F.expr("_chosen[_parent]").alias("_own"))
    step = f"floor(coalesce(try_divide(_v - _own.least, _own.most - _own.least), 0D) * {float(parts)!r}D)"
    return inside.select(*keys, "_v", "_parent", F.expr(step).alias("_bucket"))


def approx_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, probabilities: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """(keys, q0, q1, ...): data points within 1/accuracy of the wanted rank, in one pass."""
    sketch = df.groupBy(*keys).agg(F.percentile_approx(F.col(column).cast("double"), list(probabilities), accuracy).alias("_q"))
    return sketch.select(*keys, *[F.col("_q")[i].alias(f"q{i}") for i in range(len(probabilities))])
