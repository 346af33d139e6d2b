"""From text records to a clean price table, and checks on what was removed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import aggregate_apart, attach, key_join, null_if_nan
from tidemark.operators.blocks import BLOCK, BLOCK_ROWS, HALO, START, Blocks, assign_blocks, before_blocks
from tidemark.operators.quantiles import ACCURACY, approx_quantiles, exact_quantiles
from tidemark.schemas import BUY_FIELD, SELL_FIELD, TIME_FIELD
from tidemark.session import stored

PRICES = ("selling_price", "buying_price")


def _number(field: str) -> Column:
    return null_if_nan(F.expr(f"try_cast(`{field}` AS double)"))


def to_prices(records: DataFrame, keys: Sequence[str] = (), extra: Sequence[str] = ()) -> DataFrame:
    """Records of text -> (keys, extra, ts, selling_price, buying_price, spread).

    What cannot be read becomes NULL; `split_bad_records` sets such rows aside.
    """
    sell, buy = _number(SELL_FIELD), _number(BUY_FIELD)
    return records.select(
        *keys,
        *extra,
        F.try_to_timestamp(F.col(TIME_FIELD)).alias("ts"),
        sell.alias("selling_price"),
        buy.alias("buying_price"),
        (sell - buy).alias("spread"),
    )


def bad_record_reason() -> Column:
    """Why a record of text cannot be read as a price; NULL if it can."""
    return (
        F.when(F.try_to_timestamp(F.col(TIME_FIELD)).isNull(), "bad_time")
        .when(_number(SELL_FIELD).isNull(), "bad_selling_price")
        .when(_number(BUY_FIELD).isNull(), "bad_buying_price")
    )


def split_bad_records(records: DataFrame, keys: Sequence[str] = (), extra: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(good price rows, quarantined records with the reason).

    A NULL or NaN price is quarantined like an unreadable one.
    """
    judged = records.withColumn("reason", bad_record_reason())
    good = to_prices(judged.filter(F.col("reason").isNull()), keys, extra)
    bad = judged.filter(F.col("reason").isNotNull()).select(
        *keys, *extra, SELL_FIELD, BUY_FIELD, TIME_FIELD, "reason"
    )
    return good, bad


def dedupe_first(df: DataFrame, keys: Sequence[str], ts: str, arrival: Sequence[str]) -> DataFrame:
    """Keep the first row to arrive for each (keys, ts); `arrival` must order copies uniquely.

    The rank limit is applied before the shuffle as well as after, so many
    copies of one timestamp leave each map task as a single row.
    """
    w = Window.partitionBy(*keys, ts).orderBy(*arrival)
    return df.withColumn("_copy", F.row_number().over(w)).filter(F.col("_copy") == 1).drop("_copy")


def positive_prices(df: DataFrame, columns: Sequence[str] = PRICES) -> DataFrame:
    """Rows whose prices are all above zero (Spark ranks NaN above every number, so it is excluded by name)."""
    for c in columns:
        df = df.filter((F.col(c) > 0) & ~F.isnan(c))
    return df


def quartiles(df: DataFrame, keys: Sequence[str], column: str, method: str = "exact", accuracy: int = ACCURACY) -> DataFrame:
    """(keys, q1, q3); `accuracy` is that of the sketch behind `approx`."""
    if method not in ("exact", "approx"):
        raise ValueError("method is exact or approx")
    quarters = (0.25, 0.75)
    found = exact_quantiles(df, keys, column, quarters) if method == "exact" else approx_quantiles(df, keys, column, quarters, accuracy)
    return found.select(*keys, F.col("q0").alias("q1"), F.col("q1").alias("q3"))


def iqr_bounds(
    df: DataFrame, keys: Sequence[str], column: str, k: float = 1.5, method: str = "exact", accuracy: int = ACCURACY
) -> DataFrame:
    """(keys, q1, q3, lower, upper)."""
    margin = F.lit(k) * (F.col("q3") - F.col("q1"))
    return quartiles(df, keys, column, method, accuracy).select(
        *keys, "q1", "q3", (F.col("q1") - margin).alias("lower"), (F.col("q3") + margin).alias("upper")
    )


def iqr_filter(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = PRICES,
    k: float = 1.5,
    method: str = "exact",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Keep q1 - k*iqr <= x <= q3 + k*iqr, column after column.

    The quartiles of a later column are taken over the rows that the earlier
    columns kept. `df` is read several times; pass a stored table if it is costly.
    """
    for c in columns:
        bounds = iqr_bounds(df, keys, c, k, method, accuracy)
        bounds = bounds.select(*keys, F.col("lower").alias("_lower"), F.col("upper").alias("_upper"))
        # Exact bounds come from a stored table, whose size the planner knows.
        met = key_join(df, bounds, keys, "left") if keys and method == "exact" else attach(df, bounds, keys)
        df = met.filter((F.col(c) >= F.col("_lower")) & (F.col(c) <= F.col("_upper"))).select(*df.columns)
    return df


def sort_by_time(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Order for output; the operators define their own order and do not need this."""
    return df.orderBy(*keys, ts)


def fill_missing(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    how: str = "ffill_bfill",
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """Fill gaps forward, then backward, then drop rows that still have one.

    After the forward fill only the rows before the first known value are empty,
    so the backward fill is that first value for the whole series.
    """
    columns = list(columns)
    if how == "drop":
        return df.dropna(subset=columns)
    keys = list(keys)
    blocked = assign_blocks(df, keys, ts, 0, blocks).drop(HALO, START)
    so_far = Window.partitionBy(*keys, BLOCK).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    forward = {c: F.coalesce(F.col(c), F.last(c, ignorenulls=True).over(so_far)) for c in columns}
    if blocks is None:
        whole = so_far.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        filled = {c: F.coalesce(forward[c], F.first(c, ignorenulls=True).over(whole)) for c in columns}
        return blocked.withColumns(filled).drop(BLOCK).dropna(subset=columns)

    # The ordered pass runs once; summaries of the blocks and the rows are read from what it leaves.
    names = {c: f"_forward_{c}" for c in columns}
    forwarded = stored(blocked.withColumns({names[c]: forward[c] for c in columns}), "forward")
    when = {c: F.when(F.col(c).isNotNull(), F.col(ts)) for c in columns}
    per_block = forwarded.groupBy(*keys, BLOCK).agg(
        *[F.max_by(c, when[c]).alias(f"_last_{c}") for c in columns], *[F.min_by(c, when[c]).alias(f"_opens_{c}") for c in columns]
    )
    opening = per_block.groupBy(*keys).agg(
        *[F.min_by(f"_opens_{c}", F.when(F.col(f"_opens_{c}").isNotNull(), F.col(BLOCK))).alias(f"_opening_{c}") for c in columns]
    )
    before = before_blocks(per_block.select(*keys, BLOCK, *[f"_last_{c}" for c in columns]), keys, {f"_before_{c}": ("last", f"_last_{c}") for c in columns})
    carries = key_join(before.drop(*[f"_last_{c}" for c in columns]), opening, keys)
    filled = {c: F.coalesce(F.col(names[c]), F.col(f"_before_{c}"), F.col(f"_opening_{c}")) for c in columns}
    joined = key_join(forwarded, stored(carries, "carries"), keys, exact=[BLOCK]).withColumns(filled)
    return joined.select(*df.columns).dropna(subset=columns)


def price_summary(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Row count, time range, and min/max/mean/population deviation of both prices per key."""
    stats = {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_pop}
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(ts).alias("start"),
        F.max(ts).alias("finish"),
        *[f(c).alias(f"{c}_{name}") for c in PRICES for name, f in stats.items()],
    )


def _missing(c: str) -> Column:
    text = F.col(c).cast("string")
    return text.isNull() | text.isin("", "0")


def quality_report(records: DataFrame, keys: Sequence[str], min_rows: int = 60, threshold: float = 3.0) -> DataFrame:
    """(keys, check, n_bad, passed) for text records.

    Missing means absent, NULL, empty text or the number 0 as it is read from JSON. Outliers are looked for
    among selling prices written with digits only.
    """
    digits = F.when(F.col(SELL_FIELD).rlike("^[0-9]+$"), F.col(SELL_FIELD).cast("double"))
    read = records.select(*keys, SELL_FIELD, BUY_FIELD, TIME_FIELD, digits.alias("_p"))
    moments = read.groupBy(*keys).agg(F.avg("_p").alias("_m"), F.stddev_pop("_p").alias("_s"))
    dates = F.when(~_missing(TIME_FIELD), F.col(TIME_FIELD))
    # Copies of a date are combined before the count, so a date that fills a
    # third of the table is one row per map task.
    copies = read.withColumn("_d", dates).groupBy(*keys, "_d").agg(F.count("_d").alias("_c"))
    repeats = copies.groupBy(*keys).agg(F.sum(F.greatest(F.col("_c") - 1, F.lit(0))).alias("duplicate_dates"))
    counts = aggregate_apart(
        attach(read, moments, keys),
        keys,
        F.greatest(F.lit(min_rows) - F.count(F.lit(1)), F.lit(0)).alias("insufficient_rows"),
        F.count_if(_missing(SELL_FIELD)).alias("missing_selling_price"),
        F.count_if(_missing(BUY_FIELD)).alias("missing_buying_price"),
        F.count_if(_missing(TIME_FIELD)).alias("missing_dates"),
        F.count_if(F.abs(F.col("_p") - F.col("_m")) > threshold * F.col("_s")).alias("outliers"),
    )
    wide = attach(counts, repeats, keys)
    checks = [
        "insufficient_rows",
        "missing_selling_price",
        "missing_buying_price",
        "missing_dates",
        "duplicate_dates",
        "outliers",
    ]
    long = wide.select(*keys, *[F.col(c).cast("long").alias(c) for c in checks]).unpivot(list(keys), checks, "check", "n_bad")
    return long.withColumn("passed", F.col("n_bad") == 0)


def zscore_outliers(
    df: DataFrame, keys: Sequence[str], column: str, threshold: float = 3.0, action: str = "flag"
) -> DataFrame:
    """Flag (`is_outlier`) or drop rows further than `threshold` population deviations from the mean."""
    moments = df.groupBy(*keys).agg(F.avg(column).alias("_m"), F.stddev_pop(column).alias("_s"))
    far = F.coalesce(F.abs(F.col(column) - F.col("_m")) > threshold * F.col("_s"), F.lit(False))
    flagged = attach(df, moments, keys).select(*df.columns, far.alias("is_outlier"))
    if action == "flag":
        return flagged
    return flagged.filter(~F.col("is_outlier")).drop("is_outlier")


def require_min_rows(df: DataFrame, keys: Sequence[str], n: int) -> tuple[DataFrame, DataFrame]:
    """(rows of series with at least n rows, one reject row per shorter series)."""
    lengths = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    sizes = lengths.withColumnRenamed("n_rows", "_n")
    kept = attach(df, sizes, keys).filter(F.col("_n") >= n) if keys else df.filter(
        F.coalesce(sizes.select("_n").scalar(), F.lit(0)) >= n
    )
    return kept.select(*df.columns), lengths.filter(F.col("n_rows") < n)


def latest_days(df: DataFrame, keys: Sequence[str], ts: str, days: int) -> DataFrame:
    """Rows within `days` days of each series' last timestamp."""
    last = df.groupBy(*keys).agg(F.max(ts).alias("_last"))
    recent = F.col(ts) >= F.col("_last") - F.make_dt_interval(F.lit(days))
    return attach(df, last, keys).filter(recent).select(*df.columns)
