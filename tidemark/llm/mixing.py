"""Mixing sources to target weights by hash-threshold histograms.

Every row has a fixed pseudo-random place (60 bits of MD5). A source takes whole
copies of all its rows plus those rows whose place lies below a threshold. The
threshold comes from sums of sizes by source and place bucket: the bucket in which
the budget runs out is cut again, and only its rows are summed again, until the
places are told apart. Nothing is sorted, and no row leaves its task except as a
partial sum, so a hot source costs no more than its histogram.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import n_words, text_key, with_rows
from tidemark.session import stored

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
PLACE_BITS = 60
LEVEL_BITS = 12


def place(*columns: Column) -> Column:
    """60 bits of MD5 of the columns' text; equal in any engine."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, PLACE_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: float = MAX_REPEATS
) -> DataFrame:
    """(source, source_size, target) for every source of (source, size) rows.

    Sources in code-point order, null last, weigh `weights` in turn. A source whose
    share would exceed `max_repeats` times its size gets just that, and the rest is
    shared again: with the sources in order of size per weight, those are the first
    ones, and running sums find where they end. One row per source is windowed.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    chosen = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("_weight", F.get(chosen, number % len(weights))).withColumn(
        "_cap", F.lit(float(max_repeats)) * F.col("source_size")
    )
    everything = Window.partitionBy(F.lit(0))
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    filled = (
        ranked.withColumn("_all", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_left", F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_share", F.col("_left") / F.sum("_weight").over(after))
        .withColumn("_capped", F.col("_cap") <= F.col("_share") * F.col("_weight"))
    )
    # All sources from the first uncapped one on get that one's share by weight.
    level = F.min(F.when(~F.col("_capped"), F.struct(F.col("_cap") / F.col("_weight"), F.col("_share")))).over(everything)
    return (
        filled.withColumn("_level", level["_share"])
        .select(
            "source", "source_size",
            F.when(F.col("_capped") | F.col("_level").isNull(), F.col("_cap"))
            .otherwise(F.col("_level") * F.col("_weight")).alias("target"),
        )
    )


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, copies, below): take `copies` of each row, one more where place < below.

    `rows` has (source, size, place). The extra rows are those whose sizes, summed in
    order of place, end nearest to the rest of the budget; equal places go together.
    """
    plan = targets.select(
        "source",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        .cast("long").alias("copies"),
        "source_size", "target",
    ).withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
    # Sources still searched: their range of places starts at `low`, `spent` is taken below it.
    state = plan.select(
        "source", "copies", "budget", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("spent")
    )
    ends, bits = [], PLACE_BITS
    while bits > 0:
        span, bits = 1 << bits, bits - LEVEL_BITS
        inside = rows
        if span < 1 << PLACE_BITS:
            at = state.select(F.col("source").alias("_source"), F.col("low").alias("_low"))
            inside = rows.join(
                at,
                F.col("source").eqNullSafe(F.col("_source"))
                & (F.col("place") >= F.col("_low"))
                & (F.col("place") < F.col("_low") + F.lit(span)),
            )
        histogram = inside.groupBy(F.col("source").alias("_source"), F.shiftright("place", bits).alias("bucket")).agg(
            F.sum("size").cast("long").alias("n")
        )
        running = Window.partitionBy("source").orderBy("bucket")
        after = F.col("_after")
        summed = (
            histogram.join(state, F.col("_source").eqNullSafe(F.col("source")))
            .withColumn("_after", F.col("spent") + F.sum("n").over(running))
        )
        # A bucket that fits whole lies below the threshold; the first that does not is cut again.
        over = after > F.col("budget") if bits else 2 * after - F.col("n") > 2 * F.col("budget")
        cut = F.min(F.when(over, F.struct("bucket", (after - F.col("n")).alias("before"))))
        level = stored(
            summed.groupBy("source", "copies", "budget", "low").agg(cut.alias("cut")).select(
                "source", "copies", "budget", "low",
                F.shiftleft("cut.bucket", bits).alias("next"), F.col("cut.before").alias("before"),
            ),
            "mix-level",
        )
        # Nothing is over: the threshold is the end of the range.
        ends.append(level.filter("next IS NULL").select("source", "copies", (F.col("low") + F.lit(span)).alias("below")))
        state = level.filter("next IS NOT NULL").select(
            "source", "copies", "budget", F.col("next").alias("low"), F.col("before").alias("spent")
        )
    ends.append(state.select("source", "copies", F.col("low").alias("below")))
    return reduce(DataFrame.union, ends)


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: float = MAX_REPEATS
) -> DataFrame:
    """(doc_id, text_key, size, source, source_size, target, copies) for every row of `docs`.

    `copies` says how often the mix takes the row. Null and empty texts have size 0; a
    null source is a source; rows equal in doc_id and text share one place and are
    taken alike; no rows give no rows. Other columns of `docs` are not looked at.
    """
    rows = stored(
        docs.select(
            "doc_id", "source", text_key(F.col("text")).alias("text_key"), n_words(F.col("text")).alias("size"),
            place(F.col("doc_id"), F.col("text")).alias("place"),
        ),
        "mix-sizes",
    )
    targets = stored(source_targets(rows, weights, max_repeats), "mix-targets")
    cuts = stored(thresholds(rows, targets), "mix-thresholds")
    found = targets.join(cuts.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    found = found.select(F.col("source").alias("_source"), "source_size", "target", F.col("copies").alias("_whole"), "below")
    return rows.join(found, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "text_key", "size", "source", "source_size", "target",
        (F.col("_whole") + (F.col("place") < F.col("below")).cast("long")).alias("copies"),
    )


def mixed(docs: DataFrame, **options: object) -> DataFrame:
    """The mix itself: each row of `docs`, with all its columns, as often as it is taken."""
    counts = mix_sources(docs, **options).groupBy("doc_id", "text_key").agg(F.first("copies").alias("copies"))
    counts = counts.filter("copies > 0").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "copies")
    taken = with_rows(docs).join(counts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
