"""Sliding sequences and chronological splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import attach
from tidemark.operators.blocks import BLOCK_ROWS, Blocks, in_blocks, row_numbers
from tidemark.schemas import FEATURES


def make_sequences(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    features: Sequence[str] = FEATURES,
    target: str = "selling_price",
    length: int = 60,
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """(keys, target_ts, x, y): the `length` rows before each row, and its target.

    `x` is row-major, length * len(features) values. Each row is copied `length` times, so
    keep this last; `tidemark.operators.forecasting.encode_series` slides inside NumPy instead.
    """
    keys, features = list(keys), list(features)
    goal = target if target in features else features[0]

    def run(part: DataFrame, by: list[str]) -> DataFrame:
        before = Window.partitionBy(*by).orderBy(ts).rowsBetween(-length, -1)
        row = F.array(*[F.col(c).cast("double") for c in features])
        tags = [c for c in ("_block", "_halo") if c in part.columns]
        rows = part.select(*keys, *tags, F.col(ts).alias("target_ts"), F.collect_list(row).over(before).alias("_rows"), F.col(goal).cast("double").alias("y"))
        full = rows.filter(F.size("_rows") == length)
        return full.select(*keys, *tags, "target_ts", F.flatten("_rows").alias("x"), "y")

    return in_blocks(df, run, keys, ts, length, blocks)


def chronological_split(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "target_ts",
    val: float = 0.2,
    test: float = 0.1,
    blocks: Blocks = BLOCK_ROWS,
) -> DataFrame:
    """Add `seq_no` (0-based) and `split`: oldest rows train, then val, newest test.

    Sizes are int(n * test), int(n * val) and the rest.
    """
    keys = list(keys)
    numbered = row_numbers(df, keys, ts, "seq_no", blocks)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    n_test, n_val = F.floor(F.col("_n") * F.lit(test)), F.floor(F.col("_n") * F.lit(val))
    n_train = F.col("_n") - n_test - n_val
    split = (
        F.when(F.col("seq_no") < n_train, "train").when(F.col("seq_no") < n_train + n_val, "val").otherwise("test")
    )
    return attach(numbered, sizes, keys).select(*df.columns, "seq_no", split.alias("split"))


def holdout_split(
    df: DataFrame, keys: Sequence[str], ts: str = "target_ts", val: float = 0.2, blocks: Blocks = BLOCK_ROWS
) -> DataFrame:
    """Two-way split: the first int(n * (1 - val)) rows train, the rest val."""
    keys = list(keys)
    numbered = row_numbers(df, keys, ts, "seq_no", blocks)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    split = F.when(F.col("seq_no") < F.floor(F.col("_n") * F.lit(1.0 - val)), "train").otherwise("val")
    return attach(numbered, sizes, keys).select(*df.columns, "seq_no", split.alias("split"))


def concat_splits(df: DataFrame, names: Sequence[str] = ("train", "val")) -> DataFrame:
    return df.filter(F.col("split").isin(*names))


def latest_window(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", features: Sequence[str] = FEATURES, length: int = 60
) -> tuple[DataFrame, DataFrame]:
    """((keys, last_ts, x) of each series' last `length` rows, rejects with fewer rows).

    Only the last `length` rows of a series pass the rank limit, which also
    works before the shuffle; the gathered array is bounded by `length`.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    row = F.struct(F.col(ts).alias("at"), F.array(*[F.col(c).cast("double") for c in features]).alias("v"))
    recent = df.select(*keys, row.alias("_row"), F.row_number().over(newest).alias("_rank"))
    recent = recent.filter(F.col("_rank") <= length)
    gathered = recent.groupBy(*keys).agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    full = gathered.filter(F.size("_rows") == length).select(
        *keys,
        F.element_at("_rows", -1)["at"].alias("last_ts"),
        F.flatten(F.transform("_rows", lambda r: r["v"])).alias("x"),
    )
    short = gathered.filter(F.size("_rows") < length).select(*keys, F.size("_rows").alias("n_rows"))
    return full, short
