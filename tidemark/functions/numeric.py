"""Column expressions with explicit missing-value and zero-division rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored

INFINITY = float("inf")


def inf() -> Column:
    return F.lit(INFINITY)


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL when b is zero."""
    return F.try_divide(a, b)


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation aggregate; NULL when either side is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def key_join(
    df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner", exact: Sequence[str] = ()
) -> DataFrame:
    """Join on `keys`, where NULL equals NULL, and on `exact`; the key columns are those of `df`."""
    names = {k: f"__key_{k}" for k in (*keys, *exact)}
    other = table.select(*[F.col(k).alias(n) for k, n in names.items()], *[c for c in table.columns if c not in names])
    same = [F.col(k).eqNullSafe(F.col(names[k])) for k in keys] + [F.col(k) == F.col(names[k]) for k in exact]
    joined = df.join(other, reduce(Column.__and__, same), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*names.values())


def attach(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of a one-row-per-key table to every row of `df`.

    No row is lost: NULL keys find NULL keys, and a row without a match gets NULLs, which
    the caller has to deal with.

    With keys, `table` is computed and stored first, so the planner knows its real
    size: below the broadcast threshold `df` is not shuffled at all, above it the
    join is shuffled and the adaptive planner splits hot keys. (Planned in one go,
    an aggregate's size is guessed from its input, and a large `df` would be
    shuffled by a skewed key to meet a tiny table.) Without keys `table` is a single row
    and is read as a scalar subquery.
    """
    if keys:
        return key_join(df, stored(table, "lookup"), keys, "left")
    row = table.select(F.struct(*table.columns).alias("row")).scalar()
    return df.select("*", row.alias("__row")).select(
        *df.columns, *[F.col("__row")[c].alias(c) for c in table.columns]
    )


def aggregate_apart(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """`groupBy(keys).agg(...)` for rows that have just met a lookup on some of the keys.

    A shuffled join can leave all rows of a key in one task, and a grouping by the same key
    is content with that, so a hot key could not be split. Grouped by a struct of the
    keys, each task combines its rows first and only the results are shuffled; the join's
    hot keys are then free to be split, whatever the session's settings for forced splits.
    """
    if not keys:
        return df.agg(*aggregates)
    found = df.groupBy(F.struct(*[F.col(k) for k in keys]).alias("__group")).agg(*aggregates)
    return found.select("__group.*", *[F.col(f"`{c}`") for c in found.columns if c != "__group"])
