"""Even time blocks for ordered operators on series of any length.

`Window.partitionBy(keys)` puts a whole series into one task, so one series with
a third of all rows stalls the job. Here every series is cut along its order
column into blocks of about `block_rows` rows. An operator that looks back a
bounded number of rows runs per (key, block), because each block also receives
the rows just before it (the halo). Running totals combine a per-block window
with a carry computed on the one-row-per-block table.

How blocks are found, without sorting the data and without sampling:

1. per key: count, lowest and highest position (map-side combined, one row per key);
2. per (key, cell): count, where a cell is an equal slice of the key's span and
   there are about CELLS_PER_BLOCK cells per block (map-side combined). A cell that
   still holds many rows, because they came in a burst, is sliced again over its
   own span, as often as needed;
3. running counts over cells, in groups of cells and then over the groups, give each
   cell its first row number and its block; an equi-join on block numbers finds the
   later blocks whose halo reaches into it;
4. rows look up their cell and are shuffled once by (key, block).

Steps 1 to 3 run when the plan is built: their small tables are stored, so that the
lookups are broadcast if they measure small and shuffled by (key, cell), which is
even, if not. `df` is read in steps 1, 2 and 4, so pass a table or a plan that is
cheap to repeat (`tidemark.session.stored` writes one); steps 1 and 2 read only
the key and order columns. `plan_blocks` runs them once for several operators.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numeric import aggregate_apart, key_join
from tidemark.session import stored

BLOCK_ROWS = 250_000
CELLS_PER_BLOCK = 16
DENSE = 0.25
# Dense cells are few, so they are sliced finely: a burst is found in fewer passes.
BURST_FINENESS = 64
# Rows that a window over a layout's small tables holds.
GROUP = 1024

BLOCK = "_block"
HALO = "_halo"
START = "_block_start"

Operator = Callable[[DataFrame, list[str]], DataFrame]


def _position(df: DataFrame, order: str) -> Column:
    """A numeric column that rises with `order`; floating numbers are halved, so no span overflows."""
    kind = df.schema[order].dataType
    at = F.col(order)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(at)
    if isinstance(kind, T.TimestampNTZType):
        # Counted from the clock reading itself: no zone, no lost or doubled hours.
        seconds = F.unix_date(at.cast("date")).cast("long") * 86_400 + F.hour(at) * 3_600 + F.minute(at) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(at)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return at.cast("double") * 0.5
    return at


def _is_finite(df: DataFrame, order: str) -> Column:
    at = F.col(order)
    if not isinstance(df.schema[order].dataType, (T.DoubleType, T.FloatType)):
        return F.lit(True)
    return ~F.isnan(at) & (F.abs(at) < float("inf"))


def _odd_place(df: DataFrame, order: str) -> Column:
    """Cells of what has no place on a line: minus infinity first, infinity and NaN last."""
    at, high = F.col(order), F.col("_slices")
    if not isinstance(df.schema[order].dataType, (T.DoubleType, T.FloatType)):
        return F.lit(None).cast("long")
    return F.when(F.isnan(at), high + 1).when(at == float("inf"), high).when(at == float("-inf"), -1)


@dataclass(frozen=True)
class Layout:
    """Where the blocks of a table lie; made by `plan_blocks`, valid while its rows do not change.

    `slices[i]` divides the cells of depth i (whole series at depth 0) into those of depth i + 1.
    """

    keys: tuple[str, ...]
    order: str
    halo: int
    slices: tuple[DataFrame, ...]
    cells: DataFrame


Blocks = int | None | Layout


def _cell_names(depth: int) -> list[str]:
    return [f"_cell_{i}" for i in range(1, depth + 1)]


def _slices(counts: DataFrame, by: list[str], block_rows: int, fineness: int = 1) -> DataFrame:
    """(by, lowest position, width, number of slices, rows of the whole series) from (by, _n, _lo, _hi, _series)."""
    wanted = F.ceil(F.col("_n") * (CELLS_PER_BLOCK * fineness) / block_rows)
    slices = F.when(F.col("_n") <= block_rows * DENSE, 1).otherwise(wanted)
    width = (F.col("_hi") - F.col("_lo")).cast("double")
    return counts.select(*by, "_lo", width.alias("_width"), slices.alias("_slices"), "_series")


def _is_dense(block_rows: int) -> Column:
    """Cells to slice again: large ones with more than one position, of series longer than a block."""
    return (F.col("_series") > block_rows) & (F.col("_n") > block_rows * DENSE) & (F.col("_hi") > F.col("_lo"))


def _with_cells(df: DataFrame, keys: list[str], order: str, slices: Sequence[DataFrame], extra: Sequence[str] = ()) -> DataFrame:
    """Add `_cell_1`, ...: the slice of each depth; 0 where a cell is not sliced further. `extra` are columns of the first slices."""
    pos = _position(df, order)
    columns = df.columns
    for depth, table in enumerate(slices):
        names = _cell_names(depth)
        share = F.coalesce(F.try_divide((pos - F.col("_lo")).cast("double"), F.col("_width")), F.lit(0.0))
        place = F.least(F.floor(share * F.col("_slices")), F.col("_slices") - 1)
        if not depth:
            place = F.coalesce(_odd_place(df, order), place)
        df = key_join(df, table if not depth else table.drop(*extra), keys, "left", names).select(
            *columns, *extra, *names, F.coalesce(place, F.lit(0)).cast("long").alias(f"_cell_{depth + 1}")
        )
    return df


def _count_cells(df: DataFrame, keys: list[str], order: str, slices: Sequence[DataFrame]) -> DataFrame:
    pos = _position(df, order)
    counted = (F.count(F.lit(1)).alias("_n"), F.min(pos).alias("_lo"), F.max(pos).alias("_hi"), F.max("_series").alias("_series"))
    return aggregate_apart(_with_cells(df, keys, order, slices, ["_series"]), [*keys, *_cell_names(len(slices))], *counted)


def scan_before(table: DataFrame, by: Sequence[str], order: str, made: dict[str, tuple[str, str]]) -> DataFrame:
    """Add, per name, an aggregate over all rows of the same `by` that come before: (`sum`, `product`, `max` or `last`, column).

    Rows are scanned in groups of GROUP along `order`, a whole number, and then the groups'
    totals are, so that no window holds all rows of one key. NULLs are passed over, and
    what has nothing before it is NULL.
    """
    functions = {"sum": F.sum, "product": F.product, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
    join = {
        "sum": lambda a, b: F.coalesce(a + b, a, b),
        "product": lambda a, b: F.coalesce(a * b, a, b),
        "max": F.greatest,
        "last": lambda a, b: F.coalesce(b, a),
    }
    group = F.floor(F.col(order) / GROUP).alias("_group")
    columns = table.columns
    grouped = table.select("*", group)
    near = Window.partitionBy(*by, "_group").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    total = {"last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order)))}
    totals = grouped.groupBy(*by, "_group").agg(*[total.get(f, functions[f])(c).alias(f"_of_{name}") for name, (f, c) in made.items()])
    far = Window.partitionBy(*by).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*by, "_group", *[functions[f](f"_of_{name}").over(far).alias(f"_far_{name}") for name, (f, _) in made.items()])
    local = grouped.withColumns({f"_near_{name}": functions[f](c).over(near) for name, (f, c) in made.items()})
    met = key_join(local, carried, by, exact=["_group"])
    return met.select(*columns, *[join[f](F.col(f"_far_{name}"), F.col(f"_near_{name}")).alias(name) for name, (f, _) in made.items()])


def _first_rows(counts: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Add `_first`: rows of the series before each cell; per depth, those of the slices before it in the same cell."""
    by, own = [*keys, *names[:-1]], names[-1]
    found = scan_before(counts.select(*by, own, "_n"), by, own, {"_first": ("sum", "_n")})
    found = found.withColumn("_first", F.coalesce("_first", F.lit(0)))
    for depth in range(1, len(names)):  # only where bursts were sliced again
        by, own = [*keys, *names[: depth - 1]], names[depth - 1]
        slices = counts.groupBy(*by, own).agg(F.sum("_n").alias("_of"))
        before = scan_before(slices, by, own, {"_before": ("sum", "_of")}).drop("_of")
        found = key_join(found, before, keys, exact=names[:depth])
        found = found.withColumn("_first", F.col("_first") + F.coalesce("_before", F.lit(0))).drop("_before")
    return found


def _cells(counts: DataFrame, keys: list[str], names: list[str], halo: int, block_rows: int) -> DataFrame:
    """(key, cell) -> own block, its first row number, later blocks that need the cell."""
    placed = _first_rows(counts, keys, names).withColumn("_own", F.floor(F.col("_first") / block_rows))
    opens = F.min("_first").over(Window.partitionBy(*keys, "_own"))
    placed = placed.select(*keys, *names, "_own", opens.alias(START), "_first", (F.col("_first") + F.col("_n") - 1).alias("_last"))
    none = F.array().cast("array<struct<distance:bigint,block:bigint>>")
    if not halo:
        return placed.select(*keys, *names, "_own", START, none.alias("_later"))
    # A block opens at the first cell that begins in its rows, so one that opens within the
    # `halo` rows after a cell has one of few numbers: an equi-join, and few cells take part.
    placed = stored(placed, "cells")
    furthest = F.floor((F.col("_last") + halo) / block_rows)
    numbers = F.explode(F.sequence(F.col("_own") + 1, furthest)).alias("_block")
    asking = placed.filter(furthest > F.col("_own")).select(*keys, *names, "_own", START, "_last", numbers)
    opened = placed.filter(F.col("_first") == F.col(START)).select(*keys, F.col("_own").alias("_block"), F.col(START).alias("_opens"))
    near = key_join(asking, opened, keys, "left", ["_block"])
    need = F.struct((F.col("_opens") - F.col("_last")).alias("distance"), F.col("_block").alias("block"))
    needs = F.collect_list(F.when(F.col("_opens") <= F.col("_last") + halo, need)).alias("_later")
    others = placed.filter(furthest <= F.col("_own")).select(*keys, *names, "_own", START, none.alias("_later"))
    return others.union(near.groupBy(*keys, *names, "_own", START).agg(needs))


def plan_blocks(
    df: DataFrame, keys: Sequence[str], order: str, halo: int = 0, block_rows: int = BLOCK_ROWS
) -> Layout:
    """Find the blocks once, for several operators over the same rows.

    `halo` is the longest look-back any of them needs.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("name at least one key column; a single series needs a constant one")
    pos = F.when(_is_finite(df, order), _position(df, order))
    series = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(pos).alias("_lo"), F.max(pos).alias("_hi"))
    slices, before = [stored(_slices(series.withColumn("_series", F.col("_n")), keys, block_rows), "slices")], None
    while True:
        names = _cell_names(len(slices))
        told, is_dense = Observation(), _is_dense(block_rows)
        size = F.when(is_dense, (F.col("_hi") - F.col("_lo")).cast("double"))
        seen = (F.count_if(is_dense).alias("n"), F.sum(F.when(is_dense, F.col("_n"))).alias("rows"), F.sum(size).alias("span"))
        counts = stored(_count_cells(df, keys, order, slices).observe(told, *seen), "counts")
        dense = counts.filter(is_dense)
        state = tuple(told.get[c] for c in ("n", "rows", "span"))
        if not state[0]:
            break
        if state == before:
            raise RuntimeError(f"{order} cannot be cut into blocks of {block_rows} rows: {state[0]} spans stay whole")
        before = state
        slices.append(stored(_slices(dense, [*keys, *names], block_rows, BURST_FINENESS), "slices"))
    cells = stored(_cells(counts, keys, names, halo, block_rows), "cells")
    return Layout(tuple(keys), order, halo, tuple(slices), cells)


def assign_blocks(
    df: DataFrame, keys: Sequence[str], order: str, halo: int = 0, blocks: Blocks = BLOCK_ROWS
) -> DataFrame:
    """Add `_block`, `_halo` and `_block_start` (row number of the block's first own row).

    Rows needed by later blocks appear once more per such block with `_halo` true.
    `blocks` is the number of rows per block, a layout made before, or None for one
    block per series: only for series whose length has a known small bound, such
    as one row per calendar day.
    """
    keys = list(keys)
    if blocks is None:
        return df.withColumns({BLOCK: F.lit(0).cast("long"), HALO: F.lit(False), START: F.lit(0).cast("long")})
    layout = blocks if isinstance(blocks, Layout) else plan_blocks(df, keys, order, halo, blocks)
    if (list(layout.keys), layout.order) != (keys, order) or layout.halo < halo:
        raise ValueError(f"the layout is for {layout.keys}, {layout.order}, {layout.halo} rows back")
    names = _cell_names(len(layout.slices))
    placed = key_join(_with_cells(df, keys, order, layout.slices), layout.cells, keys, exact=names)
    near = F.filter("_later", lambda b: b["distance"] <= halo)
    targets = F.concat(F.array(F.col("_own")), F.transform(near, lambda b: b["block"]))
    spread = placed.select("*", F.explode(targets).alias(BLOCK))
    own = F.col(BLOCK) == F.col("_own")
    return spread.select(*df.columns, BLOCK, (~own).alias(HALO), F.when(own, F.col(START)).alias(START))


def in_blocks(
    df: DataFrame, operator: Operator, keys: Sequence[str], order: str, halo: int, blocks: Blocks = BLOCK_ROWS
) -> DataFrame:
    """Run `operator(df, keys)`, which looks back at most `halo` rows, block by block.

    The result equals `operator(df, keys)` on whole series.
    """
    keys = list(keys)
    if blocks is None:
        return operator(df, keys)
    blocked = assign_blocks(df, keys, order, halo, blocks).drop(START)
    return operator(blocked, [*keys, BLOCK]).filter(~F.col(HALO)).drop(BLOCK, HALO)


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: str, name: str = "row_no", blocks: Blocks = BLOCK_ROWS
) -> DataFrame:
    """0-based position of each row in its series."""
    w = Window.partitionBy(*keys, BLOCK).orderBy(order)
    blocked = assign_blocks(df, keys, order, 0, blocks)
    return blocked.withColumn(name, F.col(START) + F.row_number().over(w) - 1).drop(BLOCK, HALO, START)


def before_blocks(per_block: DataFrame, keys: Sequence[str], made: dict[str, tuple[str, str]]) -> DataFrame:
    """Add aggregates over all earlier blocks of the key to a one-row-per-block table, see `scan_before`."""
    return scan_before(per_block, list(keys), BLOCK, made)
