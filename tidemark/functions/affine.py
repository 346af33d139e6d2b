"""Exponential averages as affine maps: one step is e -> keep*e + (1 - keep)*x, and so is any run of steps.

Runs inside tasks, on one block of a series at a time. A block is computed from a state of
zero; what the blocks before it leave behind is added afterwards, since the maps compose.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Functions that run in Python workers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Inside a chunk weights grow by this factor at most.
SPREAD = 2.0**40


def running(x: np.ndarray, keep: float) -> np.ndarray:
    """e[i] = keep*e[i-1] + (1 - keep)*x[i] from e[-1] = 0."""
    size = max(1, floor(log(SPREAD) / -log(keep))) if 0 < keep < 1 else 1
    chunks = -(-len(x) // size)
    padded = np.zeros(chunks * size)
    padded[: len(x)] = (1.0 - keep) * x
    steps = np.arange(size)
    out = np.cumsum(padded.reshape(chunks, size) * keep ** -steps.astype(float), axis=1) * keep**steps
    before, whole = 0.0, keep**size
    carried = np.empty(chunks)
    for i in range(chunks):
        carried[i] = before
        before = out[i, -1] + whole * before
    out += carried[:, None] * keep ** (steps + 1.0)
    return out.reshape(-1)[: len(x)]


@dataclass(frozen=True)
class Averages:
    """Averages of one column over `periods`, and over `signal` steps of the first minus the second."""

    periods: tuple[int, ...]
    signal: int | None = None

    @property
    def keeps(self) -> tuple[float, ...]:
        return tuple(1.0 - 2.0 / (n + 1) for n in (*self.periods, *([] if self.signal is None else [self.signal])))

    def local(self, x: np.ndarray) -> list[np.ndarray]:
        """All states along a block that begins with zeros."""
        out = [running(x, keep) for keep in self.keeps[: len(self.periods)]]
        if self.signal is not None:
            out.append(running(out[0] - out[1], self.keeps[-1]))
        return out

    def brought(self, state: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        """What a state before the block still adds after its n-th value."""
        n = np.asarray(n, float)
        out = [state[i] * keep**n for i, keep in enumerate(self.keeps)]
        if self.signal is not None:
            last = self.keeps[-1]
            for i, sign in ((0, 1.0), (1, -1.0)):
                keep = self.keeps[i]
                # The sum of last**(n - m) * keep**m over m = 1 ... n.
                passed = n * keep**n if keep == last else keep * (keep**n - last**n) / (keep - last)
                out[-1] = out[-1] + sign * (1.0 - last) * state[i] * passed
        return out

    def seed(self, first: float) -> np.ndarray:
        """The state before a series: averages start at its first value, their difference at zero."""
        return np.array([first] * len(self.periods) + ([] if self.signal is None else [0.0]))


def _doubles(column: pa.ChunkedArray) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(0.0).to_numpy()


def along_blocks(averages: Averages, order: str, column: str, block: str, names: list[str], whole: bool) -> Callable[[pa.Table], pa.Table]:
    """A function of one block's rows: in order, with `_known` values so far and the states, null where the value is."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[(order, "ascending")], null_placement="at_start"))
        known = rows[column].is_valid().to_numpy()
        x = _doubles(rows[column])[known]
        states = averages.local(x)
        if whole and len(x):
            brought = averages.brought(averages.seed(x[0]), np.arange(1, len(x) + 1))
            states = [a + b for a, b in zip(states, brought)]
        place = np.cumsum(known)
        rows = rows.append_column("_known", pa.array(place, pa.int64(), mask=~known))
        for name, state in zip(names, states):
            spread = state[np.maximum(place - 1, 0)] if len(x) else np.zeros(len(known))
            rows = rows.append_column(name, pa.array(spread, pa.float64(), mask=~known))
        return rows

    return run


def across_blocks(averages: Averages, block: str, ends: list[str], names: list[str]) -> Callable[[pa.Table], pa.Table]:
    """A function of one series' blocks (`_n` values, the `_first` of them, states at the end): the states before each."""

    def run(blocks: pa.Table) -> pa.Table:
        blocks = blocks.take(pc.sort_indices(blocks, sort_keys=[(block, "ascending")]))
        n = blocks["_n"].fill_null(0).to_numpy()
        first = _doubles(blocks["_first"])
        own = np.stack([_doubles(blocks[c]) for c in ends], axis=1)
        seeds = np.flatnonzero(n)
        state = averages.seed(first[seeds[0]] if len(seeds) else 0.0)
        before = np.empty_like(own)
        for i in range(len(n)):
            before[i] = state
            if n[i]:
                state = own[i] + np.array([float(b) for b in averages.brought(state, n[i])])
        for j, name in enumerate(names):
            blocks = blocks.append_column(name, pa.array(before[:, j], pa.float64()))
        return blocks.drop_columns(["_n", "_first", *ends])

    return run
