"""What the earlier blocks of a back-test hand on: their product and the highest level reached.

A block is summed up by its product and the highest and lowest product inside it. The summary
of two blocks in a row follows from theirs, so a series is composed over one row per block.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Functions that run in Python workers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def equity_before(block: str) -> Callable[[pa.Table], pa.Table]:
    """A function of one series' blocks (`_total`, `_most`, `_least`): `_scale` and `_peak_before` of each.

    A block without a return has NULLs and changes nothing; nothing before gives a scale of one and no peak.
    """

    def run(blocks: pa.Table) -> pa.Table:
        blocks = blocks.take(pc.sort_indices(blocks, sort_keys=[(block, "ascending")]))
        known = blocks["_total"].is_valid().to_numpy()
        total, most, least = (blocks[c].fill_null(1.0).to_numpy() for c in ("_total", "_most", "_least"))
        scale = np.cumprod(np.concatenate([[1.0], total[:-1]]))
        # Levels scale with the product before them, and swap ends if it is negative.
        peak = np.where(known, scale * np.where(scale >= 0, most, least), -np.inf)
        before = np.maximum.accumulate(np.concatenate([[-np.inf], peak[:-1]]))
        seen = np.concatenate([[False], np.logical_or.accumulate(known)[:-1]])
        blocks = blocks.append_column("_scale", pa.array(scale, pa.float64()))
        blocks = blocks.append_column("_peak_before", pa.array(before, pa.float64(), mask=~seen))
        return blocks.drop_columns(["_total", "_most", "_least"])

    return run
