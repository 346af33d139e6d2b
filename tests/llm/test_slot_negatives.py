"""Hard negatives against plain loops, on awkward rows and in small blocks."""

import math
import random

import pytest
from pyspark.sql import functions as F
from texts import CLASHING

from tidemark.llm import slot_negatives
from tidemark.llm.slot_negatives import mine_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100, n_positives=5, n_negatives=10, low=30, high=90):
    kept = set()
    for i, x, label in rows:
        if i is not None and label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            kept.add((i, label, tuple(math.floor(256 * v) for v in x)))
    kept, out = sorted(kept), []
    for a in kept:
        if a[0] % every:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(a[2], b[2])), b[0], b[1]) for b in kept if b != a and len(b[2]) == len(a[2])))
        for s, i, _ in [x for x in scored if x[2] == a[1]][:n_positives]:
            fit = [x for x in scored if x[2] != a[1] and low * -s <= 100 * -x[0] <= high * -s][:n_negatives]
            out += [(a[0], i, rank, j, -s, -t) for rank, (t, j, _) in enumerate(fit, 1)]
    return sorted(out)


def awkward():
    r = random.Random(3)
    unit = lambda n=8: [r.gauss(0, 0.4) for _ in range(n)]
    rows = [(i, unit(), r.randrange(4)) for i in range(0, 1200, 2)]
    hot = unit()
    rows += [(i, hot, r.randrange(4)) for i in range(1, 900, 2)]  # one vector in a third of the rows
    rows += [(None, unit(), 1), (2000, None, 1), (2100, unit(), None), (2200, [1.0, None], 1), (2300, [math.nan] * 8, 1), (2400, [math.inf] * 8, 1)]
    rows += [(2500, [], 1), (2501, [], 1), (2502, [], 2), (2600, [0.5], 1), (2601, [0.25], 1), (2602, [0.1], 3), (2603, [0.2], 3)]
    rows += [(2700, [0.0] * 8, 1), (2800, [-0.5], 9), (2801, [0.5], 9)]  # zero and negative scores
    rows += rows[:40] + [(0, unit(), 2), (300, unit(), 0)]  # repeated rows, and other rows of the same id
    return rows


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [None, 16])
def test_mined_rows(spark, monkeypatch, size):
    if size:
        monkeypatch.setattr(slot_negatives, "BLOCK_ROWS", size)
        monkeypatch.setattr(slot_negatives, "BLOCK_ANCHORS", 3)
        monkeypatch.setattr(slot_negatives, "HELD", 1)
    df = spark.createDataFrame(awkward(), SCHEMA).repartition(3)
    if size:
        df = df.withColumns({c: F.lit("x") for c in (*CLASHING, "q", "mark", "slot", "rank", "anchors", "cell")})
    assert rows_of(mine_hard_negatives(df)) == brute(awkward())


def test_other_parameters(spark):
    df = spark.createDataFrame(awkward(), SCHEMA)
    got = mine_hard_negatives(df, anchor_every=150, n_positives=40, n_negatives=3, low=-50, high=110)
    assert rows_of(got) == brute(awkward(), 150, 40, 3, -50, 110)


def test_great_components_stay_exact(spark):
    r = random.Random(9)
    rows = [(i, [float(r.randrange(1 << 17, 1 << 18)) + 0.5 for _ in range(4)], i % 2) for i in range(0, 60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(mine_hard_negatives(df, anchor_every=10)) == brute(rows, 10)


def test_no_rows_and_no_anchors(spark):
    assert mine_hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mine_hard_negatives(spark.createDataFrame([(1, [0.1], 1), (2, [0.1], 2)], SCHEMA)).count() == 0
    assert mine_hard_negatives(spark.createDataFrame([(100, [0.1], 1)], SCHEMA)).count() == 0
