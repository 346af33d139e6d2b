"""Hard negatives of anchor vectors, chosen by slots of score.

Every anchor meets every row in blocks of a few thousand rows by a few hundred anchors; a
pair of blocks is one matrix product, and only the best of each leave it. The anchor's
positives are the best rows of its own label. Each positive allows negatives up to an upper
limit of score; these limits cut the scores into disjoint slots. Combiners keep the best
`n_negatives` of every slot, within a pair of blocks, within a task, and over all tasks. The
windows of an anchor's positives overlap but all end at a slot's upper end, so merging the
slots downwards from there answers each of them.

Components are scaled, rounded down and kept as integers; products are exact. Blocks are
packed binary rows, and blocks of anchors meet blocks of rows by an equi-join on the anchor
block's number, dealt over `cells` so that few anchors still fill many tasks; Spark
broadcasts the anchors where its threshold allows and shuffles them otherwise.

Defined cases. Rows without id, label or vector, or with a null or non-finite component, take
no part. Equal rows (id, label and scaled vector) count once; other rows of one id are rows
of their own. Vectors of different length have no score with each other. Scores beyond
±2**56 count as that. Ties go to the smaller id. No rows give no rows. Other columns, of whatever name, are not looked at.
"""

from __future__ import annotations

import sys
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

# Functions that run in Python workers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows and anchors of a block; a block of long vectors has fewer rows.
BLOCK_ROWS, BLOCK_ANCHORS, BLOCK_BYTES = 4096, 512, 8 << 20
# Blocks of anchors whose best rows a task keeps before it hands them on.
HELD = 32
MOST = 1 << 56
PACKED = "dim int, ids binary, labels binary, marks binary, kind string, matrix binary"
NO_LIMIT = -(1 << 62)


def taking_part(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, q, mark): distinct rows that can be scored; `mark` tells rows of one id apart."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    q = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite)
    # A null vector is not finite either: the filter drops what it cannot judge.
    return rows.select("vec_id", "label", q.alias("q")).distinct().withColumn("mark", F.xxhash64("label", "q"))


def _packed(ids: np.ndarray, labels: np.ndarray, marks: np.ndarray, matrix: np.ndarray) -> tuple:
    most = int(np.abs(matrix).max(initial=0))
    kind = "i2" if most < 1 << 15 else "i4" if most < 1 << 31 else "i8"
    return matrix.shape[1], ids.tobytes(), labels.tobytes(), marks.tobytes(), kind, np.ascontiguousarray(matrix, kind).tobytes()


class Block:
    """A packed block again as arrays."""

    def __init__(self, dim: int, ids: bytes, labels: bytes, marks: bytes, kind: str, matrix: bytes):
        self.ids, self.labels, self.marks = (np.frombuffer(x, np.int64) for x in (ids, labels, marks))
        self.matrix = np.frombuffer(matrix, kind).reshape(len(self.ids), dim)

    def scores(self, other: Block) -> np.ndarray:
        """Exact inner products of own rows with the other's."""
        a, b = self.matrix, other.matrix
        most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
        if most < 1 << 53:
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        return np.clip(a.astype(object) @ b.astype(object).T, -MOST, MOST).astype(np.int64).reshape(len(a), len(b))


def _row_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}

    def emit(dim: int) -> pa.RecordBatch:
        ids, labels, marks, matrix = (np.concatenate(x) for x in zip(*held.pop(dim)))
        order = np.lexsort((marks, labels, ids))
        return pa.RecordBatch.from_pylist([dict(zip(("dim", "ids", "labels", "marks", "kind", "matrix"), _packed(ids[order], labels[order], marks[order], matrix[order])))], schema=ROW_KIND)

    for batch in batches:
        ids, labels, marks = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
        vectors = batch.column(3)
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        for dim in np.unique(sizes):
            dim, at = int(dim), np.flatnonzero(sizes == dim)
            limit = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(dim, 1))))
            for part in np.array_split(at, -(-len(at) // limit)):
                matrix = values[(ends[part] - dim)[:, None] + np.arange(dim)]
                if dim in held and sum(len(x[0]) for x in held[dim]) + len(part) > limit:
                    yield emit(dim)
                held.setdefault(dim, []).append((ids[part], labels[part], marks[part], matrix))
    for dim in list(held):
        yield emit(dim)


ROW_KIND = pa.schema(
    [("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("marks", pa.binary()), ("kind", pa.string()), ("matrix", pa.binary())]
)


def row_blocks(rows: DataFrame) -> DataFrame:
    return rows.select("vec_id", "label", "mark", "q").mapInArrow(_row_blocks, PACKED)


def _anchor_block(group: pd.DataFrame) -> pd.DataFrame:
    out = []
    for dim, part in group.groupby(group.q.str.len()):
        limits = np.full((len(part), max(map(len, part.uppers))), NO_LIMIT, np.int64)
        for i, uppers in enumerate(part.uppers):
            limits[i, : len(uppers)] = uppers
        matrix = np.array(part.q.tolist(), np.int64).reshape(len(part), int(dim))
        arrays = [part[c].to_numpy(np.int64) for c in ("vec_id", "label", "mark")]
        out.append((int(part.anchors.iloc[0]), *_packed(*arrays, matrix), limits.tobytes(), part.least.to_numpy(np.int64).tobytes()))
    return pd.DataFrame(out, columns=["anchors", "dim", "ids", "labels", "marks", "kind", "matrix", "uppers", "least"])


def anchor_blocks(anchors: DataFrame, n_blocks: int) -> DataFrame:
    """Packed blocks of (vec_id, label, mark, q, uppers, least) rows, dealt evenly by a hash."""
    dealt = anchors.withColumn("anchors", F.pmod(F.xxhash64("vec_id", "mark"), F.lit(n_blocks)).cast("int"))
    return dealt.groupBy("anchors").applyInPandas(_anchor_block, f"anchors int, {PACKED}, uppers binary, least binary")


def _best(found: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The first k entries of every (anchor, slot), by score and id."""
    anchor, slot, score, ids = found
    order = np.lexsort((ids, -score, slot, anchor))
    anchor, slot, score, ids = (x[order] for x in found)
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1])
    starts = np.flatnonzero(new)
    rank = np.arange(len(anchor)) - np.repeat(starts, np.diff(np.append(starts, len(anchor))))
    return tuple(x[rank < k] for x in (anchor, slot, score, ids))


def _positives(a: Block, b: Block, k: int) -> tuple[np.ndarray, ...]:
    """The best k rows of each anchor's own label, the anchor itself left out."""
    score = a.scores(b)
    own = (a.ids[:, None] == b.ids) & (a.marks[:, None] == b.marks)
    fit = (a.labels[:, None] == b.labels) & ~own
    if score.shape[1] > 4 * k:  # leave out what is below the k-th best already
        kth = np.partition(np.where(fit, score, -2 * MOST), score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        fit &= score >= kth[:, None]
    anchor, row = np.nonzero(fit)
    return _best((anchor, np.zeros(len(anchor), np.int64), score[anchor, row], b.ids[row]), k)


def _in_slots(a: Block, b: Block, uppers: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The best k rows of another label in each of the anchors' slots."""
    score = a.scores(b)
    fit = (a.labels[:, None] != b.labels) & (score <= uppers[:, :1]) & (score >= least[:, None])
    anchor, row = np.nonzero(fit)
    score = score[anchor, row]
    slot = (uppers[anchor] >= score[:, None]).sum(axis=1) - 1
    return _best((anchor, slot, score, b.ids[row]), k)


FOUND = pa.schema([("anchor_id", pa.int64()), ("mark", pa.int64()), ("slot", pa.int32()), ("other_id", pa.int64()), ("score", pa.int64())])


def _combined(k: int, slots: bool):
    """Best rows of every pair of blocks, joined per block of anchors while the task lasts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[tuple[int, int], tuple[Block, tuple]] = OrderedDict()

        def emit(block: Block, found: tuple) -> pa.RecordBatch:
            anchor, slot, score, ids = found
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (block.ids[anchor], block.marks[anchor], slot.astype(np.int32), ids, score)], schema=FOUND)

        for batch in batches:
            for r in batch.to_pylist():
                a = Block(r["dim"], r["a_ids"], r["a_labels"], r["a_marks"], r["a_kind"], r["a_matrix"])
                b = Block(r["dim"], r["ids"], r["labels"], r["marks"], r["kind"], r["matrix"])
                if slots:
                    uppers = np.frombuffer(r["a_uppers"], np.int64).reshape(len(a.ids), -1)
                    found = _in_slots(a, b, uppers, np.frombuffer(r["a_least"], np.int64), k)
                else:
                    found = _positives(a, b, k)
                key = (r["anchors"], r["dim"])
                if key in held:
                    a, before = held.pop(key)
                    found = _best(tuple(map(np.concatenate, zip(before, found))), k)
                held[key] = (a, found)
                if len(held) > HELD:
                    yield emit(*held.popitem(last=False)[1])
        for kept in held.values():
            yield emit(*kept)

    return run


def _best_of_all(blocks: DataFrame, anchors: DataFrame, n_anchors: int, k: int, slots: bool) -> DataFrame:
    """(anchor_id, mark, slot, other_id, score): the best k rows per anchor and slot over all rows."""
    spark = blocks.sparkSession
    n_blocks = max(1, -(-n_anchors // BLOCK_ANCHORS))
    cells = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // n_blocks)
    packed = stored(anchor_blocks(anchors, n_blocks), "anchors")
    names = {c: f"a_{c}" for c in ("ids", "labels", "marks", "kind", "matrix", "uppers", "least")}
    dealt = packed.withColumnsRenamed(names).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    met = blocks.withColumn("cell", F.pmod(F.xxhash64("ids", "marks"), F.lit(cells)).cast("int"))
    met = met.withColumn("anchors", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    pairs = met.join(dealt, ["anchors", "cell", "dim"])
    found = pairs.select("anchors", "dim", *PARTS, *names.values()).mapInArrow(_combined(k, slots), "anchor_id long, mark long, slot int, other_id long, score long")
    order = Window.partitionBy("anchor_id", "mark", "slot").orderBy(F.desc("score"), "other_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


PARTS = ("ids", "labels", "marks", "kind", "matrix")


def _limits(score: Column, low: int, high: int) -> tuple[Column, Column]:
    """Least and greatest whole score s with low * score <= 100 * s <= high * score."""
    floor = lambda x: F.expr(f"({x} - pmod({x}, 100L)) div 100L")
    return -floor(f"({-low}L * score)"), floor(f"({high}L * score)")


def mine_hard_negatives(
    vectors: DataFrame, anchor_every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by `anchor_every`. A row of another label is a
    hard negative of a positive if its score is from `low` to `high` percent of the positive's.
    """
    rows = stored(taking_part(vectors, scale), "vectors")
    anchors = rows.filter(F.col("vec_id") % anchor_every == 0)
    n_anchors = anchors.count()
    blocks = stored(row_blocks(rows), "blocks")
    free = anchors.withColumns({"uppers": F.array(F.lit(0).cast("long")), "least": F.lit(0).cast("long")})
    best = _best_of_all(blocks, free, n_anchors, n_positives, slots=False)
    lower, upper = _limits(F.col("score"), low, high)
    positives = stored(best.select("anchor_id", "mark", "place", "other_id", "score", lower.alias("lower"), upper.alias("upper")), "positives")
    open_ = positives.filter("lower <= upper")
    limits = open_.groupBy("anchor_id", "mark").agg(
        F.sort_array(F.collect_set("upper"), asc=False).alias("uppers"), F.min("lower").alias("least")
    )
    own = (F.col("vec_id") == F.col("anchor_id")) & (F.col("mark") == F.col("_mark"))
    limited = anchors.join(limits.withColumnRenamed("mark", "_mark"), own).select("vec_id", "label", "mark", "q", "uppers", "least")
    chosen = _best_of_all(blocks, limited, n_anchors, n_negatives, slots=True)
    # At most n_positives * n_negatives rows per anchor; the best score comes first.
    merged = chosen.groupBy("anchor_id", "mark").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "other_id", "slot"))).alias("merged")
    )
    asked = open_.join(limits.select("anchor_id", "mark", "uppers"), ["anchor_id", "mark"]).join(merged, ["anchor_id", "mark"])
    slot = F.array_position("uppers", F.col("upper")) - 1
    window = F.filter("merged", lambda x: (x["slot"] >= F.col("from")) & (-x["down"] >= F.col("lower")))
    told = asked.withColumn("from", slot).select("*", F.posexplode(F.slice(window, 1, n_negatives)).alias("at", "row"))
    return told.select(
        "anchor_id", F.col("other_id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
        F.col("row.other_id").alias("negative_id"), F.col("score").alias("positive_score"), (-F.col("row.down")).alias("negative_score"),
    )
