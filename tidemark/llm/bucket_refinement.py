"""Exact removal of repeated byte strings by bucket-pointer refinement.

A suffix order is needed only as far as `SPAN` bytes, and only where strings repeat:

1. Initial q-gram buckets. Every window of SPAN bytes points to its least q-gram (the
   leftmost of equals), so equal windows point to equal q-grams at equal offsets. A
   bucket holds the places of one q-gram; buckets with one place hold no repeat.
2. Refinement. The windows that point to one place form a run; a bucket is refined by
   the identifiers of all its run's later offsets at once. Places that stay together
   repeat as a whole, and every window of their runs is settled.
3. The rest, at the edges of repeats: each window is put into the bucket named by the
   q-gram buckets at its start and at SPAN - GRAM bytes further, which together cover it,
   as in prefix doubling. A bucket with two places is a repeat.

Identifiers are 64-bit hashes, which differ for different strings but for chance. Windows
of one place never meet in a task: buckets are counted by aggregates, and counts are
joined back, so a string that a third of all texts hold is no hot group.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text
from tidemark.llm.text import text_key
from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPAN = 200
GRAM = 101
# Windows per q-gram position: a window of SPAN bytes has this many q-grams.
REACH = SPAN - GRAM + 1
PLACE = np.uint64((1 << 31) - 1)
# Runs are kept as first * RUN + (last - first); a run has at most REACH windows.
RUN = 128


def segments(offsets: np.ndarray, limit: int = text.PIECE) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row, from byte, to byte): rows together, or a part of one long row.

    Parts of a long row overlap so that each of its windows lies in just one part.
    """
    for a, b in text.pieces(offsets, limit):
        start, stop = int(offsets[a]), int(offsets[b])
        if b - a > 1 or stop - start <= 2 * limit:
            yield a, b, start, stop
            continue
        for at in range(start, max(start + 1, stop - SPAN + 1), limit):
            yield a, b, at, min(stop, at + limit + SPAN - 1)


def gram_hashes(sums: np.ndarray) -> np.ndarray:
    """Identifier of the GRAM bytes from each byte on."""
    n = max(len(sums) - GRAM, 0)
    _, down = text.Powers.upto(len(sums))
    x = (sums[GRAM:] - sums[:n]) * down[:n]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def least_in_reach(keys: np.ndarray) -> np.ndarray:
    """Minimum of each REACH consecutive keys, from running minima of blocks."""
    n = len(keys) - REACH + 1
    padded = np.full(-(-len(keys) // REACH) * REACH, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, REACH)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[REACH - 1 : REACH - 1 + n])


def runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, refined bucket, first window, last window) of every run in some rows' bytes."""
    nothing = np.zeros(0, np.uint64)
    if len(data) < SPAN:
        return nothing, nothing, nothing.astype(np.int64), nothing.astype(np.int64)
    sums = text.prefix_sums(data, text.byte_table(False))
    grams = gram_hashes(sums)
    least = least_in_reach((grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64))
    sizes = np.diff(bounds)
    change = np.zeros(len(data) + 1, np.int32)
    long = sizes >= SPAN
    np.add.at(change, bounds[:-1][long], 1)
    np.add.at(change, bounds[1:][long] - SPAN + 1, -1)
    windows = np.flatnonzero(np.cumsum(change[: len(least)]))
    if not len(windows):
        return nothing, nothing, nothing.astype(np.int64), nothing.astype(np.int64)
    place = (least[windows] & PLACE).astype(np.int64)
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)))
    at = np.flatnonzero(new)
    first, last = windows[at], windows[np.concatenate((at[1:], [len(windows)])) - 1]
    return grams[place[at]], text.span_hashes(sums, first, last + SPAN), first, last


def anchors(docs: DataFrame) -> DataFrame:
    """(bucket, refined, text_key, run) of every row's runs; one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text.text_bytes(batch.column("text"))
            keys = batch.column("text_key").to_numpy()
            for a, b, start, stop in segments(offsets):
                bounds = np.clip(offsets[a : b + 1], start, stop) - start
                bucket, refined, first, last = runs(data[start:stop], bounds)
                row = a + np.searchsorted(bounds, first, "right") - 1
                at = first + start - offsets[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (bucket.view(np.int64), refined.view(np.int64), keys[row], at * RUN + (last - first))],
                    names=["bucket", "refined", "text_key", "run"],
                )

    rows = docs.select(text_key(F.col("text")).alias("text_key"), "text").filter(F.octet_length("text") >= SPAN)
    return rows.mapInArrow(run, "bucket long, refined long, text_key long, run long")


def windows_of(requests: DataFrame, docs: DataFrame) -> DataFrame:
    """(window, text_key, at) of all windows of the requested (text_key, run) rows.

    `window` is named by the buckets of its first and its last GRAM bytes.
    """
    wanted = requests.groupBy("text_key").agg(F.collect_set("run").alias("runs")).withColumnRenamed("text_key", "_key")
    rows = docs.select(text_key(F.col("text")).alias("text_key"), "text").filter(F.octet_length("text") >= SPAN)
    one = Window.partitionBy("text_key").orderBy(F.lit(0))
    rows = rows.withColumn("_n", F.row_number().over(one)).filter("_n = 1")
    joined = rows.join(wanted, F.col("text_key") == F.col("_key")).select("text_key", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text.text_bytes(batch.column("text"))
            keys, lists = batch.column("text_key").to_numpy(), batch.column("runs")
            ends = lists.offsets.to_numpy()
            packed = lists.flatten().to_numpy()
            ends = ends - ends[0]
            for row in range(batch.num_rows):
                own = np.sort(packed[ends[row] : ends[row + 1]])
                first, count = own // RUN, own % RUN + 1
                at = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                found = []
                begin, stop = int(offsets[row]), int(offsets[row + 1])
                for low in range(0, stop - begin, text.PIECE):  # a long text in parts
                    here = at[(at >= low) & (at < low + text.PIECE)]
                    if len(here):
                        part = data[begin + low : min(stop, begin + low + text.PIECE + SPAN)]
                        grams = gram_hashes(text.prefix_sums(part, text.byte_table(False)))
                        here = here - low
                        found.append(text.mix(grams[here] * np.uint64(text.BASE) + text.mix(grams[here + SPAN - GRAM])))
                names = np.concatenate(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array(np.full(len(at), keys[row])), pa.array(at)],
                    names=["window", "text_key", "at"],
                )

    return joined.mapInArrow(run, "window long, text_key long, at long")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(text_key, run): runs of window starts whose SPAN bytes start anywhere else too."""
    buckets = anchors(docs).groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("bucket")
    buckets = stored(buckets, "gram-buckets")
    places = stored(anchors(docs).join(buckets, "bucket"), "gram-places")
    classes = stored(places.groupBy("bucket", "refined").agg(F.count(F.lit(1)).alias("n")), "gram-classes")
    mixed = classes.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("bucket", F.lit(True).alias("open"))
    classes = classes.join(mixed, "bucket", "left").select("bucket", "refined", "n", F.coalesce("open", F.lit(False)).alias("open"))
    refined = stored(places.join(classes, ["bucket", "refined"]), "gram-refined")
    settled = refined.filter("n > 1").select("text_key", "run").distinct()
    # Places left alone, and one place of each settled class that one of them may repeat.
    one = Window.partitionBy("bucket", "refined").orderBy("text_key", "run")
    member = refined.filter("open AND n > 1").withColumn("_i", F.row_number().over(one)).filter("_i = 1")
    requests = refined.filter("open AND n = 1").select("text_key", "run").union(member.select("text_key", "run")).distinct()
    edges = stored(windows_of(stored(requests, "gram-requests"), docs), "edge-windows")
    twice = edges.groupBy("window").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("window")
    found = edges.join(twice, "window").select("text_key", (F.col("at") * RUN).alias("run"))
    return settled.union(found)


def remove_repeats(docs: DataFrame, with_texts: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of `docs`.

    Every byte covered by SPAN bytes that also start elsewhere in `docs`, the same row
    included, is removed. `with_texts` adds `kept`, the remaining bytes, and `spans`, the
    removed (start, end) byte ranges. A null text is empty; texts shorter than SPAN lose
    nothing; repeated rows remove each other; no rows give no rows. Other columns are not
    looked at.
    """
    found = stored(repeated_runs(docs), "repeat-runs")
    spans = found.groupBy("text_key").agg(F.collect_set("run").alias("runs")).withColumnRenamed("text_key", "_key")
    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    joined = rows.join(spans, F.col("text_key") == F.col("_key"), "left").select("doc_id", "text", "runs")
    fields = [
        ("n_bytes", "long", pa.int64()), ("n_removed", "long", pa.int64()), ("n_spans", "long", pa.int64()),
        ("kept_sha256", "string", pa.string()), ("kept", "binary", pa.binary()),
        ("spans", "array<struct<start: long, end: long>>", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ][: 6 if with_texts else 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text.text_bytes(batch.column("text"))
            out = [removed(data[a:b], own) for a, b, own in zip(offsets, offsets[1:], batch.column("runs").to_pylist())]
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, kind) for c, (_, _, kind) in zip(columns, fields))],
                names=["doc_id", *(name for name, _, _ in fields)],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, ", ".join([f"doc_id {id_type}", *(f"{name} {kind}" for name, kind, _ in fields)]))


def removed(whole: np.ndarray, packed: list[int] | None) -> tuple:
    """Sizes, digest, remaining bytes and removed ranges of one text, given its repeated runs."""
    if not packed:
        return len(whole), 0, 0, hashlib.sha256(whole).hexdigest(), whole.tobytes(), []
    run = np.sort(np.array(packed, np.int64))
    start, end = run // RUN, run // RUN + run % RUN + SPAN
    far = np.maximum.accumulate(end)
    at = np.flatnonzero(np.concatenate(([True], start[1:] > far[:-1])))
    start, end = start[at], far[np.concatenate((at[1:], [len(far)])) - 1]
    gaps = zip(np.concatenate(([0], end)).tolist(), np.concatenate((start, [len(whole)])).tolist())
    kept = b"".join(whole[a:b].tobytes() for a, b in gaps)
    spans = [{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist())]
    return len(whole), len(whole) - len(kept), len(at), hashlib.sha256(kept).hexdigest(), kept, spans
