"""Token counts of flat token files that have no index, from their end-of-document ids.

Files are scanned in blocks of a fixed number of ids, each on its own: NumPy finds the end
ids of a block at once. A document may begin in one block and end in a later one, so the
first document of a block lacks its start. A prefix scan over one row per block, first
within groups of blocks and then over the groups, gives the last end before each block and
the number of ends so far, which stitches the pieces together.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.bpe import worker_encoder
from tidemark.llm.text import text_key
from tidemark.llm.token_records import open_folder
from tidemark.session import new_folder, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The id that the vocabulary itself has for the end of a text.
SEPARATOR = 50256
BLOCK_IDS = 2 << 20
# Blocks of one window of the prefix scan.
GROUP_BLOCKS = 1024


def write_token_files(
    docs: DataFrame, tokenizer: str | None = None, separator: int = SEPARATOR, folder: str | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Encode every text into flat files, each text followed by `separator`; return the files.

    One row per file: (folder, part, file, n_ids, id_bytes). Texts are written where they
    are read, one file per task and nothing shuffled; `ordered` first sorts them by
    doc_id, so that files of ascending `part` hold ascending ids. Strings of special tokens inside a text are ordinary text,
    so the separator occurs at ends only. A lost or repeated task leaves at most a file that
    no row names. A null text is its separator alone.
    """
    folder = folder or new_folder(docs.sparkSession, "token-files")
    path = tokenizer or bpe.tokenizer_path()
    rows = docs.select("text")
    if ordered:
        order = ["doc_id", "text_key"]
        keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
        rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        part, n, out, encoder = TaskContext.get().partitionId(), 0, None, None
        file = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                encoder = worker_encoder(path, True)
                out, end = files.open_output_stream(f"{root}/{file}"), np.array([separator], encoder.dtype).tobytes()
            for ids in encoder.encode(batch.column("text")):
                out.write(ids + end)
                n += len(ids) // encoder.width + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [file], "n_ids": [n], "id_bytes": pa.array([encoder.width], pa.int32())}
            )

    written = stored(rows.mapInArrow(run, "part int, file string, n_ids long, id_bytes int"), "token-files")
    return written.withColumn("folder", F.lit(folder))


def scan_blocks(files: DataFrame, separator: int = SEPARATOR, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(part, block, k, start, end): the ends found in each block, in order k.

    Positions count ids of the file. `start` is null for a block's first end; a row with k
    null tells the block's number of ends as `start` and its last end as `end`.
    """
    blocks = files.filter("n_ids > 0").select(
        "folder", "file", "part", "id_bytes", "n_ids",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_ids") - 1) / block_ids).cast("long"))).alias("block"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, root = open_folder(row["folder"])
                first, width = row["block"] * block_ids, row["id_bytes"]
                count = min(block_ids, row["n_ids"] - first)
                with files.open_input_file(f"{root}/{row['file']}") as source:
                    ids = np.frombuffer(source.read_at(count * width, first * width), f"<u{width}")
                end = np.flatnonzero(ids == separator) + first
                n = len(end)
                start = pa.array(np.concatenate(([0], end[:-1] + 1)) if n else end, mask=np.arange(n) == 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n + 1, row["part"], np.int32)), pa.array(np.full(n + 1, row["block"])),
                        pa.array(np.arange(n + 1), mask=np.arange(n + 1) == n),
                        pa.concat_arrays([start, pa.array([n], pa.int64())]),
                        pa.concat_arrays([pa.array(end), pa.array([int(end[-1]) if n else None], pa.int64())]),
                    ],
                    names=["part", "block", "k", "start", "end"],
                )

    spread = blocks.repartition("part", "block")
    return spread.mapInArrow(run, "part int, block long, k long, start long, end long")


def count_tokens(files: DataFrame, separator: int = SEPARATOR, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(doc_no, part, start, n_tokens, ended): one row per document of flat token files.

    Documents are numbered through all files in order of `part`; `start` counts ids of the
    file, and n_tokens includes the separator. What follows a file's last separator is a
    document with `ended` false; no file, or an empty one, has no document.
    """
    found = stored(scan_blocks(files, separator, block_ids), "separators")
    blocks = found.filter("k IS NULL").select("part", "block", F.col("start").alias("n"), F.col("end").alias("last"))
    group = F.floor(F.col("block") / GROUP_BLOCKS).alias("group")
    inside = Window.partitionBy("part", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("part").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = blocks.groupBy("part", group).agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    groups = groups.select(
        "part", "group", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("_n"), F.max("last").over(across).alias("_last")
    )
    # Documents of earlier files: one row per file.
    size = files.select(F.col("part").alias("_part"), "n_ids")
    totals = blocks.groupBy("part").agg(F.sum("n").alias("n"), F.max("last").alias("last")).join(size, F.col("part") == F.col("_part"))
    rest = F.col("n_ids") - F.coalesce(F.col("last") + 1, F.lit(0))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tails = stored(
        totals.withColumn("rest", rest).withColumn("docs", F.col("n") + (F.col("rest") > 0).cast("long"))
        .select("part", "n", "n_ids", "rest", F.coalesce(F.sum("docs").over(earlier), F.lit(0)).cast("long").alias("before")),
        "file-tails",
    )
    stitched = (
        blocks.select("*", group)
        .withColumn("n_in", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .withColumn("last_in", F.max("last").over(inside))
        .join(groups, ["part", "group"]).join(tails.select("part", "before"), "part")
        .select("part", "block", (F.col("before") + F.col("_n") + F.col("n_in")).alias("first_no"), F.greatest("last_in", "_last").alias("previous"))
    )
    ended = found.filter("k IS NOT NULL").join(stored(stitched, "stitched-blocks"), ["part", "block"])
    start = F.coalesce("start", F.col("previous") + 1, F.lit(0).cast("long"))
    whole = ended.select(
        (F.col("first_no") + F.col("k")).cast("long").alias("doc_no"), "part", start.alias("start"),
        (F.col("end") + 1 - start).alias("n_tokens"), F.lit(True).alias("ended"),
    )
    open_ = tails.filter("rest > 0").select(
        (F.col("before") + F.col("n")).cast("long").alias("doc_no"), "part", (F.col("n_ids") - F.col("rest")).alias("start"),
        F.col("rest").alias("n_tokens"), F.lit(False).alias("ended"),
    )
    return whole.union(open_)
