"""Token sequences as length-delimited binary records with a separate offset index.

A data file is `MAGIC`, then records: the payload's length (8 bytes), a masked checksum
of those 8 bytes (4), the payload, and its masked checksum (4), all little-endian. A
payload holds token ids of 2 bytes each, or 4 where the vocabulary needs it. The
checksum is zlib's CRC-32, rotated right by 15 bits plus a constant, so that checksums
stored inside checksummed data stay harmless.

Each task writes one file under a name of its own and returns the index rows of that
file; Spark commits these as Parquet. A lost or repeated task leaves at most a file that
no index row names. Files are reached through `pyarrow.fs`, by the scheme of the folder.
"""

from __future__ import annotations

import re
import struct
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bpe
from tidemark.llm.bpe import END_ID, worker_encoder
from tidemark.llm.text import text_key
from tidemark.session import new_folder, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = b"TOKREC01"
MASK_DELTA = 0xA282EAD8
HEAD, TAIL = 12, 4
# Bytes fetched at once.
READ_BYTES = 4 << 20

INDEX = "part int, seq long, doc_id {id}, text_key long, file string, position long, n_bytes long, id_bytes int, n_tokens long, local_start long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(record: bytes) -> bytes:
    """The payload of one whole record; a wrong length or checksum is an error."""
    (n,), (check,) = struct.unpack_from("<Q", record), struct.unpack_from("<I", record, 8)
    if masked_crc(record[:8]) != check or len(record) != HEAD + n + TAIL:
        raise ValueError("token record: the length does not match its checksum")
    payload = record[HEAD : HEAD + n]
    if masked_crc(payload) != struct.unpack_from("<I", record, HEAD + n)[0]:
        raise ValueError("token record: the ids do not match their checksum")
    return payload


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder named as Spark names it."""
    if "://" not in uri:
        uri = "file://" + re.sub(r"^file:", "", uri)
    return fs.FileSystem.from_uri(uri)


def write_records(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, folder: str | None = None,
    n_files: int | None = None,
) -> DataFrame:
    """Encode every text, append `end_id`, write records in ascending doc_id; return the index.

    The index has a row per row of `docs`: its file, the record's position and bytes, its
    number of ids and, as `start`, all ids before it. Null ids come first, equal ids in
    order of their texts' hashes; a null or empty text is `end_id` alone; a repeated row
    is written again; no rows give an empty index. Other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-records")
    path = tokenizer or bpe.tokenizer_path()
    order = ["doc_id", "text_key"]
    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    rows = rows.repartitionByRange(*([n_files] if n_files else []), *order).sortWithinPartitions(*order)
    schema = INDEX.format(id=docs.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        part, seq, start, at = TaskContext.get().partitionId(), 0, 0, len(MAGIC)
        file, out, encoder = f"part-{part:06d}-{uuid.uuid4().hex}.rec", None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out, encoder = files.open_output_stream(f"{root}/{file}"), worker_encoder(path)
                end = np.array([end_id], encoder.dtype).tobytes()
                out.write(MAGIC)
            sizes = []
            for ids in encoder.encode(batch.column("text")):
                record = frame(ids + end)
                out.write(record)
                sizes.append(len(record))
            n = len(sizes)
            sizes = np.array(sizes, np.int64)
            tokens = (sizes - HEAD - TAIL) // encoder.width
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n)),
                    batch.column("doc_id"), batch.column("text_key"), pa.array([file] * n, pa.string()),
                    pa.array(at + np.cumsum(sizes) - sizes), pa.array(sizes),
                    pa.array(np.full(n, encoder.width, np.int32)), pa.array(tokens), pa.array(start + np.cumsum(tokens) - tokens),
                ],
                names=[f.split()[0] for f in schema.split(", ")],
            )
            seq, at, start = seq + n, at + int(sizes.sum()), start + int(tokens.sum())
        if out is not None:
            out.close()

    written = stored(rows.mapInArrow(run, schema), "token-index")
    # One row per file: ids in all files before it.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = written.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_before"))
    return (
        written.join(parts, F.col("part") == F.col("_part"))
        .withColumn("start", F.col("_before") + F.col("local_start"))
        .withColumn("folder", F.lit(folder))
        .drop("_part", "_before", "local_start")
    )


def map_records(
    index: DataFrame, of_record: Callable[[bytes, int], tuple], columns: str, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Read records named by index rows, in any subset or order, and check them.

    `of_record` gets a record's ids as bytes and the bytes per id and returns the values
    of `columns`; the index columns `keep` come before them. Rows are gathered by file,
    and a file's neighbouring records are fetched together.
    """
    schema = T.StructType([*index.select(*keep).schema, *T._parse_datatype_string(columns)])
    n_kept = len(keep)
    needed = index.select(*keep, "folder", "file", "position", "n_bytes", "id_bytes").repartition("file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, opened, arrow = None, None, None
        for batch in batches:
            folders, names, at, sizes, widths = (batch.column(n_kept + i).to_pylist() for i in range(5))
            found, i = [], 0
            while i < len(at):
                j, end = i, at[i]
                while j < len(at) and names[j] == names[i] and at[j] == end and (j == i or end + sizes[j] - at[i] <= READ_BYTES):
                    end += sizes[j]
                    j += 1
                if opened != (folders[i], names[i]):
                    if source is not None:
                        source.close()
                    files, root = open_folder(folders[i])
                    source, opened = files.open_input_file(f"{root}/{names[i]}"), (folders[i], names[i])
                block = source.read_at(end - at[i], at[i])
                for k in range(i, j):
                    first = at[k] - at[i]
                    found.append(of_record(unframe(block[first : first + sizes[k]]), widths[k]))
                i = j
            if arrow is None:
                arrow = [pa_type(c.split(" ", 1)[1]) for c in columns.split(", ")]
            values = list(zip(*found)) if found else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n_kept], *(pa.array(v, t) for v, t in zip(values, arrow))], names=schema.names
            )
        if source is not None:
            source.close()

    return needed.sortWithinPartitions("file", "position").mapInArrow(run, schema)


def pa_type(name: str) -> pa.DataType:
    return {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}[name]


def ids_of(payload: bytes, width: int) -> np.ndarray:
    return np.frombuffer(payload, f"<u{width}").astype("<u4")


def read_ids(index: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of the records that `index` names."""
    return map_records(index, lambda p, w: (ids_of(p, w).astype(np.int64).tolist(),), "ids array<long>", ("doc_id", "start"))


def read_digests(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), counted and summed from the files."""

    def digest(payload: bytes, width: int) -> tuple[int, int]:
        ids = ids_of(payload, width)
        return len(ids), zlib.crc32(ids.tobytes())

    return map_records(index, digest, "n_tokens long, ids_crc32 long", ("doc_id", "start"))
