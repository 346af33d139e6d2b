"""Shared pieces of the text operators: word patterns, row identity, byte-level hashing.

The NumPy part works on the UTF-8 bytes of one Arrow batch at a time. A hash of any
run of bytes comes from two prefix sums, so words, shingles and long substrings cost
the same and no Python object is made per word.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Functions that run in Python workers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Java pattern of a word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes handled at once; temporary arrays take some tens of times as much.
PIECE = 1 << 19

Bytes = np.ndarray


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else, whatever the locale."""
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Words of a text as a long; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """A 64-bit identity of a text; null and empty differ."""
    return F.xxhash64(text.isNull(), text)


def with_rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text, text_key): whole rows as structs, so that their names never clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(whole.alias("row"), "doc_id", "text", text_key(F.col("text")).alias("text_key"))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    start = np.uint64(seed * 0x4F1BBCDCBFA53E0B & (1 << 64) - 1)
    return mix(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_table(fold_case: bool) -> np.ndarray:
    table = seeded(11, 256)
    if fold_case:
        table[65:91] = table[97:123]
    return table


BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)


class Powers:
    """Powers of BASE and of its inverse, grown on demand and kept per worker."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, PIECE + 1)
            for name, base in (("up", BASE), ("down", INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up, cls.down


def prefix_sums(data: Bytes, table: np.ndarray) -> np.ndarray:
    """S with hash(data[a:b]) = (S[b] - S[a]) * BASE**-a."""
    up, _ = Powers.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes between starts and ends."""
    _, down = Powers.upto(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def text_bytes(column: pa.Array) -> tuple[Bytes, np.ndarray]:
    """The bytes of a string column and where each row's begin; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + n + 1] if n else np.zeros(1)
    at = at.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, or of one longer row."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


# Bytes that end a word, by pattern.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: Bytes, offsets: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of all rows start and end, and each row's first word's number."""
    inside = ~breaks[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    stops = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[stops] = inside[stops]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: Bytes, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    return span_hashes(prefix_sums(data, table), starts, ends)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the last k - 1 entries have no meaning."""
    factors = seeded(23, k) | np.uint64(1)
    n = len(words)
    total = np.zeros(n, np.uint64)
    for i in range(min(k, n)):
        total[: n - i] += words[i:] * factors[i]
    return mix(total)
