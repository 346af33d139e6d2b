"""Secrets in texts: fixed patterns, and strings near sensitive words that do not compress.

The fixed patterns are assignments of a password or key, access key ids, and long hexadecimal
runs. Beside them every long token with letters and digits that begins within `REACH`
characters after a sensitive word is a candidate. Its novelty is what it adds, in bytes, to
the compressed size of the code around it, by zstandard primed with a dictionary of
identifiers; a candidate that adds at least `NOVEL_PERCENT` of its length is reported.
Names, paths and words compress against the dictionary and the code around them; keys do not.

The dictionary holds the commonest identifiers of the whole corpus, counted per task and then
by Spark, up to `DICTIONARY_BYTES`; it alone is sent to the workers. Texts are scanned within
their rows, and nothing but the counts is shuffled.

Defined cases. A null text is an empty one and has no secret. Places are code points, the end
is exclusive. Very long texts are searched whole, in time in proportion to their length.
Repeated rows are judged alike, each for itself. No rows give no rows and a dictionary of the
fixed words. The input's columns come back inside `row`, so names cannot clash.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stored

# Functions that run in Python workers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ASSIGN, ACCESS, HEX, NOVEL = "assign", "access", "hex", "novel"
KINDS = (ASSIGN, ACCESS, HEX, NOVEL)
ASSIGNMENT = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGNMENT_HINTS = ("passw", "secret", "token", "apikey", "api_key")
MIN_ASSIGNED = 12
# Runs of at least this length are the runs of any length with the short ones dropped.
ACCESS_ID = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX_RUN = re.compile(r"[0-9a-f]{16,}")

SENSITIVE_HINTS = (*ASSIGNMENT_HINTS, "pwd", "passphrase", "credential", "access_key", "private_key", "bearer", "authorization")
SENSITIVE = re.compile("password|passwd|secret|token|api_?key|pwd|passphrase|credential|access_key|private_key|bearer|authorization", re.I | re.A)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}+")
REACH = 48
BEFORE, AFTER = 96, 48
NOVEL_PERCENT = 80
LEVEL = 19

DICTIONARY_BYTES = 32_768
IDENTIFIER = re.compile("[A-Za-z_]{4,24}+")
# Distinct identifiers that a task counts before it hands them on.
HELD = 200_000
# Words of code that prime the dictionary whatever the corpus.
CODE = (
    "import return function class const public private static void string value config client request response error result index "
    "length token secret password user name http https localhost example test data file path json true false null none self this "
    "get set update delete create insert select from where access credentials authorization bearer api_key private_key access_key"
)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["identifier", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update(IDENTIFIER.findall(text.as_py() or ""))
            if len(counts) > HELD:
                yield emit(counts)
                counts = Counter()
    if counts:
        yield emit(counts)


def identifier_counts(docs: DataFrame) -> DataFrame:
    """(identifier, n): how often each run of 4 to 24 letters or underscores occurs in all texts."""
    partial = docs.select("text").mapInArrow(_counted, "identifier string, n long")
    return partial.groupBy("identifier").agg(F.sum("n").alias("n"))


def identifier_dictionary(docs: DataFrame, size: int = DICTIONARY_BYTES) -> bytes:
    """The commonest identifiers, the commonest last, in at most `size` bytes."""
    counts, wanted = stored(identifier_counts(docs), "identifiers"), size // 5 + 1
    # Only the highest powers of two that hold enough of them are ranked.
    by_bits = dict(counts.groupBy(F.length(F.bin("n"))).count().collect())
    bits, held = max(by_bits, default=1), 0
    while bits > 1 and (held := held + by_bits.get(bits, 0)) < wanted:
        bits -= 1
    top = counts.filter(F.col("n") >= 1 << (bits - 1)).orderBy(F.desc("n"), "identifier").limit(wanted).collect()
    words, left = [], size - len(CODE) - 1
    for row in top:
        left -= len(row.identifier) + 1
        if left < 0:
            break
        words.append(row.identifier)
    return " ".join([CODE, *reversed(words)]).encode()


@cache
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)


def novelty(text: str, start: int, end: int, dictionary: bytes) -> int:
    """Bytes that text[start:end] adds to the compressed code around it."""
    size = lambda x: len(_compressor(dictionary).compress(x.encode()))
    before, after = text[max(0, start - BEFORE) : start], text[end : end + AFTER]
    return size(before + text[start:end] + after) - size(before + after)


def _base_spans(text: str, low: str) -> list[tuple]:
    spans = []
    if any(hint in low for hint in ASSIGNMENT_HINTS):
        spans += [(m.start(), 0, m.end(), None) for m in ASSIGNMENT.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), None) for m in ACCESS_ID.finditer(text)]
    return spans + [(m.start(), 2, m.end(), None) for m in HEX_RUN.finditer(text)]


def _novel_spans(text: str, low: str, taken: list[tuple], dictionary: bytes) -> list[tuple]:
    if not any(hint in low for hint in SENSITIVE_HINTS):
        return []
    found, beyond = {}, 0
    taken = sorted((s, e) for s, _, e, _ in taken)
    at = 0
    for word in SENSITIVE.finditer(text):
        place = max(word.end(), beyond)
        while m := CANDIDATE.search(text, place, max(place, word.end() + REACH + 15)):
            start = m.start()
            whole = CANDIDATE.match(text, start)  # the search saw only the first characters of it
            place = beyond = whole.end()
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            clear = at == len(taken) or taken[at][0] >= whole.end()
            if clear and re.search("[0-9]", whole[0]) and re.search("[A-Za-z]", whole[0]):
                found[start, whole.end()] = novelty(text, start, whole.end(), dictionary)
    return [(s, 3, e, n) for (s, e), n in found.items() if 100 * n >= NOVEL_PERCENT * (e - s)]


def spans_of(text: str | None, dictionary: bytes) -> list[tuple[int, int, int, int | None]]:
    """(start, kind's number, end, novelty) of all secrets in a text, in order."""
    if not text:
        return []
    low = text.lower()
    base = _base_spans(text, low)
    return sorted(base + _novel_spans(text, low, base, dictionary), key=lambda s: s[:3])


SECRETS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.int32())]))


def _scanned(dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[(KINDS[k], s, e, n) for s, k, e, n in spans_of(text.as_py(), dictionary)] for text in batch.column(1)]
            dicts = [[dict(zip(("kind", "start", "end", "novelty"), x)) for x in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dicts, SECRETS)], ["row", "secrets"])

    return run


def find_secrets(docs: DataFrame, keep: list[str] | None = None, dictionary: bytes | None = None) -> DataFrame:
    """(row, secrets): the kept columns of every document and its spans (kind, start, end, novelty).

    Spans are in order of start, then kind; only those found by novelty carry one.
    """
    if dictionary is None:
        dictionary = identifier_dictionary(docs)
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row")
    plain = docs.select(row, "text")
    secrets = T.StructType.fromDDL("secrets array<struct<kind: string, start: bigint, end: bigint, novelty: int>>")
    return plain.mapInArrow(_scanned(dictionary), T.StructType([plain.schema["row"], *secrets]))


def told(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
