"""Benchmark decontamination with a positional inverted index of the training texts.

The index has a row per (term, text): the term's positions. Only terms of the benchmark
are indexed as long as its vocabulary is small enough to send to the workers; beyond
that all terms are, with the same results. Each benchmark window is looked up from its
rarest terms: their lists, moved back by the terms' offsets in the window, are
intersected, and the few places left are held against the other terms' lists.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text
from tidemark.llm.text import text_key, with_rows
from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW_WORDS = 10
# Terms sent to every worker at most: 8 bytes each.
MAX_SENT_TERMS = 2_000_000

# Bytes between terms: all of ASCII but letters and digits.
BREAKS = np.zeros(256, bool)
BREAKS[:128] = True
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all rows in a line, and where each row's begin; A-Z counts as a-z."""
    starts, ends, first = text.word_spans(data, offsets, BREAKS)
    return text.word_hashes(data, starts, ends, text.byte_table(True)), first


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """(item_id, window, terms): every `width` consecutive terms of an item, or all if fewer.

    `window` names the sequence of terms, so equal windows of any items share it.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text.text_bytes(batch.column("text"))
            hashes, first = terms(data, offsets)
            rows, lists = [], []
            for row, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                own = hashes[a:b].view(np.int64)
                for i in range(max(1, len(own) - width + 1) if len(own) else 0):
                    rows.append(row)
                    lists.append(own[i : i + width].tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(rows, pa.int64())), pa.array(lists, pa.list_(pa.int64()))],
                names=["item_id", "terms"],
            )

    found = benchmark.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<long>")
    return found.select("item_id", F.xxhash64("terms").alias("window"), "terms")


def positional_index(docs: DataFrame, vocabulary: np.ndarray | None) -> DataFrame:
    """(doc_id, text_key, term, positions); a row without term has a text's number of words.

    Postings carry the text's key only: equal texts have equal postings.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast(np.sort(vocabulary))
    low = np.uint64((1 << 20) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if sent is None else sent.value
        if known is not None:
            maybe = np.zeros(1 << 20, bool)
            maybe[known & low] = True
        for batch in batches:
            data, offsets = text.text_bytes(batch.column("text"))
            for a, b in text.pieces(offsets):
                hashes, first = terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                own, counts = batch.slice(a, b - a), np.diff(first)
                row = np.repeat(np.arange(b - a), counts)
                position = np.arange(len(hashes)) - np.repeat(first[:-1], counts)
                if known is None:
                    kinds, code = np.unique(hashes, return_inverse=True)
                else:
                    kinds = known
                    hit = np.flatnonzero(maybe[hashes & low])
                    code = np.minimum(np.searchsorted(known, hashes[hit]), max(len(known) - 1, 0))
                    same = known[code] == hashes[hit] if len(known) else np.zeros(0, bool)
                    code, row, position = code[same], row[hit[same]], position[hit[same]]
                group = row * len(kinds) + code
                order = np.argsort(group, kind="stable")
                group, position = group[order], position[order]
                at = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)
                heads, n = group[at], len(at)
                owner, term = (heads // max(len(kinds), 1), kinds[heads % max(len(kinds), 1)]) if n else (at, kinds[:0])
                # Postings, then one row per text with its length.
                lists = np.concatenate((position, counts)).astype(np.int32)
                ends = np.concatenate((at, len(position) + np.arange(len(counts) + 1))).astype(np.int32)
                ids = own.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.nulls(n, ids.type), ids]),
                        pa.concat_arrays([own.column("text_key").take(pa.array(owner)), own.column("text_key")]),
                        pa.concat_arrays([pa.array(term.view(np.int64)), pa.nulls(b - a, pa.int64())]),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(lists)),
                    ],
                    names=["doc_id", "text_key", "term", "positions"],
                )

    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, term long, positions array<int>")


def _lists(index: DataFrame, picked: DataFrame, slop: int) -> DataFrame:
    """(text_key, window, start): the picked terms' places, moved back by their offsets."""
    joined = index.join(picked, "term").select("text_key", "window", F.explode("positions").alias("p"), "offset")
    return joined.select("text_key", "window", (F.col("p") - F.col("offset")).alias("start")).filter(F.col("start") >= -slop).distinct()


def find_windows(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """(text_key, window, start, exact) of all matches of `windows` (window, terms) in `index`.

    With slop 0 these are exact phrases. Otherwise a match has every term within `slop`
    words of its place after `start`, the place by the rarest term, and `exact` tells the
    phrases among them.
    """
    slots = stored(
        windows.dropDuplicates(["window"]).select("window", F.size("terms").alias("n_terms"), F.posexplode("terms").alias("offset", "term")),
        "window-terms",
    )
    frequency = index.groupBy("term").agg(F.sum(F.size("positions")).alias("freq"))
    counted = slots.join(stored(frequency.join(slots.select("term").distinct(), "term", "left_semi"), "term-counts"), "term", "left")
    # A window with a term that no text holds has no match.
    possible = counted.groupBy("window").agg(F.max(F.col("freq").isNull()).alias("_absent")).filter("NOT _absent").select("window")
    distinct = counted.join(possible, "window").groupBy("window", "term", "freq").agg(F.min("offset").alias("offset"))
    rank = Window.partitionBy("window").orderBy("freq", "term")
    ranked = stored(distinct.withColumn("rank", F.row_number().over(rank)).select("window", "term", "offset", "rank"), "ranked-terms")
    rarest = _lists(index, ranked.filter("rank = 1"), slop)
    second = _lists(index, ranked.filter("rank = 2"), slop).select("text_key", "window", F.col("start").alias("_start"))
    near = F.col("_start") == F.col("start") if not slop else F.abs(F.col("_start") - F.col("start")) <= slop
    both = rarest.alias("r").join(
        second.alias("s"), (F.col("r.text_key") == F.col("s.text_key")) & (F.col("r.window") == F.col("s.window")) & near, "left_semi"
    )
    single = ranked.groupBy("window").agg(F.max("rank").alias("_n")).filter("_n = 1").select("window")
    places = stored(both.union(rarest.join(single, "window", "left_semi").select("text_key", "window", "start")), "window-places")
    texts = stored(places.select("text_key").distinct(), "window-texts")
    inside = index.filter("term IS NOT NULL").join(texts, "text_key", "left_semi").select("text_key", "term", "positions")
    asked = places.join(slots, "window")
    held = asked.join(inside, ["text_key", "term"])
    place = F.col("start") + F.col("offset")
    exact = F.array_contains("positions", place)
    close = exact if not slop else F.exists("positions", lambda p: F.abs(p - place) <= slop)
    slot = lambda test: F.count_distinct(F.when(test, F.col("offset")))
    return (
        held.groupBy("text_key", "window", "start", "n_terms").agg(slot(close).alias("_close"), slot(exact).alias("_exact"))
        .filter("_close = n_terms")
        .select("text_key", "window", "start", "n_terms", (F.col("_exact") == F.col("n_terms")).alias("exact"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated) per row of `docs`.

    A word inside any occurrence of a benchmark window is hit; items are those with such
    windows. A null or empty text has no words; equal texts get equal results, and
    repeated rows repeat theirs; items without an id hit words but are not listed; an item
    without words has no window; no rows give no rows. Other columns are not looked at.
    """
    windows = stored(benchmark_windows(benchmark, width), "windows")
    vocabulary = windows.select(F.explode("terms").alias("term")).distinct()
    sent = None
    if vocabulary.count() <= MAX_SENT_TERMS:
        sent = np.array([r["term"] for r in vocabulary.collect()], np.int64).view(np.uint64)
    index = stored(positional_index(docs, sent), "positional-index")
    matches = stored(find_windows(index.filter("term IS NOT NULL"), windows), "window-matches")
    words = matches.select("text_key", F.explode(F.sequence("start", F.col("start") + F.col("n_terms") - 1)).alias("p")).distinct()
    hits = words.groupBy("text_key").agg(F.count(F.lit(1)).alias("n_hit"))
    pairs = matches.select("text_key", "window").distinct().join(windows.select("window", "item_id"), "window")
    pairs = pairs.select("text_key", F.col("item_id").cast("string").alias("item")).distinct()
    items = pairs.groupBy("text_key").agg(F.count("item").alias("n_items"), F.concat_ws(",", F.sort_array(F.collect_list("item"))).alias("_items"))
    found = stored(hits.join(items, "text_key").withColumnRenamed("text_key", "_key"), "contaminated")
    lengths = index.filter("term IS NULL").select("doc_id", "text_key", F.get("positions", F.lit(0)).cast("long").alias("n_words"))
    zero = F.lit(0).cast("long")
    return lengths.join(found, F.col("text_key") == F.col("_key"), "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("_items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """`docs` without the rows that hold a benchmark window."""
    bad = decontaminate(docs, benchmark, width).filter("contaminated").select("text_key").distinct()
    return with_rows(docs).join(stored(bad, "contaminated-keys"), "text_key", "left_anti").select("row.*")
