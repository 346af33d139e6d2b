"""Near-duplicate documents by min-max hashing.

Every permutation of a document's shingles gives two signature values, the least and
the greatest, so `3 * BANDS` hash evaluations fill `BANDS` bands of six values. Two sets
of similarity 0.85 agree in a band with probability 0.85**6, and miss all 30 bands with
probability below 1e-6.

Buckets are never expanded into pairs. Equal sets are one node. In each bucket the nodes
are compared with one pivot, the node that meets most others in all its buckets; nodes
that are linked already are not compared again. Let p be a pivot and x, y linked nodes of
its buckets, still in different components. x and y have at least 85/185 of their sizes'
sum in common, and at most min(|x & p|, |y & p|) of it lies in p, so the rest, if any, are
extras: shingles outside p. Extras are ordered by rarity, and as in prefix filtering each
node is indexed under as many of its rarest extras as must meet one of its partners'.
Copies that were edited independently have their extras for themselves, so that a large
group of copies costs no more than its shingles, and no link is lost.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text
from tidemark.llm.components import components
from tidemark.llm.text import text_key, with_rows
from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 3
PERCENT = 85
BANDS = 30
PER_BAND = 3  # hash functions of a band; each gives a minimum and a maximum

SIGNATURE = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, bands array<long>"


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows in a line and where each row's begin.

    A row of fewer than k words, but not none, has its whole sequence as one shingle.
    """
    starts, ends, first = text.word_spans(data, offsets, text.SPACES)
    words = text.word_hashes(data, starts, ends, text.byte_table(True))
    values = text.shingle_hashes(words, k)
    counts = np.diff(first)
    for short in range(1, k):
        rows = first[:-1][counts == short]
        if len(rows):
            parts = text.seeded(29 + short, short) | np.uint64(1)
            values[rows] = text.mix(sum(words[rows + i] * parts[i] for i in range(short)))
    sizes = np.where(counts > 0, np.maximum(counts - k + 1, 1), 0)
    place = np.arange(len(words)) - np.repeat(first[:-1], counts)
    return values[place < np.repeat(sizes, counts)], np.concatenate(([0], np.cumsum(sizes)))


def shingle_sets(column: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every row."""
    data, offsets = text.text_bytes(column)
    sets: list[np.ndarray] = []
    for a, b in text.pieces(offsets):
        values, at = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k)
        sets += [np.unique(values[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
    return sets


def min_max_bands(values: np.ndarray, at: np.ndarray, bands: int) -> np.ndarray:
    """One row of band keys per non-empty set; `at` holds where the sets begin."""
    factors, shifts = text.seeded(31, bands * PER_BAND) | np.uint64(1), text.seeded(37, bands * PER_BAND)
    keys = np.zeros((len(at), bands), np.uint64)
    buffer = np.empty_like(values)
    for band in range(bands):
        key = np.full(len(at), band, np.uint64)
        for i in range(band * PER_BAND, (band + 1) * PER_BAND):
            np.multiply(values, factors[i], out=buffer)
            np.add(buffer, shifts[i], out=buffer)
            for pick in (np.minimum, np.maximum):
                key = text.mix(key * np.uint64(text.BASE) + pick.reduceat(buffer, at))
        keys[:, band] = key
    return keys


def signatures(docs: DataFrame, bands: int = BANDS, k: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_a, set_b, bands) of every row; one pass, no shuffle.

    (set_a, set_b) name the shingle set; a row without shingles has an empty `bands`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text.text_bytes(batch.column("text"))
            for a, b in text.pieces(offsets):
                values, at = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k)
                full = at[:-1] < at[1:]
                n, keys = np.zeros((3, b - a), np.uint64), np.zeros((0, bands), np.uint64)
                for row in np.flatnonzero(full):
                    distinct = np.unique(values[at[row] : at[row + 1]])
                    n[:, row] = len(distinct), text.mix(distinct).sum(), text.mix(distinct ^ np.uint64(text.BASE)).sum()
                if full.any():
                    keys = min_max_bands(values, at[:-1][full], bands)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(np.where(full, bands, 0)))), pa.int32()),
                    pa.array(keys.ravel().view(np.int64)),
                )
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), own.column("text_key"), *(pa.array(x.view(np.int64)) for x in n), lists],
                    names=["doc_id", "text_key", "n_shingles", "set_a", "set_b", "bands"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), text_key(F.col("text")).alias("text_key"), "text")
    return rows.mapInArrow(run, SIGNATURE)


# Pairs whose sets are compared at once.
PAIRS = 500


def compared(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(a, b, common, size_a, size_b, extras) of pairs (a, b) of nodes, from their full sets.

    `extras` are the shingles of b that a lacks.
    """
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    named = nodes.join(wanted, "node").select("node", F.col("text_key").alias("_key"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        named, (F.col("doc_id") == F.col("node")) & (text_key(F.col("text")) == F.col("_key"))
    )
    one = Window.partitionBy("node").orderBy("_key")
    texts = stored(rows.withColumn("_n", F.row_number().over(one)).filter("_n = 1").select("node", "text"), "near-texts")
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, PAIRS) for i in range(0, whole.num_rows, PAIRS)):
                sizes, extras = [], []
                for x, y in zip(shingle_sets(batch.column("text_a"), k), shingle_sets(batch.column("text_b"), k)):
                    new = np.setdiff1d(y, x, assume_unique=True)
                    sizes.append((len(y) - len(new), len(x), len(y)))
                    extras.append(new.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), *(pa.array(c, pa.int64()) for c in zip(*sizes)), pa.array(extras, pa.list_(pa.int64()))],
                    names=["a", "b", "common", "size_a", "size_b", "extras"],
                )

    schema = "a long, b long, common long, size_a long, size_b long, extras array<long>"
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, schema)


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int, k: int = SHINGLE) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets are similar enough."""
    union = F.col("size_a") + F.col("size_b") - F.col("common")
    return compared(pairs, docs, nodes, k).filter(100 * F.col("common") >= percent * union).select("a", "b")


def near_components(
    docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, k: int = SHINGLE
) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) for every row of `docs`.

    Rows are linked when 100 * intersection >= percent * union of their shingle sets;
    component_id is the least doc_id reachable. Rows of one doc_id are one node. A row
    without words, or without doc_id, is linked with nothing and has its own doc_id;
    repeated rows are repeated; no rows give no rows. Other columns are not looked at.
    """
    signed = stored(signatures(docs, bands, k), "signatures")
    linkable = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    # Equal sets are one node, named by the least doc_id; a group of copies shrinks to one row per task first.
    least = Window.partitionBy("set_a", "set_b").orderBy("doc_id", "text_key")
    nodes = stored(
        linkable.withColumn("_n", F.row_number().over(least)).filter("_n = 1")
        .select("set_a", "set_b", F.col("doc_id").alias("node"), "text_key", "n_shingles", "bands"),
        "near-nodes",
    )
    members = stored(linkable.select("doc_id", "set_a", "set_b").distinct().join(nodes.select("set_a", "set_b", "node"), ["set_a", "set_b"])
                     .select("doc_id", "node").distinct(), "near-members")
    several = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("_z")).filter("a < _z")
    edges = members.join(several, "doc_id").select("a", F.col("node").alias("b"))

    placed = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    # Only nodes of buckets with others go on.
    shared = stored(placed.join(sizes, "bucket"), "near-buckets")
    met = shared.groupBy("node").agg(F.sum("_n").alias("met"))
    chosen = shared.join(met, "node").groupBy("bucket").agg(F.max(F.struct("met", (-F.col("node")).alias("node"))).alias("p"))
    pivots = stored(chosen.select("bucket", (-F.col("p.node")).alias("a")), "near-pivots")
    tried = stored(
        shared.join(pivots, "bucket").filter("node <> a").groupBy("a", F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("hits")),
        "near-pairs",
    )
    # First the likeliest pivot of each node, then those that are apart still.
    best = Window.partitionBy("b").orderBy(F.desc("hits"), "a")
    first = stored(tried.withColumn("_n", F.row_number().over(best)).filter("_n = 1").select("a", "b"), "near-first")
    found = stored(edges.union(verified(first, docs, nodes, percent, k)), "near-links")
    labels = stored(components(found), "near-labels")
    rest = stored(_apart(tried.select("a", "b").join(first, ["a", "b"], "left_anti"), labels), "near-rest")
    found = stored(found.union(verified(rest, docs, nodes, percent, k)), "near-links")
    labels = stored(components(found), "near-labels")
    # Last, nodes of one pivot that are in different components still.
    last = stored(_last_pairs(tried, labels, docs, nodes, percent, k), "near-last")
    labels = stored(components(found.union(verified(last, docs, nodes, percent, k))), "near-labels")

    named = members.join(labels, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component_id"))
    return (
        signed.select("doc_id", "text_key", "n_shingles")
        .join(named.withColumnRenamed("doc_id", "_id"), (F.col("doc_id") == F.col("_id")) & (F.col("n_shingles") > 0), "left")
        .select("doc_id", "text_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components."""
    of = lambda side: labels.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
    named = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return named.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def _last_pairs(tried: DataFrame, labels: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int, k: int) -> DataFrame:
    """All pairs (a, b) that may be linked, among the nodes of one pivot, in different components."""
    named = tried.select("a", "b").join(labels.withColumnRenamed("node", "b"), "b", "left").select("a", "b", F.coalesce("component", "b").alias("c"))
    mixed = named.groupBy("a").agg(F.min("c").alias("_lo"), F.max("c").alias("_hi")).filter("_lo < _hi").select("a")
    open_ = stored(named.join(mixed, "a"), "near-open")
    sets = stored(compared(open_.select("a", "b"), docs, nodes, k), "near-extras")
    least = sets.groupBy("a").agg(F.min("size_b").alias("least"))
    rows = sets.join(least, "a").join(open_, ["a", "b"])
    # Linked sets have percent / (100 + percent) of their sizes' sum in common.
    needed = lambda x, y: percent * (x + y)
    missing = F.ceil((needed(F.col("size_b"), F.col("least")) - (100 + percent) * F.col("common")) / (100 + percent))
    rows = stored(rows.select("a", "b", "c", "size_b", "common", missing.alias("missing"), "extras"), "near-missing")

    spread = rows.select("a", "b", "c", "size_b", "missing", F.size("extras").alias("_e"), F.explode("extras").alias("z"))
    common = spread.groupBy("a", "z").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    # An extra of one node only is the rarest, and meets none; what is left of the prefix is indexed.
    prefix = F.col("_e") - F.greatest("missing", F.lit(1)) + 1
    held = spread.join(common, ["a", "z"])
    rarest = Window.partitionBy("a", "b").orderBy("held", "z")
    everyone = Window.partitionBy("a", "b")
    indexed = stored(
        held.withColumn("_rank", F.row_number().over(rarest) + F.col("_e") - F.count(F.lit(1)).over(everyone))
        .filter(F.col("_rank") <= prefix).select("a", "z", "b", "c", "size_b"),
        "near-prefixes",
    )
    # Nodes that can be linked within the pivot alone.
    inner = stored(rows.filter("missing <= 0").select("a", "b", "c", "size_b", "common"), "near-inner")
    return (
        _meeting(indexed, ["a", "z"], percent)
        .union(_meeting(inner, ["a"], percent, F.least("common", "_common"))).distinct()
    )


def _meeting(rows: DataFrame, key: list[str], percent: int, common: Column | None = None) -> DataFrame:
    """Pairs (a, b) of nodes with one key, in different components, of sizes that allow a link."""
    other = rows.select(*key, *[F.col(c).alias(f"_{c}") for c in rows.columns if c not in key])
    small, large = F.least("size_b", "_size_b"), F.greatest("size_b", "_size_b")
    test = (F.col("b") < F.col("_b")) & (F.col("c") != F.col("_c")) & (100 * small >= percent * large)
    if common is not None:
        test = test & ((100 + percent) * common >= percent * (small + large))
    return rows.join(other, key).filter(test).select(F.col("b").alias("a"), F.col("_b").alias("b"))


def one_per_component(docs: DataFrame, **options: object) -> DataFrame:
    """`docs` with one row left of each component: a row whose doc_id names it.

    Rows without words or without doc_id all stay.
    """
    kept = near_components(docs, **options).filter("doc_id IS NULL OR n_shingles = 0 OR doc_id = component_id")
    one = Window.partitionBy("doc_id").orderBy("text_key")
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    named = kept.filter(linked).select("doc_id", "text_key").distinct()
    chosen = named.withColumn("_n", F.row_number().over(one)).filter("_n = 1").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")
    )
    rows = with_rows(docs).withColumn("_worded", F.coalesce(F.rlike("text", F.lit(text.WORD)), F.lit(False)))
    linked = F.col("_worded") & F.col("doc_id").isNotNull()
    stay = rows.filter(linked).join(
        chosen, (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key")), "left_semi"
    )
    copies = Window.partitionBy("doc_id").orderBy(F.lit(0))
    stay = stay.withColumn("_n", F.row_number().over(copies)).filter("_n = 1").select("row")
    return stay.union(rows.filter(~linked).select("row")).select("row.*")
