"""Near-duplicate passages by compact windows over shingle min-hashes.

A text is its sequence of five-word shingles. Under one hash function, the shingle at c is
the least of every subsequence between its neighbours in the Cartesian tree of the hashes:
one compact window (l, c, r) stands for all subsequences [i, j] with l <= i <= c <= j <= r,
which share its hash as signature. Only windows that hold a passage of WIDTH shingles are
kept, about 2n/WIDTH per function: they are those whose shingle is the least of some
WIDTH shingles in a row. Of a run of equal shingles the first and the last one are kept.

Two texts with windows of one signature, from any of HASHES functions, may hold a common
passage; at similarity 0.8 no function agrees with probability 0.2**4. Windows must also
agree in the words just before or just after c, since a passage reaches far enough to one
side of c, and their intervals, laid upon each other at c, must leave room for a passage.
The texts of one signature are compared with one of them first; those that are not
verified with it are compared again among themselves. Each such pair of texts is verified
on its full shingles.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text
from tidemark.llm.components import components
from tidemark.llm.text import text_key
from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
PASSAGE_WORDS = 50
WIDTH = PASSAGE_WORDS - SHINGLE + 1
HASHES = 4
PERCENT = 80
# Words on either side of c that must agree on one side.
CONTEXT = 16
# Aligned pieces of one passage may be this many shingles apart.
GAP = 2 * SHINGLE
# Pairs of steps up to GAP, numbered row by row: the least shift first, then the nearest.
_steps = np.indices((GAP + 1, GAP + 1)).reshape(2, -1)
NEAREST = np.lexsort((abs(_steps[0] - _steps[1]), _steps.max(axis=0)))
# So many windows of a key that are left after a round are compared each with each.
FEW = 64


def least_of_runs(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive keys."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def reach(keys: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """How far from `at`, to the left (step -1) or right (1), all keys are greater.

    Minima of 1, 2, 4, ... neighbours are taken from the farthest power that is needed down.
    """
    line = keys if step > 0 else keys[::-1]
    place = at if step > 0 else len(keys) - 1 - at
    own = line[place]
    levels, size = [line], 1
    far = np.zeros(len(at), np.int64)
    active = np.ones(len(at), bool)
    while active.any() and 2 * size <= len(line):
        half = levels[-1]
        levels.append(np.minimum(half[: len(half) - size], half[size:]))
        size *= 2
        inside = place + 1 + size <= len(line)
        active = inside.copy()
        active[inside] = levels[-1][place[inside] + 1] > own[inside]
    for level in range(len(levels) - 1, -1, -1):
        size = 1 << level
        start = place + 1 + far
        inside = start + size <= len(line)
        grows = np.zeros(len(at), bool)
        grows[inside] = levels[level][start[inside]] > own[inside]
        far[grows] += size
    return far


PLACE = np.uint64((1 << 31) - 1)


def window_keys(shingles: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of one function, made different by place: equal ones count from left to right."""
    first, second = text.seeded(41 + seed, 2) | np.uint64(1)
    keys = shingles * first
    keys ^= keys >> np.uint64(32)
    keys *= second
    return (keys & ~PLACE) | np.arange(len(shingles), dtype=np.uint64)


def compact_windows(shingles: np.ndarray, bounds: np.ndarray, seed: int, width: int = WIDTH, reaches: bool = True):
    """(c, left, right, run) of the windows of one hash function over rows laid in a line.

    `bounds` are the rows' first shingles. Of a run of equal shingles, as a word said over and
    over makes, only the first and the last stand for windows: a passage that meets the run
    holds one of them, or lies inside it. `run` tells at the first how many follow, at the last
    how many go before, as a negative number. Without `reaches` there are only first ones, and
    only c has a meaning.
    """
    if len(shingles) < width:
        return (np.zeros(0, np.int64),) * 4
    keys = window_keys(shingles, seed)
    least = least_of_runs(keys, width)
    sizes = np.diff(bounds)
    change = np.zeros(len(shingles) + 1, np.int32)
    long = sizes >= width
    np.add.at(change, bounds[:-1][long], 1)
    np.add.at(change, bounds[1:][long] - width + 1, -1)
    whole = np.cumsum(change[: len(least)]) > 0
    c = np.unique((least[whole] & PLACE).astype(np.int64))
    # Equal shingles count from left to right, so a run's first one is a window where any is.
    begins = np.ones(len(shingles) + 1, bool)
    begins[1:-1] = shingles[1:] != shingles[:-1]
    begins[bounds] = True
    c = c[begins[c]]
    if not reaches:
        return c, c, c, c
    row = np.searchsorted(bounds, c, "right") - 1
    left, right = np.minimum(reach(keys, c, -1), c - bounds[row]), np.minimum(reach(keys, c, 1), bounds[row + 1] - 1 - c)
    starts = np.flatnonzero(begins)
    run = starts[np.searchsorted(starts, c, "right")] - 1 - c
    more = run > 0
    last = (c + run)[more], (left + run)[more], (right - run)[more], -run[more]
    return tuple(np.concatenate(x) for x in zip((c, left, right, run), last))


def text_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each row, shingles, first shingle of each row)."""
    starts, ends, first = text.word_spans(data, offsets, text.SPACES)
    words = text.word_hashes(data, starts, ends, text.byte_table(True))
    counts = np.diff(first)
    place = np.arange(len(words)) - np.repeat(first[:-1], counts)
    sizes = np.maximum(counts - SHINGLE + 1, 0)
    values = text.shingle_hashes(words, SHINGLE)[place < np.repeat(sizes, counts)]
    return words, first, values, np.concatenate(([0], np.cumsum(sizes)))


def signatures(docs: DataFrame, hashes: int = HASHES) -> DataFrame:
    """(signature, text_key) of the windows of all rows, each run of equal shingles once; one pass, no shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text.text_bytes(batch.column("text"))
            keys = batch.column("text_key").to_numpy()
            for a, b in text.pieces(offsets):
                _, _, values, bounds = text_shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for f in range(hashes):
                    c = compact_windows(values, bounds, f, reaches=False)[0]
                    row = np.searchsorted(bounds, c, "right") - 1
                    yield pa.RecordBatch.from_arrays([pa.array(signature(values[c], f).view(np.int64)), pa.array(keys[a + row])], names=["signature", "text_key"])

    keyed = docs.select(text_key(F.col("text")).alias("text_key"), "text").filter("text IS NOT NULL")
    return keyed.mapInArrow(rows, "signature long, text_key long")


def signature(shingles: np.ndarray, f: int) -> np.ndarray:
    return text.mix(shingles + np.uint64(f))


def windows(docs: DataFrame, hashes: int = HASHES) -> DataFrame:
    """(signature, text_key, c, left, right, run, before, after) of all rows; one pass, no shuffle.

    `before` and `after` name the CONTEXT words up to c's shingle and from it on; 0 where
    the text has fewer.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text.text_bytes(batch.column("text"))
            keys = batch.column("text_key").to_numpy()
            for a, b in text.pieces(offsets):
                words, first, values, bounds = text_shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                context = text.shingle_hashes(words, CONTEXT)
                for f in range(hashes):
                    c, left, right, run = compact_windows(values, bounds, f)
                    row = np.searchsorted(bounds, c, "right") - 1
                    at = c - bounds[row]
                    word, n = first[row] + at, (first[row + 1] - first[row])
                    fore = at + SHINGLE - CONTEXT
                    before = np.where(fore >= 0, context[np.maximum(word + SHINGLE - CONTEXT, 0)] >> np.uint64(33), 0)
                    after = np.where(at + CONTEXT <= n, context[word] >> np.uint64(33), 0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(signature(values[c], f).view(np.int64)), pa.array(keys[a + row]),
                            *(pa.array(x.astype(np.int32)) for x in (at, left, right, run, before, after)),
                        ],
                        names=["signature", "text_key", "c", "left", "right", "run", "before", "after"],
                    )

    keyed = docs.select(text_key(F.col("text")).alias("text_key"), "text").filter("text IS NOT NULL")
    return keyed.mapInArrow(rows, "signature long, text_key long, c int, left int, right int, run int, before int, after int")


def placed_windows(docs: DataFrame, hashes: int = HASHES) -> DataFrame:
    """(key, text_key, c, left, right, run) of windows whose signature several texts have; key names it, one side of c and the words there."""
    shared = signatures(docs, hashes).groupBy("signature").agg(F.min("text_key").alias("_a"), F.max("text_key").alias("_z"))
    shared = shared.filter("_a < _z").select("signature")
    met = stored(windows(docs, hashes).join(stored(shared, "signatures"), "signature").distinct(), "compact-windows")
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("before").alias("near")), F.struct(F.lit(1).alias("side"), F.col("after").alias("near"))))
    placed = met.select("signature", "text_key", "c", "left", "right", "run", sides.alias("s")).filter("s.near <> 0")
    return placed.select(F.xxhash64("signature", "s.side", "s.near").alias("key"), "text_key", "c", "left", "right", "run")


def first_windows(members: DataFrame) -> DataFrame:
    """(key, w, n): of each key that several texts have, the window of the longest run, of equals that of the least text.

    Shorter runs then differ from it where they end, and what follows tells them apart at once.
    """
    first = F.min(F.struct((-F.abs("run")).alias("shorter"), "text_key", "c", "left", "right")).alias("w")
    several = members.groupBy("key").agg(first, F.min("text_key").alias("_a"), F.max("text_key").alias("_z"), F.count(F.lit(1)).alias("n"))
    return several.filter("_a < _z").drop("_a", "_z")


def beside_first(members: DataFrame, firsts: DataFrame) -> DataFrame:
    """(key, a, ca, la, ra, b, c, left, right, run): the windows of a key beside its first one."""
    return members.join(firsts, "key").filter("text_key <> w.text_key OR c <> w.c").select(
        "key", F.col("w.text_key").alias("a"), F.col("w.c").alias("ca"), F.col("w.left").alias("la"), F.col("w.right").alias("ra"),
        F.col("text_key").alias("b"), "c", "left", "right", "run",
    )


def beside_each(windows: DataFrame) -> DataFrame:
    """The same columns for every two windows of a key."""
    one = windows.select("key", F.col("b").alias("a"), F.col("c").alias("ca"), F.col("left").alias("la"), F.col("right").alias("ra"))
    return one.join(windows.select("key", "b", "c", "left", "right", "run"), "key").filter("a < b OR (a = b AND ca < c)")


def candidate_pairs(beside: DataFrame) -> DataFrame:
    """(a, b, places): texts with windows that leave room for a passage, and where these meet."""
    room = F.least("left", "la") + F.least("right", "ra") + 1
    return (
        beside.filter(100 * room >= PERCENT * WIDTH)
        .select("a", "b", F.struct(F.col("ca").alias("a"), F.col("c").alias("b")).alias("place"))
        .groupBy("a", "b").agg(F.collect_set("place").alias("places"))
    )


def with_widest_reach(apart: DataFrame) -> DataFrame:
    """The same windows, with the farthest reaches that any key has for a place.

    Keys with the same windows are then alike, and one may stand for them all.
    """
    widest = apart.groupBy("b", "c").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    return apart.drop("left", "right").join(widest, ["b", "c"])


def own_runs(members: DataFrame) -> DataFrame:
    """Runs of equal shingles as passages that their texts repeat one word on."""
    start, end = F.col("c").cast("long"), (F.col("c") + F.col("run") + SHINGLE).cast("long")
    return members.filter(F.col("run") >= WIDTH).select(
        F.col("text_key").alias("a"), F.col("text_key").alias("b"),
        start.alias("a_start"), (end - 1).alias("a_end"), (start + 1).alias("b_start"), end.alias("b_end"),
    ).distinct()


def different_keys(windows: DataFrame) -> DataFrame:
    """(key, n) of the keys that several texts have; of keys with the same windows the least one."""
    sets = windows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("text_key", "c").cast("decimal(38,0)")).alias("_set"),
        F.min("text_key").alias("_a"), F.max("text_key").alias("_z"),
    )
    return sets.filter("_a < _z").groupBy("n", "_set", "_a", "_z").agg(F.min("key").alias("key")).select("key", "n")


def linked_passages(docs: DataFrame, hashes: int = HASHES) -> DataFrame:
    """(a, b, a_start, a_end, b_start, b_end) of the passages of all keys; a = b where a text repeats its own.

    The windows of a key are compared with its first one. Those that are not verified so are
    compared with each other where they are few. Many are told apart by what follows where
    their agreement with the first ends: two of them that hold a longer passage go on alike
    there. Their keys become longer in every round, and the first window leaves, until no
    key has two texts left.
    """
    members, few, texts = placed_windows(docs, hashes), None, None
    found = [own_runs(members)]
    while members is not None or few is not None:
        beside = few
        if members is not None:
            firsts = stored(first_windows(members), "first-windows")
            beside = beside_first(members, firsts) if few is None else few.unionByName(beside_first(members, firsts))
        pairs = stored(candidate_pairs(beside), "passage-pairs")
        verified = stored(verified_passages(pairs, texts or texts_of(pairs, docs)), "passages")
        found.append(verified.filter("NOT place").drop("place"))
        if members is None:
            break
        met = verified.filter("place").select("a", F.col("a_start").cast("int").alias("ca"), "b", F.col("b_start").cast("int").alias("c"))
        apart = beside_first(members, firsts.filter("n > 2")).join(met, ["a", "ca", "b", "c"], "left_anti").distinct()
        apart = stored(with_widest_reach(stored(apart, "windows-apart")), "windows-apart")
        # Later rounds are about texts of this one.
        texts = texts or texts_of(apart, docs)
        left = stored(different_keys(apart.select("key", F.col("b").alias("text_key"), "c")), "keys-apart")
        small, many = left.filter(F.col("n") <= FEW), left.filter(F.col("n") > FEW)
        few = None if small.isEmpty() else beside_each(apart.join(small.select("key"), "key"))
        members = None
        if not many.isEmpty():
            told = stored(told_apart(apart.join(many.select("key"), "key"), texts).distinct(), "windows-told-apart")
            members = told.join(stored(different_keys(told), "keys-told-apart").select("key"), "key")
    return reduce(DataFrame.union, found)


def aligned(x: np.ndarray, y: np.ndarray, a: int, b: int) -> tuple[int, int, int]:
    """The stretch of equal shingles around x[a] = y[b]: (start in x, start in y, length).

    A differing shingle costs as much as eight equal ones earn: eight of nine equal is similarity 0.8.
    """
    if x[a] != y[b]:
        return a, b, 0

    def best(u: np.ndarray, v: np.ndarray) -> int:
        n = min(len(u), len(v))
        if not n:
            return 0
        gain = np.cumsum(np.where(u[:n] == v[:n], 1, -8))
        top = int(np.argmax(gain))
        return top + 1 if gain[top] > 0 else 0

    back = best(x[:a][::-1], y[:b][::-1])
    return a - back, b - back, back + 1 + best(x[a + 1 :], y[b + 1 :])


def bridged(x: np.ndarray, y: np.ndarray, a: int, b: int) -> list[tuple[int, int, int, int]]:
    """The pieces (start in x, end, start in y, end) around x[a] = y[b], in order, that lie up to GAP apart.

    Beyond either end of a piece equality may go on on the same or a shifted diagonal.
    """
    i, j, n = aligned(x, y, a, b)
    if not n:
        return []

    def ahead(u: np.ndarray, v: np.ndarray, p: int, q: int) -> list[tuple[int, int, int]]:
        """(start in u, start in v, length) of what follows u[p] and v[q]."""
        out = []
        while True:
            same = u[p : p + GAP + 1, None] == v[None, q : q + GAP + 1]
            if not same.any():
                return out
            near = np.zeros((GAP + 1, GAP + 1), bool)
            near[: same.shape[0], : same.shape[1]] = same
            d, e = divmod(int(NEAREST[near.ravel()[NEAREST].argmax()]), GAP + 1)
            p, q = p + d, q + e
            n = min(len(u) - p, len(v) - q)
            # Runs are short as a rule; the look ahead grows with them.
            run, step = 0, 64
            while run < n:
                differ = np.flatnonzero(u[p + run : p + min(run + step, n)] != v[q + run : q + min(run + step, n)])
                if len(differ):
                    run += int(differ[0])
                    break
                run, step = min(run + step, n), 2 * step
            out.append((p, q, run))
            p, q = p + run, q + run

    after = [(p, p + m, q, q + m) for p, q, m in ahead(x, y, i + n, j + n)]
    behind = [(i - p - m, i - p, j - q - m, j - q) for p, q, m in ahead(x[:i][::-1], y[:j][::-1], 0, 0)]
    return [*reversed(behind), (i, i + n, j, j + n), *after]


def agreement(x: np.ndarray, y: np.ndarray, a: int, b: int) -> tuple[int, int]:
    """(start, end) in y of what agrees around x[a] = y[b], gaps bridged."""
    found = bridged(x, y, a, b)
    return (found[0][2], found[-1][3]) if found else (b, b + 1)


def passages(x: np.ndarray, y: np.ndarray, places: list[tuple[int, int]], percent: int = PERCENT) -> list[tuple[int, int, int, int]]:
    """Verified passages (start in x, end, start in y, end), in shingles."""
    pieces: set[tuple[int, int, int, int]] = set()
    lines: dict[int, list[tuple[int, int]]] = {}
    for a, b in sorted(places):
        # Both ends of a piece lie on its line, and so does a place in it.
        if any(i <= a < j for i, j in lines.get(a - b, ())):
            continue
        for p in bridged(x, y, a, b):
            if p not in pieces:
                pieces.add(p)
                lines.setdefault(p[0] - p[2], []).append((p[0], p[1]))
    chains: list[list[tuple[int, int, int, int]]] = []
    for p in sorted(pieces):
        last = chains[-1][-1] if chains else None
        # Pieces go on in both texts, a few words apart.
        if last and p[0] - last[1] <= GAP and abs(p[2] - last[3]) <= GAP and p[3] > last[3]:
            chains[-1].append(p)
        else:
            chains.append([p])
    found = []
    while chains:
        chain = chains.pop()
        span = _span(chain)
        if min(span[1] - span[0], span[3] - span[2]) < WIDTH:
            continue
        if _similar(x, y, span, percent):
            found.append(span)
            continue
        # A chain that is not similar enough as a whole may have stretches that are.
        first, last = _longest(x, y, chain)
        if last - first < len(chain) and last > first and _similar(x, y, _span(chain[first:last]), percent):
            found.append(_span(chain[first:last]))
            chains += [c for c in (chain[:first], chain[last:]) if c]
        else:
            found += [p for p in chain if _similar(x, y, p, percent)]
    return found


def _span(chain: list[tuple[int, int, int, int]]) -> tuple[int, int, int, int]:
    return chain[0][0], max(p[1] for p in chain), chain[0][2], chain[-1][3]


def _longest(x: np.ndarray, y: np.ndarray, chain: list[tuple[int, int, int, int]]) -> tuple[int, int]:
    """The longest stretch (first piece, end) of a chain whose equal shingles outweigh the others.

    s equal ones and d others of both texts together are similarity 0.8 where s = 4 d.
    """
    gains, steps = [], []
    for p, before in zip(chain, [None, *chain]):
        same = int(np.count_nonzero(x[p[0] : p[1]] == y[p[2] : p[3]]))
        gains.append(same - 8 * (p[1] - p[0] - same))
        steps.append(-4 * (max(p[0] - before[1], 0) + max(p[2] - before[3], 0)) if before else 0)
    # Stretch [f, t) has sums[t] - starts[f]; only starts less than all before can begin the longest.
    starts = np.cumsum(np.add([0, *gains[:-1]], steps))
    sums = np.cumsum(np.add(gains, steps))
    least = np.flatnonzero(np.append(True, starts[1:] < np.minimum.accumulate(starts)[:-1])).tolist()
    best, length = (0, 0), 0
    for t in range(len(chain) - 1, -1, -1):
        while least and (least[-1] > t or sums[t] >= starts[least[-1]]):
            f = least.pop()
            if f <= t and chain[t][1] - chain[f][0] > length:
                best, length = (f, t + 1), chain[t][1] - chain[f][0]
    return best


def _similar(x: np.ndarray, y: np.ndarray, passage: tuple[int, int, int, int], percent: int) -> bool:
    i, j, k, m = passage
    if min(j - i, m - k) < WIDTH:
        return False
    if np.array_equal(x[i:j], y[k:m]):
        return True
    u, v = np.unique(x[i:j]), np.unique(y[k:m])
    same = len(np.intersect1d(u, v, assume_unique=True))
    return 100 * same >= percent * (len(u) + len(v) - same)


def _shingled(column: pa.Array) -> list[np.ndarray]:
    data, offsets = text.text_bytes(column)
    out: list[np.ndarray] = []
    for a, b in text.pieces(offsets):
        _, _, values, bounds = text_shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        out += [values[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    return out


def texts_of(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(text_key, text), once each, of the texts a and b."""
    keys = pairs.select(F.col("a").alias("_key")).union(pairs.select(F.col("b").alias("_key"))).distinct()
    keyed = docs.select(text_key(F.col("text")).alias("text_key"), "text").filter("text IS NOT NULL")
    kept = keyed.join(keys, F.col("text_key") == F.col("_key"), "left_semi")
    one = F.row_number().over(Window.partitionBy("text_key").orderBy(F.lit(0)))
    return stored(kept.withColumn("_n", one).filter("_n = 1").select("text_key", "text"), "passage-texts")


def _over_pairs(pairs: DataFrame, texts: DataFrame, rows: Callable[..., list[tuple]], schema: str) -> DataFrame:
    """`rows`(a, b, shingles of a, shingles of b, places) of all pairs (a, b, places); longs and truth values."""
    # The last join gathers the pairs of one least text, whose shingles are then made once.
    both = pairs.join(texts.select(F.col("text_key").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("text_key").alias("a"), F.col("text").alias("text_a")), "a"
    )
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    types = [{"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[k] for k in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            a_keys, b_keys, own = batch.column("a").to_pylist(), batch.column("b").to_pylist(), {}
            for keys, texts in ((a_keys, "text_a"), (b_keys, "text_b")):
                first = {}
                for i, k in enumerate(keys):
                    if k not in own:
                        first.setdefault(k, i)
                own.update(zip(first, _shingled(batch.column(texts).take(pa.array(list(first.values()), pa.int64())))))
            for a, b, places in zip(a_keys, b_keys, batch.column("places").to_pylist()):
                out += rows(a, b, own[a], own[b], places)
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))

    return both.select("a", "b", "text_a", "text_b", "places").mapInArrow(run, schema)


def verified_passages(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, a_start, a_end, b_start, b_end, place) in words, for every passage of a candidate pair.

    A row with `place` true tells in a_start and b_start a place that lies in a passage.
    """

    def rows(a: int, b: int, x: np.ndarray, y: np.ndarray, places: list[dict]) -> list[tuple]:
        met = [(p["a"], p["b"]) for p in places]
        found = passages(x, y, met)
        # A passage of n shingles has SHINGLE - 1 words more.
        out = [(a, b, i, j + SHINGLE - 1, k, m + SHINGLE - 1, False) for i, j, k, m in found]
        return out + [(a, b, p, p, q, q, True) for p, q in met if any(i <= p < j and k <= q < m for i, j, k, m in found)]

    return _over_pairs(pairs, texts, rows, "a long, b long, a_start long, a_end long, b_start long, b_end long, place boolean")


def told_apart(apart: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, text_key, c, left, right, run): windows under keys of what follows their agreement with the first window.

    Each gets a key for every shingle up to GAP beyond either end, where a passage may go on.
    """
    place = F.struct("key", F.col("ca").alias("a"), F.col("c").alias("b"), "left", "right", "run")
    pairs = stored(apart.groupBy("a", "b").agg(F.collect_set(place).alias("places")), "pairs-apart")

    def rows(a: int, b: int, x: np.ndarray, y: np.ndarray, places: list[dict]) -> list[tuple]:
        out = set()
        for p in places:
            start, end = agreement(x, y, p["a"], p["b"])
            for side, next_ in enumerate((y[max(start - GAP - 1, 0) : start], y[end : end + GAP + 1])):
                key = np.uint64(p["key"] & (1 << 64) - 1) + np.uint64(side + 1)
                out.update((k, b, p["b"], p["left"], p["right"], p["run"]) for k in text.mix(next_ ^ text.mix(np.full(1, key))).view(np.int64).tolist())
        return list(out)

    return _over_pairs(pairs, texts, rows, "key long, text_key long, c int, left int, right int, run int")


def carried(spans: list[tuple[int, int]], own: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Spans of a text, apart and in order, with those that its own repeats (start, end, start, end) carry over."""
    ways = [w for i, j, k, m in own for w in ((i, j, k, m), (k, m, i, j))]
    while True:
        merged: list[list[int]] = []
        for i, j in sorted(spans):
            if merged and i <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], j)
            else:
                merged.append([i, j])
        more, starts = [], [i for i, _ in merged]
        for i, j, k, m in ways:
            for p, q in merged[max(bisect_right(starts, i) - 1, 0) : bisect_left(starts, j)]:
                # The part that recurs elsewhere, laid upon the repeat.
                u, v = max(p, i) - i + k, min(q, j) - i + k
                if i < k < j and v - u >= max(PASSAGE_WORDS, k - i):
                    # A repeat that overlaps itself carries a span step by step over all of it.
                    if not (p <= i and m <= q):
                        more.append((i, m))
                    continue
                u, v = (k if p <= i else u), (m if q >= j else min(v, m))
                at = bisect_right(starts, u) - 1
                if v - u >= PASSAGE_WORDS and not (at >= 0 and merged[at][1] >= v):
                    more.append((u, v))
        if not more:
            return [(i, j) for i, j in merged]
        spans = [(i, j) for i, j in merged] + more


def with_own_repeats(spans: DataFrame) -> DataFrame:
    """(text_key, spans) of (text_key, spans, own); rows without repeats of their own are left as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [{"start": i, "end": j} for i, j in carried([(s["start"], s["end"]) for s in spans], [tuple(o.values()) for o in own])]
                for spans, own in zip(batch.column("spans").to_pylist(), batch.column("own").to_pylist())
            ]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), pa.array(rows, kind)], names=["text_key", "spans"])

    done = spans.filter("size(own) > 0").mapInArrow(run, "text_key long, spans array<struct<start: long, end: long>>")
    return spans.filter("size(own) = 0").select("text_key", "spans").union(done)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_words, n_passages, n_repeated_words, n_links, component_id) per row of `docs`.

    Passages are stretches of at least PASSAGE_WORDS words that recur in another row, with
    shingle similarity of PERCENT in the hundred; overlapping ones count as one, and a whole
    text that recurs is one. `n_links` counts the other texts of the largest class a text
    belongs to, which is a text with all that were verified with it; `component_id` is the least doc_id of the rows linked through passages, its own for a
    row without any. A null, empty or short text has no passage; rows without doc_id belong
    to components by their texts; no rows give no rows. Other columns are not looked at.
    """
    found = stored(linked_passages(docs), "passage-links")
    links, own = found.filter("a <> b"), found.filter("a = b")
    labels = stored(components(links.select("a", "b").distinct()), "passage-labels")
    rows = stored(
        docs.select("doc_id", text_key(F.col("text")).alias("text_key"), text.n_words(F.col("text")).alias("n_words")), "passage-rows"
    )
    copies = rows.filter(F.col("n_words") >= PASSAGE_WORDS).groupBy("text_key").agg(
        F.count(F.lit(1)).alias("_n"), F.first("n_words").alias("end")
    ).filter("_n > 1")
    spans = (
        links.select(F.col("a").alias("text_key"), F.col("b").alias("other"), F.col("a_start").alias("start"), F.col("a_end").alias("end"))
        .union(links.select("b", "a", "b_start", "b_end"))
        .union(copies.select("text_key", F.lit(None).cast("long"), F.lit(0).cast("long"), "end"))
    )
    # Overlapping spans of one text become one, in a running maximum of their ends.
    merge = F.aggregate(
        F.array_sort(F.col("spans")),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("words"), F.lit(-1).cast("long").alias("far")),
        lambda acc, s: F.struct(
            (acc["n"] + (s["start"] > acc["far"]).cast("long")).alias("n"),
            (acc["words"] + F.greatest(s["end"] - F.greatest(s["start"], acc["far"]), F.lit(0).cast("long"))).alias("words"),
            F.greatest(acc["far"], s["end"]).alias("far"),
        ),
    )
    spans = spans.groupBy("text_key").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"), F.count_distinct("other").alias("n_direct")
    )
    # A passage that recurs elsewhere does so wherever its text repeats it.
    own = own.groupBy(F.col("a").alias("text_key")).agg(F.collect_set(F.struct("a_start", "a_end", "b_start", "b_end")).alias("own"))
    spans = stored(spans.join(own, "text_key", "left").withColumn("own", F.coalesce("own", F.array())), "passage-spans")
    every = with_own_repeats(spans.select("text_key", "spans", "own"))
    found = every.select(F.col("text_key").alias("_key"), merge.alias("m")).join(
        spans.select(F.col("text_key").alias("_key"), "n_direct"), "_key"
    )
    # A text and those verified with it are a class; its members have each other, through it.
    pairs = links.select("a", "b").distinct()
    sizes = stored(pairs.groupBy(F.col("a").alias("_a")).agg(F.count(F.lit(1)).alias("others")), "passage-classes")
    classes = pairs.join(sizes, F.col("a") == F.col("_a")).groupBy(F.col("b").alias("_b")).agg(F.max("others").alias("others"))
    found = found.join(labels, F.col("_key") == F.col("node"), "left").join(classes, F.col("_key") == F.col("_b"), "left").select(
        "_key", "m", F.greatest("n_direct", "others").alias("n_links"), F.coalesce("component", "_key").alias("_group")
    )
    found = stored(found, "passage-labelled")
    joined = stored(rows.join(found, F.col("text_key") == F.col("_key"), "left"), "passage-found")
    least = joined.filter("_group IS NOT NULL").groupBy(F.col("_group").alias("_g")).agg(F.min("doc_id").alias("_least"))
    zero = F.lit(0).cast("long")
    return joined.join(least, F.col("_group") == F.col("_g"), "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("m.n", zero).alias("n_passages"), F.coalesce("m.words", zero).alias("n_repeated_words"),
        F.coalesce("n_links", zero).alias("n_links"), F.coalesce("_least", "doc_id").alias("component_id"),
    )
