"""Quality rules by distribution divergence, in DataFrame functions only.

A text's histograms of character classes and of common words are compared with those of
its language, summed over all texts of the language, by Jensen-Shannon distance. Short
texts have noisy histograms and are not judged by them. Everything about one text is
computed in its row: nothing is exploded or shuffled but the few sums per language.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import text_key
from tidemark.session import stored

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

# Frequent function words of each language.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "ist", "nicht", "ein", "als"),
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "with", "as", "was", "be"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui"),
}
BINS = tuple(sorted({w for words in COMMON_WORDS.values() for w in words}))

# Least characters of words, and least words, for a verdict; the largest distances kept.
MIN_CLASS_CHARS = 300
MIN_COMMON_WORDS = 50
MAX_CLASS_DISTANCE = 0.25
# Both together are judged more strictly.
MAX_BOTH = (0.13, 0.25)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` with `value` computed once, also where `body` has lambdas of its own."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_repeated_words(words: Column, width: int = WINDOW_WORDS) -> Column:
    """Words inside runs of `width` words that the text has twice or more."""
    windows = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.when(
            F.size(h) > width,
            F.transform(F.sequence(F.lit(1), F.size(h) - (width - 1)), lambda i: F.xxhash64(F.slice(h, i, width))),
        ).otherwise(F.array().cast("array<bigint>")),
    )

    def covered(hashes: Column) -> Column:
        def starts(s: Column) -> Column:
            here = lambda k: F.get(s, k)["h"]
            twice = F.filter(
                F.transform(
                    F.sequence(F.lit(0), F.size(s) - 1),
                    lambda k: F.when(here(k).eqNullSafe(here(k - 1)) | here(k).eqNullSafe(here(k + 1)), F.get(s, k)["at"]),
                ),
                lambda p: p.isNotNull(),
            )
            return F.sort_array(twice)

        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        # Each start covers `width` words, or as many as there are before the next start.
        steps = lambda p: F.zip_with(F.slice(p, 2, F.size(p)), p, lambda b, a: F.coalesce(F.least(b - a, F.lit(width)), F.lit(width)))
        total = lambda p: F.aggregate(steps(p), F.lit(0).cast("long"), lambda acc, x: acc + x)
        return let(let(ordered, starts), total)

    return let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0).cast("long")),
    )


def measured(docs: DataFrame) -> DataFrame:
    """Counts of every row: (doc_id, lang, text_key, n_words, ..., classes, commons)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", text_key(F.col("text")).alias("text_key"), text.alias("text"))
    rows = rows.withColumns({
        "words": F.array_remove(F.split("text", SPACES), ""),
        "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "inked": F.regexp_replace("text", SPACES, ""),
        "common": F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w.isin(*BINS)),
        "letter_words": F.regexp_count("text", F.lit(r"\p{L}+")),
    })
    # What is left without a-z is short, and the other classes are counted in it.
    rows = rows.withColumn("rest", F.regexp_replace("inked", "[a-z]+", ""))
    length = lambda c: F.length(c).cast("long")
    removed = lambda pattern: (F.length("rest") - F.length(F.regexp_replace("rest", pattern, ""))).cast("long")
    classes = [
        length("inked") - length("rest"), removed("[A-Z]+"), removed("[0-9]+"), removed(r"[.,;:!?'\"()\-]+"),
        removed(f"{SYMBOLS}+"), removed(r"[^\x00-\x7F]+"), length("text") - length("inked"),
    ]
    counted = [F.size("common") - F.size(F.array_remove("common", w)) for w in BINS]
    other = F.col("letter_words") - F.size("common")
    zero = F.lit(0).cast("long")
    return rows.select(
        "doc_id", "lang", "text_key",
        F.size("words").cast("long").alias("n_words"), length("inked").alias("word_chars"),
        removed(f"{SYMBOLS}+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        n_repeated_words(F.col("words")).alias("n_repeat_words"),
        # The last class holds the other ASCII characters.
        let(F.array(*classes), lambda c: F.concat(c, F.array(length("text") - F.aggregate(c, zero, lambda a, x: a + x)))).alias("classes"),
        F.array(*[c.cast("long") for c in (*counted, other)]).alias("commons"),
    )


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return let(total, lambda t: F.transform(counts, lambda x: F.when(t > 0, x / t).otherwise(F.lit(0.0))))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance of two arrays of shares: 0 for equal ones, 1 for disjoint ones."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2)
    divergence = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def language_references(counts: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Shares of classes and common words for each language of COMMON_WORDS that occurs."""
    sizes = {"classes": 8, "commons": len(BINS) + 1}
    sums = [F.sum(F.get(c, F.lit(i))).alias(f"{c}_{i}") for c, n in sizes.items() for i in range(n)]
    found = counts.filter(F.col("lang").isin(*COMMON_WORDS)).groupBy("lang").agg(*sums).collect()

    def of(row: object, name: str) -> list[float]:
        values = [row[f"{name}_{i}"] or 0 for i in range(sizes[name])]
        return [v / (sum(values) or 1) for v in values]

    return {row["lang"]: (of(row, "classes"), of(row, "commons")) for row in found}


def judge(docs: DataFrame) -> DataFrame:
    """The base counts, both distances and the verdict for every row of `docs`.

    Columns: doc_id, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    class_distance, word_distance, base_failed, kept. A text is compared with its own
    language, or with the nearest one if its language is null or has no list of common
    words; if no listed language occurs at all, distances are null and do not reject. A
    null or empty text has zero counts and fails the base rule; repeated rows repeat; no
    rows give no rows. Other columns are not looked at.
    """
    counts = stored(measured(docs), "text-counts")
    references = language_references(counts)

    def distance(column: str, which: int) -> Column:
        by = {
            lang: jensen_shannon(F.col(f"_{column}"), F.array(*[F.lit(x) for x in parts[which]]))
            for lang, parts in sorted(references.items())
        }
        if not by:
            return F.lit(None).cast("double")
        nearest = F.least(*by.values()) if len(by) > 1 else next(iter(by.values()))
        own = reduce(lambda found, lang: found.when(F.col("lang") == lang, by[lang]), by, F.when(F.lit(False), F.lit(0.0)))
        return own.otherwise(nearest)

    judged = counts.withColumns({"_classes": shares(F.col("classes")), "_commons": shares(F.col("commons"))}).withColumns(
        {"class_distance": distance("classes", 0), "word_distance": distance("commons", 1)}
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    odd_classes = (F.col("word_chars") >= MIN_CLASS_CHARS) & (F.col("class_distance") > MAX_CLASS_DISTANCE)
    odd_words = (
        (F.col("n_words") >= MIN_COMMON_WORDS) & (F.col("class_distance") > MAX_BOTH[0]) & (F.col("word_distance") > MAX_BOTH[1])
    )
    odd = F.coalesce(odd_classes | odd_words, F.lit(False))
    return judged.select(
        "doc_id", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "class_distance", "word_distance", base_failed.alias("base_failed"), (~base_failed & ~odd).alias("kept"),
    )
