"""Language identification, word first: known words are scored by their log frequency
in each language, and an unseen word by its longest known character n-grams.

Fitting counts words of labelled texts in Spark; the model keeps a bounded number of
words and n-grams and is broadcast. Scoring is one pass over the texts.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bounds of the fit: labelled texts per language, words and n-grams kept per language.
MAX_TEXTS = 2000
MAX_WORDS = 20_000
MAX_GRAMS = 20_000
GRAM_SIZES = (5, 4, 3, 2, 1)
LETTERS = r"\p{L}+"
UNKNOWN = "und"
# Words whose scores a worker keeps.
MAX_CACHED = 200_000


@dataclass
class LanguageModel:
    """Log frequencies, one row of `languages` order per word or n-gram."""

    languages: list[str]
    words: dict[str, tuple[float, ...]] = field(default_factory=dict)
    grams: dict[str, tuple[float, ...]] = field(default_factory=dict)


def is_held_out(doc_id: Column) -> Column:
    """Texts that fitting never sees: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def letter_words(text: Column) -> Column:
    """Runs of letters in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({LETTERS})"), F.lit(1))


def fit_language_model(
    docs: DataFrame, max_texts: int = MAX_TEXTS, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS
) -> LanguageModel:
    """Learn from `text` and non-null `lang` of about `max_texts` texts per language.

    Those are the texts whose hashes, spread evenly, lie below the language's share, so
    reruns choose the same. At most `max_words + max_grams` rows per language come to the
    driver, whatever the input. Without labelled texts the model knows no language.
    """
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    # One row per language, stored so that its size is known before the join is planned.
    shares = stored(labelled.groupBy("lang").agg((F.lit(float(max_texts)) / F.count(F.lit(1))).alias("_share")), "language-shares")
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / float(1 << 53)
    chosen = labelled.join(shares.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang")).filter(place < F.col("_share"))
    words = chosen.select("lang", F.explode(letter_words(F.col("text"))).alias("word")).groupBy("lang", "word").count()
    words = words.persist()
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    size = F.length(padded)
    grams = words.select("lang", "count", padded.alias("p"), F.explode(F.array(*[F.lit(n) for n in GRAM_SIZES])).alias("n"))
    grams = grams.filter(F.length("p") >= F.col("n")).select(
        "lang", "count", "n",
        F.explode(F.expr("transform(sequence(1, length(p) - n + 1), i -> substring(p, i, n))")).alias("word"),
    )
    grams = grams.filter("word != ' '").groupBy("lang", "word").agg(F.sum("count").alias("count"))

    def top(df: DataFrame, limit: int) -> list:
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))
        return df.withColumn("_r", rank).filter(F.col("_r") <= limit).select("lang", "word", "count").collect()

    try:
        found = [top(words, max_words), top(grams, max_grams)]
    finally:
        words.unpersist()
    languages = sorted({r["lang"] for rows in found for r in rows})
    return LanguageModel(languages, *[_log_frequencies(rows, languages) for rows in found])


def _log_frequencies(rows: list, languages: list[str]) -> dict[str, tuple[float, ...]]:
    """Log frequencies by language with half a count added to each."""
    counts: dict[str, dict[str, int]] = {}
    totals: Counter = Counter()
    for r in rows:
        counts.setdefault(r["word"], {})[r["lang"]] = r["count"]
        totals[r["lang"]] += r["count"]
    mass = {lang: totals[lang] + 0.5 * len(counts) for lang in languages}
    return {w: tuple(math.log((by.get(lang, 0) + 0.5) / mass[lang]) for lang in languages) for w, by in counts.items()}


class Scorer:
    """Scores words of one worker, remembering recent unseen ones."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.cache: dict[str, tuple[float, ...] | None] = {}

    def unseen(self, word: str) -> tuple[float, ...] | None:
        """The mean over the word's n-grams of the greatest length with known ones."""
        if word in self.cache:
            return self.cache[word]
        padded, found = f" {word} ", []
        for n in GRAM_SIZES:
            found = [g for i in range(len(padded) - n + 1) if (g := self.model.grams.get(padded[i : i + n])) is not None]
            if found:
                break
        score = tuple(sum(x) / len(found) for x in zip(*found)) if found else None
        if len(self.cache) >= MAX_CACHED:
            self.cache.clear()
        self.cache[word] = score
        return score

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its share of the probability."""
        words = _letters.findall(text.lower()) if text else []
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        known = self.model.words
        totals = [0.0] * len(self.model.languages)
        for word, n in Counter(words).items():
            score = known.get(word)
            if score is None:
                score = self.unseen(word)
                if score is None:
                    continue
            for i, x in enumerate(score):
                totals[i] += n * x
        best = max(range(len(totals)), key=lambda i: (totals[i], -i))
        share = 1.0 / sum(math.exp(max(x - totals[best], -700.0)) for x in totals)
        return self.model.languages[best], share


_letters = regex.compile(LETTERS)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """`docs` with `lang_pred` and `score` in place of any columns of these names.

    A text that is null or has no letter is `und` with score 0, and so is every text
    under a model without languages; a text of which the model knows no n-gram goes to
    the first language at an even share. Equal scores go to the first language by name.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    fields = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*fields.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.words, model.grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(LanguageModel(*shared.value))
        for batch in batches:
            found = [scorer.predict(t) for t in batch.column(kept.index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=[*kept, "lang_pred", "score"],
            )

    return fields.mapInArrow(run, schema)
