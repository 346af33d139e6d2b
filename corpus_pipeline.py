"""The corpus pipeline: language, near duplicates, benchmark passages, mixing, token files.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All
but the last return the columns of `documents`, whatever they are, row by row unchanged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.language_id import UNKNOWN, fit_language_model, identify, is_held_out
from tidemark.llm.minmax_dedup import one_per_component
from tidemark.llm.mixing import mixed
from tidemark.llm.positional_index import clean_documents
from tidemark.llm.token_records import write_records
from tidemark.session import stored

# A document stays if its language is identified at least this surely.
MIN_SCORE = 0.5
# Near duplicates share this much of their five-word shingles; at 0.8**6 a band, all bands differ with probability below 1e-6.
NEAR_SHINGLE, NEAR_PERCENT, NEAR_BANDS = 5, 80, 46


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those whose language stays unclear.

    A null or empty text has no letter and goes; no rows give no rows.
    """
    model = fit_language_model(docs.filter(~is_held_out(F.col("doc_id"))))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Verdicts are computed under fixed names, so columns of any name pass through.
    plain = docs.select(F.struct(*columns).alias("row"), "text")
    judged = identify(plain, model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return judged.select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one of the least doc_id."""
    return one_per_component(docs, k=NEAR_SHINGLE, percent=NEAR_PERCENT, bands=NEAR_BANDS)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and drop documents so that sources come near their target shares."""
    return mixed(docs)


def write_token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write all documents as token records; return the offset index."""
    return write_records(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_to_weights),
    ("token_records", write_token_records),
]

# Token ids and a fitted language model are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the result is without the files' names, which differ in every run."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = reduce(lambda rows, stage: stored(stage[1](spark, rows, sf_dir), stage[0]), STAGES[:-1], docs)
    return STAGES[-1][1](spark, kept, sf_dir).select("doc_id", "start", "n_tokens")
