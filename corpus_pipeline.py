"""A corpus made ready for training: five stages over `documents`, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the shared
folder, and read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import decontaminate, jaccard, language, mixing, secrets
from eventmart.session import configure
from eventmart.sources.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _same_columns(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of `docs`, with `n_chars` counted again where there is one."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those far from every centroid, null or without a letter go."""
    model = language.train(docs)
    found = language.identify(docs, model)
    return found.filter(~F.col("rejected")).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, similarity of 0.8 or more."""
    return jaccard.drop_near_duplicates(docs, width=5, percent=80)


def decontaminate_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of the benchmark; documents with no word left go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _same_columns(docs, decontaminate.remove_contamination(docs, benchmark))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of each secret, also of those in nested encodings."""
    return _same_columns(docs, secrets.redact_secrets(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, and when first; those it does not take are left out."""
    documents, _ = mixing.mix(docs)
    taken = documents.filter("taken > 0").select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken", "first_slot"
    )
    return taken


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_copies),
    ("decontamination", decontaminate_texts),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

# The clusters of the language stage and the hashes of the others have no SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs, _ = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
