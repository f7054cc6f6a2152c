"""The corpus pipeline: language ID, quality rules, near-duplicates by shingle similarity, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame. All but the last give
the columns of ``docs``. run() writes each stage's rows as Parquet to the shared
folder and reads them back for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from omicspark.llm.jaccard import one_of_each
from omicspark.llm.langid import keep_known
from omicspark.llm.packing import pack
from omicspark.llm.quality import quality_filter
from omicspark.storage import materialize

MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, and texts of no language with a score of at least MIN_LANGUAGE_SCORE, go."""
    return keep_known(docs, MIN_LANGUAGE_SCORE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that a quality rule rejects go."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 or more of 5-word shingles the document with the smallest id stays."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, packed into sequences of 2048 tokens."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, vocabulary=50257)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("packing", packing),
]

# Trained models and tokenizers are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of every piece."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
