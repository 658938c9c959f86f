"""From raw documents to packed sequences, one written table per stage.

Each stage takes the documents that the one before kept and drops what it rejects; the last
one returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trapiche.llm.common import fresh, on_executors
from trapiche.llm.decontaminate import flag_leaks
from trapiche.llm.exact_dedup import exact_dedup
from trapiche.llm.language import UNDETERMINED, identify_languages
from trapiche.llm.packing import pack_documents
from trapiche.llm.queries import TOKENIZER
from trapiche.llm.simhash import simhash_groups
from trapiche.sinks.writers import store

# Below this probability of the best language a document is rejected.
LEAST_SCORE = 0.5

# No SQL expresses a trained classifier or a fingerprint.
ORACLE_SQL: str | None = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that the classifier is sure enough of."""
    verdict, score = fresh(docs, "held_out", "lang_pred", "score")[1:]
    sure = (F.col(verdict) != UNDETERMINED) & (F.col(score) >= LEAST_SCORE)
    return identify_languages(docs).where(sure).select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of equal texts."""
    kept = fresh(docs, "kept")[0]
    return exact_dedup(docs).where(F.col(kept)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of linked fingerprints."""
    kept = fresh(docs, "kept")[0]
    return simhash_groups(docs).where(F.col(kept)).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = fresh(docs, "leaks")[0]
    return flag_leaks(docs, benchmark, leaks).where(~F.col(leaks)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("language_id", on_executors(language_id)),
    ("exact_dedup", on_executors(exact_duplicates)),
    ("simhash_near_dedup", on_executors(near_duplicates)),
    ("benchmark_decontamination", on_executors(decontamination)),
    ("best_fit_packing", on_executors(packing)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of the documents that pass every stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
