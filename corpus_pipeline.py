"""From raw documents to packed token sequences, each stage one operator of pricepanel.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's ``docs``, so a lost executor costs
no more than the stage at work.  All stages but the last return the columns
of their input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.lineage import scratch_path
from pricepanel.llm import decontaminate, language, line_dedup, packing, simhash

#: Least share of a document's letters in its language.
MIN_LANGUAGE_SHARE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or without a language for most of them, go."""
    return language.accepted(docs, language.train(docs), MIN_LANGUAGE_SHARE)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line nearly equals go, and documents that have nothing else; n_chars follows the text."""
    kept = line_dedup.deduplicate(docs, counts=False, keep_emptied=False)
    if "n_chars" not in docs.columns:
        return kept
    # A null text keeps what n_chars said.
    size = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", size).select(*[f"`{c}`" for c in docs.columns])


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the least id."""
    return simhash.representatives(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("lines", distinct_lines),
    ("near_duplicates", distinct_documents),
    ("decontamination", without_benchmarks),
    ("packing", packed),
]

#: Language and packing have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
