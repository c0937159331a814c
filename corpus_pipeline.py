"""The corpus pipeline: quality rules, toxicity, near duplicates, repeated passages, packing.

Each stage takes what the one before kept, and its decisions take effect; all but the last return the columns of documents (others are left out, so no name can clash). An empty table stays empty in every stage; texts of any length are taken whole, each within one task.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from terrace.llm import ngram_join, packing, quality, substring_dedup, toxicity
from terrace.llm.common import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that base rules or the cutoffs of their language reject go. Null and empty texts fail the base rules; a null language is a stratum of its own; rows that repeat an id are judged each by its text."""
    measured = materialize(quality.measure(docs.select(*COLUMNS)), "measured")
    return quality.judge(measured, quality.cutoffs(measured, spark.read.parquet(f"{sf_dir}/labels.parquet"))).where("kept").select(*COLUMNS)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Null and empty texts have no clause and stay; rows that repeat an id are scored each by its text."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("predicted = 0").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one of the least id stays. Texts without words are linked with nothing and stay, as do rows with a null id; rows that repeat an id stay or go together."""
    found = ngram_join.link_components(docs, width=5, percent=80)
    gone = found.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out. A document that loses its whole text stays, with an empty one; null texts and rows with a null id stay as they are."""
    cleaned = substring_dedup.dedup(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens. Null and empty texts are their end id alone."""
    return packing.digests(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [("quality rules", quality_rules), ("toxicity", toxic), ("n-gram jaccard join", near_duplicates), ("substring dedup", repeated_passages), ("packing", pack)]
#: Learned weights and byte-pair merges are beyond SQL; test_pipeline holds every stage against a plain version of it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
