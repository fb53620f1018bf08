"""The registered queries of this subpackage, one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from rillworks.llm import quality
from rillworks.llm.collocations import mine
from rillworks.llm.decontamination import leaks
from rillworks.llm.embedding_dedup import link_vectors
from rillworks.llm.jaccard_join import link_documents
from rillworks.llm.land import land, stored
from rillworks.llm.line_dedup import drop_repeated_lines
from rillworks.llm.mixing_lm import score_documents
from rillworks.llm.oracles import ORACLES  # noqa: F401
from rillworks.llm.packing import pack_documents
from rillworks.llm.repair import damaged_report
from rillworks.llm.secrets import scan
from rillworks.llm.source_mix import mix_sources
from rillworks.llm.suffix_dedup import remove_repeats
from rillworks.llm.token_counts import length_histogram, limits_report

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stored(spark, sf_dir, "documents")
    model = quality.fit(docs, quality.grades_of_labels(stored(spark, sf_dir, "labels")))
    return quality.score(docs, model)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(stored(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(stored(spark, sf_dir, "embeddings"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stored(spark, sf_dir, "documents")
    histogram = length_histogram(docs, "byte_bpe_50k.tiktoken", "source")
    return limits_report(land(histogram, "lengths"))


def op5_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(stored(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(stored(spark, sf_dir, "documents"), extend=True)
    return kept.select(
        "doc_id",
        F.col("_lines").alias("n_lines"),
        F.col("_removed").alias("n_removed"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(stored(spark, sf_dir, "documents"), width=3, percent=90)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(stored(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(stored(spark, sf_dir, "documents"), stored(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(stored(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(stored(spark, sf_dir, "documents"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(stored(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_report(stored(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_mixing_lm": op5_mixing_lm,
    "op6_line_dedup": op6_line_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_secrets": op8_secrets,
    "op9_decontamination": op9_decontamination,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_source_mix": op12_source_mix,
    "op13_repair": op13_repair,
    "pipeline": corpus_pipeline.run,
}
