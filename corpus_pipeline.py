"""From documents to packed training sequences, one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillworks.llm import quality
from rillworks.llm.decontamination import clean_documents
from rillworks.llm.jaccard_join import keep_first_of_each
from rillworks.llm.land import land, stored
from rillworks.llm.line_dedup import count_columns, drop_repeated_lines
from rillworks.llm.packing import pack_documents

#: Documents whose top grade is less likely than this are rejected.
LEAST_TOP = 0.35


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Poor and toxic documents go; the fit uses the rated ones among ``docs``."""
    ratings = quality.grades_of_labels(stored(spark, sf_dir, "labels"))
    return quality.select_documents(docs, quality.fit(docs, ratings), LEAST_TOP)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines go, and documents of which nothing is left."""
    kept = drop_repeated_lines(docs, drop_emptied=True, extend=True)
    lines, removed = count_columns(docs.columns)
    return kept.withColumn(
        "n_chars", F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
    ).drop(lines, removed)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by runs of five words, at 0.8 or more, the first stays."""
    return keep_first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return clean_documents(docs, stored(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 4096 ids."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The stages train a model, hash runs of words and tokenize: no SQL states them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stored(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
