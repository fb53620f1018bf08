"""Landed answers of the two lookup services."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RESPONSES = "id int, seq long, body string"


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row per answer: looked-up id, landing order, body as received."""
    return spark.read.schema(RESPONSES).format(fmt).load(path)
