"""Topics: keyed records with a position (topic, partition, offset)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillworks.schemas import ENVELOPE


def _columns(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in ENVELOPE.fields]
    )


def read_topic(
    spark: SparkSession, path: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """All records of a topic that exist now."""
    if fmt == "kafka":
        reader = spark.read.format("kafka").option("subscribe", path)
        return _columns(reader.option("startingOffsets", "earliest").options(**options).load())
    return _columns(spark.read.schema(ENVELOPE).format(fmt).options(**options).load(path))


def stream_topic(
    spark: SparkSession, path: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A topic as a stream from its earliest record.

    ``path`` is the topic name for ``fmt='kafka'`` and a folder for file
    formats. The position reached lives in the checkpoint of the query.
    """
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", path)
        return _columns(reader.option("startingOffsets", "earliest").options(**options).load())
    return _columns(
        spark.readStream.schema(ENVELOPE).format(fmt).options(**options).load(path)
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed ranking pages, one JSON document per line, as ``value``."""
    return spark.read.text(path)
