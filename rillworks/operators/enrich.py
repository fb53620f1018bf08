"""Joining requests to the catalogue of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillworks.functions import read_fields
from rillworks.schemas import ID_FIELD


def with_lookup_id(requests: DataFrame, id_field: str = ID_FIELD) -> DataFrame:
    """Add ``lookup_id``; NULL when the value is not JSON or names no id."""
    read = read_fields(requests, "value", {"lookup_id": id_field}, missing="null")
    found = F.when(~F.col("malformed"), F.col("lookup_id"))
    return read.withColumn("lookup_id", found).drop("malformed")


def with_documents(requests: DataFrame, documents: DataFrame, how: str) -> DataFrame:
    """Join the catalogue on ``lookup_id``; small catalogues get broadcast.

    One id may have most of the requests. Adaptive execution splits such a
    partition, but only where both sides come straight from an exchange made
    for the join. The wider key keeps the catalogue from bringing the
    partitions of its own grouping instead.
    """
    side = documents.withColumn("_doc_id", F.col("id").cast("bigint")).drop("id")
    lookup = F.col("lookup_id").cast("bigint")
    if how == "left":
        # Requests that can match nothing are spread over keys beyond any id.
        apart = F.pmod(F.xxhash64(*[c for c in ("key", "value") if c in requests.columns]), F.lit(1 << 20))
        lookup = F.coalesce(lookup, apart + F.lit(1 << 33))
    asked = requests.withColumn("_lookup", lookup)
    return asked.join(side, F.col("_lookup") == F.col("_doc_id"), how).drop("_doc_id", "_lookup")


def enrich_or_drop(
    requests: DataFrame, documents: DataFrame, id_field: str = ID_FIELD
) -> DataFrame:
    """Requests with their document as ``value``; the others are lost."""
    asked = with_lookup_id(requests, id_field)
    joined = with_documents(asked, documents, "inner")
    return joined.withColumn("value", F.col("document")).drop("document", "lookup_id")


def enrich_or_pass(
    requests: DataFrame, documents: DataFrame, id_field: str = ID_FIELD
) -> DataFrame:
    """Every request; ``value`` is the document, or stays raw without one.

    ``provider`` says which: primary, fallback or raw. A request without a
    key cannot be stored and stays raw as well. A catalogue without its
    documents only names the provider.
    """
    asked = with_lookup_id(requests, id_field).withColumn(
        "lookup_id", F.when(F.col("key").isNotNull(), F.col("lookup_id"))
    )
    joined = with_documents(asked, documents, "left")
    new = {"provider": F.coalesce("provider", F.lit("raw"))}
    if "document" in documents.columns:
        new["value"] = F.coalesce("document", "value")
    return joined.withColumns(new).drop("document", "lookup_id")


def ids_to_look_up(requests: DataFrame, id_field: str = ID_FIELD) -> DataFrame:
    """Each asked id once, with the first offset that asks for it."""
    return (
        with_lookup_id(requests, id_field)
        .where("lookup_id is not null")
        .groupBy(F.col("lookup_id").alias("id"))
        .agg(F.min("offset").alias("first_offset"))
    )


def first_per_key(records: DataFrame) -> DataFrame:
    """The first offset of each key: the lookups that are not repeats."""
    return records.groupBy("key").agg(F.min("offset").alias("first_offset"))


def ids_pending(requests: DataFrame, documents: DataFrame) -> DataFrame:
    """Asked ids the catalogue has no document for."""
    asked = (
        with_lookup_id(requests).where("lookup_id is not null").groupBy("lookup_id").count()
    )
    return asked.select(F.col("lookup_id").alias("id"), F.col("count").alias("requests")).join(
        documents.select("id"), "id", "left_anti"
    )
