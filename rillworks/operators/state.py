"""The latest document per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillworks.operators.enrich import with_documents, with_lookup_id
from rillworks.schemas import ID_FIELD


def last_values(records: DataFrame) -> DataFrame:
    """Last ``value`` per key by offset, for records that carry their value."""
    latest = F.max(F.struct("offset", "value")).alias("latest")
    return records.groupBy("key").agg(latest).select("key", "latest.value", "latest.offset")


def last_documents(
    requests: DataFrame, documents: DataFrame, id_field: str = ID_FIELD
) -> DataFrame:
    """Last document per key, before any filter and from successes only.

    Requests that found a document shrink to one row per key, on numbers alone;
    only those meet the documents.
    """
    asked = with_lookup_id(requests, id_field).where("key is not null and lookup_id is not null")
    known = documents.select(F.col("id").cast("bigint").alias("_known"))
    found = asked.select("key", "offset", F.col("lookup_id").cast("bigint").alias("_asked")).join(
        known, F.col("_asked") == F.col("_known"), "left_semi"
    )
    last = found.groupBy("key").agg(
        F.max_by("_asked", "offset").alias("lookup_id"), F.max("offset").alias("offset")
    )
    joined = with_documents(last, documents.select("id", "document"), "inner")
    return joined.select("key", F.col("document").alias("value"), "offset")
