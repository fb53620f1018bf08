"""Enrichment by answers that arrive as a stream of their own, before or after the request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillworks.operators.enrich import with_lookup_id
from rillworks.schemas import ID_FIELD


def enrich_late(
    requests: DataFrame,
    answers: DataFrame,
    patience: str,
    history: str,
    delay: str,
    id_field: str = ID_FIELD,
) -> DataFrame:
    """Every request of a stream once, with its document as ``value`` if one came in time.

    ``answers(id, provider, document, answered_at)`` count if they are at most
    ``history`` older and at most ``patience`` younger than the request's ``timestamp``;
    of an id's answers the first to arrive counts while ``delay`` and these bounds hold
    it in state. A request without one goes out raw when the watermark says that none
    can come any more. Both sides may be out of order by ``delay``; what is later is left
    out. State holds what those bounds span, not the whole past. A null id or key asks
    for nothing; such requests are spread over keys that no answer has.
    """
    apart = F.pmod(F.xxhash64("key", "value", "partition", "offset"), F.lit(1 << 20)) + F.lit(1 << 33)
    asked = (
        with_lookup_id(requests, id_field)
        .withColumn("lookup_id", F.when(F.col("key").isNotNull(), F.col("lookup_id")))
        .withColumn("_asked", F.coalesce(F.col("lookup_id").cast("bigint"), apart))
        .withWatermark("timestamp", delay)
    )
    came = (
        answers.select(F.col("id").cast("bigint").alias("_id"), "provider", "document", "answered_at")
        .where("_id is not null and document is not null")
        .withWatermark("answered_at", delay)
        .dropDuplicatesWithinWatermark(["_id"])
    )
    in_time = F.expr(
        f"_asked = _id AND answered_at >= timestamp - INTERVAL {history} "
        f"AND answered_at <= timestamp + INTERVAL {patience}"
    )
    joined = asked.join(came, in_time, "left_outer")
    return joined.select(
        "key", "topic", "partition", "offset", "timestamp",
        F.coalesce("provider", F.lit("raw")).alias("provider"),
        F.coalesce("document", "value").alias("value"),
    )
