"""How many records went which way."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillworks.operators.enrich import enrich_or_pass
from rillworks.operators.genres import judged, with_allowed
from rillworks.schemas import EXPLICIT_GENRES


def delivery_counters() -> list[Column]:
    """Aggregates over enriched rows with ``allowed``, for batch or ``observe``."""
    provider = F.col("provider")
    allowed = F.col("allowed")
    return [
        F.count(F.lit(1)).alias("received"),
        F.count_if(provider == "primary").alias("from_primary"),
        F.count_if(provider == "fallback").alias("from_fallback"),
        F.count_if(provider == "raw").alias("failed"),
        F.count_if(~allowed).alias("filtered_out"),
        F.count_if(allowed).alias("delivered"),
    ]


def delivery_metrics(
    requests: DataFrame, documents: DataFrame, explicit: Sequence[str] = EXPLICIT_GENRES
) -> DataFrame:
    """One row of counts over a whole topic of requests."""
    # Counting needs no document text: a flag per id takes its place in the join.
    slim = judged(documents.select("id", "provider", "genre_names"), explicit)
    flagged = with_allowed(enrich_or_pass(requests, slim), explicit)
    return flagged.agg(*delivery_counters())
