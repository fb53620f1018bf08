"""Messages per user: totals, the changelog of totals, and their documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillworks.operators.running import STRETCH, running_count


def count_messages(keyed: DataFrame) -> DataFrame:
    """Total per ``username``; partial counts are made before the exchange."""
    return keyed.groupBy("username").agg(F.count(F.lit(1)).alias("message_count"))


def count_changelog(
    keyed: DataFrame, position: Sequence[str] = ("partition", "offset"), stretch: int = STRETCH
) -> DataFrame:
    """One row per message: its user's total so far, in position order."""
    slim = keyed.select("username", *position)
    return running_count(slim, ["username"], position, "message_count", stretch)


def count_documents(counts: DataFrame) -> DataFrame:
    """Totals as topic records. The key is the text 'null', as consumers expect."""
    body = F.struct("username", F.col("message_count").alias("messageCount"))
    return counts.select(F.lit("null").alias("key"), F.to_json(body).alias("value"))
