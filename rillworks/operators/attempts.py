"""What a log of lookup attempts resolves to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillworks.operators.running import STRETCH, running_max
from rillworks.schemas import MAX_TRIES, PROVIDER_WINDOW_SECONDS

SUCCESS = "success"
ERROR = "error"
TIMEOUT = "timeout"


def resolve_attempts(
    attempts: DataFrame,
    request: Sequence[str],
    kind: Column,
    position: str,
    max_tries: int = MAX_TRIES,
) -> DataFrame:
    """Per request, the first success that fewer than ``max_tries`` errors precede.

    If the first success comes too late, so do the later ones, so a request is
    settled by its first success and its first ``max_tries`` errors. Timeouts
    use up no try. The rank filter is applied per input partition before the
    exchange, so a request with very many attempts sends only a few rows.
    """
    ranked = attempts.select(
        *request, kind.alias("_kind"), F.col(position).alias("_at")
    ).withColumn(
        "_rank",
        F.row_number().over(Window.partitionBy(*request, "_kind").orderBy("_at")),
    )
    at = F.col("_at")
    settled = (
        ranked.where(F.col("_rank") <= max_tries)
        .groupBy(*request)
        .agg(
            F.min(F.when(F.col("_kind") == SUCCESS, at)).alias("_first"),
            F.min(
                F.when((F.col("_kind") == ERROR) & (F.col("_rank") == max_tries), at)
            ).alias("_last_try"),
        )
    )
    in_time = F.col("_last_try").isNull() | (F.col("_first") < F.col("_last_try"))
    return settled.select(*request, F.when(in_time, F.col("_first")).alias("resolved_at"))


def choose_provider(
    calls: DataFrame,
    instance: Sequence[str],
    position: Sequence[str],
    timed_out: Column,
    window_seconds: int = PROVIDER_WINDOW_SECONDS,
    stretch: int = STRETCH,
) -> DataFrame:
    """Add ``provider`` per call from the timeouts an instance had before it.

    Fallback while the latest earlier timeout is younger than the window,
    primary otherwise. ``ts`` holds the time of the call.
    """
    moments = calls.withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
    marked = running_max(
        moments,
        instance,
        position,
        F.when(timed_out, F.col("_us")),
        "_last_timeout",
        stretch,
    )
    age = F.col("_us") - F.col("_last_timeout")
    young = F.coalesce(age < window_seconds * 1_000_000, F.lit(False))
    return marked.select(
        *calls.columns,
        F.when(young, "fallback").otherwise("primary").alias("provider"),
    )
