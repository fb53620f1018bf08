"""Delivery counters of running streams, kept as a table.

Spark counts the rows of every batch while it writes them; a listener notes the counts
of each batch in a file named by the query and the batch. A batch that runs again after
a restart replaces its note, so sums over the table count no record twice.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from rillworks.operators.enrich import enrich_or_pass
from rillworks.operators.genres import judged, with_allowed
from rillworks.operators.metrics import delivery_counters
from rillworks.schemas import EXPLICIT_GENRES
from rillworks.session import path_exists, write_text
from rillworks.streaming.runs import append_stream

OBSERVED = "delivery"
COUNTERS = ("received", "from_primary", "from_fallback", "failed", "filtered_out", "delivered")
NOTES = (
    "query string, run string, batch_id bigint, at timestamp, "
    + ", ".join(f"{c} bigint" for c in COUNTERS)
)


class DeliveryListener(StreamingQueryListener):
    """Notes the observed counters of every batch of every query that has them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counted = progress.observedMetrics.get(OBSERVED)
        if counted is None:
            return
        note = {"query": str(progress.id), "run": str(progress.runId), "batch_id": progress.batchId, "at": progress.timestamp}
        note.update({c: counted[c] for c in COUNTERS})
        write_text(self._spark, f"{self._path}/{progress.id}-{progress.batchId}.json", json.dumps(note))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, run: str, seconds: float = 60.0) -> None:
        """Until the notes of a run that has ended are all there."""
        if not self._end_of(run).wait(seconds):
            raise TimeoutError(f"the end of run {run} was not heard of")


def feed_stream(
    requests: DataFrame,
    documents: DataFrame,
    path: str,
    checkpoint: str,
    explicit: Sequence[str] = EXPLICIT_GENRES,
) -> DataStreamWriter:
    """Requests, enriched and filtered, to files, with their delivery counters observed."""
    flagged = with_allowed(enrich_or_pass(requests, judged(documents, explicit)), explicit)
    watched = flagged.observe(OBSERVED, *delivery_counters())
    return append_stream(watched.where("allowed").select("key", "value", "provider"), path, checkpoint)


def read_deliveries(spark: SparkSession, path: str) -> DataFrame:
    """A row per query and batch, columns ``NOTES``."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], NOTES)
    return spark.read.schema(NOTES).json(path)


def delivery_totals(notes: DataFrame) -> DataFrame:
    """One row of sums over all batches."""
    return notes.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])
