"""Streams from topics to sinks that can be stopped and started again."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rillworks.operators.counts import count_messages
from rillworks.operators.enrich import enrich_or_pass, with_documents, with_lookup_id
from rillworks.operators.genres import exclude_enriched, judged, with_allowed
from rillworks.operators.lines import parse_lines
from rillworks.operators.metrics import delivery_counters
from rillworks.schemas import EXPLICIT_GENRES, TOPIC_DOCS
from rillworks.session import ROCKSDB_PROVIDER
from rillworks.sinks import index_rows, write_index, write_index_once
from rillworks.sources import drop_headers


#: State in RocksDB; a batch writes what it changed, and a join has one store per partition.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

COUNTS = "username string, message_count long, batch_id long"
LAST = "key string, value string, offset long, batch_id long"
IDS = "id int, first_offset long, batch_id long"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """State of streams started within is kept in RocksDB, not in the heap."""
    before = {name: spark.conf.get(name, None) for name in _STATE}
    for name, value in _STATE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def drain(writer: DataStreamWriter) -> int:
    """Work off what is there now, then stop; raises what the stream raised.

    Returns the number of rows read.
    """
    with rocksdb_state(SparkSession.active()):
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """New rows to Parquet files, each batch once."""
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def _latest_batch_rows(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def total_counts_stream(keyed: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Changed totals of each batch, one folder per batch; columns ``COUNTS``."""
    return (
        count_messages(keyed)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_latest_batch_rows(path))
    )


def last_values_stream(records: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Changed last values of each batch, one folder per batch; columns ``LAST``."""
    latest = F.max(F.struct("offset", "value")).alias("latest")
    return (
        records.groupBy("key")
        .agg(latest)
        .select("key", "latest.value", "latest.offset")
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_latest_batch_rows(path))
    )


def last_documents_stream(
    requests: DataFrame, documents: DataFrame, path: str, checkpoint: str
) -> DataStreamWriter:
    """Changed last document per key, from successes only and before any filter.

    The state holds two numbers per key; documents join the keys that changed.
    Give it a written catalogue, as each batch reads it.
    """
    known = documents.select(F.col("id").cast("bigint").alias("_known"))
    asked = (
        with_lookup_id(requests)
        .where("key is not null and lookup_id is not null")
        .select("key", "offset", F.col("lookup_id").cast("bigint").alias("_asked"))
    )
    latest = F.max(F.struct("offset", "_asked")).alias("latest")
    found = asked.join(known, F.col("_asked") == F.col("_known"), "left_semi")
    write = _latest_batch_rows(path)

    def attach(batch: DataFrame, batch_id: int) -> None:
        last = batch.select("key", "latest.offset", F.col("latest._asked").alias("lookup_id"))
        joined = with_documents(last, documents.select("id", "document"), "inner")
        write(joined.select("key", F.col("document").alias("value"), "offset"), batch_id)

    return (
        found.groupBy("key")
        .agg(latest)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(attach)
    )


def lookup_ids_stream(
    requests: DataFrame, documents: DataFrame, path: str, checkpoint: str
) -> DataStreamWriter:
    """Ids to look up, each once over all batches, unless a document is there.

    Columns ``IDS``; the offset is the one that asked first in its batch.
    """
    asked = with_lookup_id(requests).where("lookup_id is not null").select(
        F.col("lookup_id").alias("id"), F.col("offset").alias("first_offset")
    )
    write = _latest_batch_rows(path)

    def pending(batch: DataFrame, batch_id: int) -> None:
        write(batch.join(documents.select("id"), "id", "left_anti"), batch_id)

    return (
        asked.dropDuplicates(["id"])
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(pending)
    )


def topic_index_stream(
    records: DataFrame,
    root: str,
    checkpoint: str,
    writer: str,
    may_repeat: bool = False,
    replays: bool = False,
) -> DataStreamWriter:
    """Topic records to the index of their topic, as they are.

    ``replays``: the topic may hold positions that an earlier writer has indexed, such
    as when it is read again from the start; they stay as they were written first.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if replays:
            write_index_once(batch, root, batch_id, writer)
            return
        write_index(index_rows(batch, may_repeat=may_repeat), root, batch_id, writer=writer)

    return records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def line_index_stream(
    lines: DataFrame,
    documents: DataFrame,
    root: str,
    checkpoint: str,
    writer: str,
    explicit: Sequence[str] = EXPLICIT_GENRES,
    topic: str = TOPIC_DOCS,
) -> DataStreamWriter:
    """Line files, as they land, to enriched and filtered documents in an index.

    ``lines`` is a stream of :func:`raw_lines`. A line's position is its file, as a
    hash, and its place there, so a batch that runs again gives the same ids.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_lines(drop_headers(batch)).where("ok")
        asked = parsed.select(
            "key", "value", F.xxhash64("file").alias("partition"), F.col("at").alias("offset")
        )
        kept = exclude_enriched(enrich_or_pass(asked, judged(documents, explicit)), explicit)
        placed = kept.withColumn("topic", F.lit(topic))
        write_index(index_rows(placed, may_repeat=False), root, batch_id, topic, writer)

    return lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def index_stream(
    requests: DataFrame,
    documents: DataFrame,
    root: str,
    checkpoint: str,
    writer: str,
    explicit: Sequence[str] = EXPLICIT_GENRES,
    topic: str = TOPIC_DOCS,
    report: Callable[[int, dict[str, int]], None] | None = None,
    may_repeat: bool = False,
) -> DataStreamWriter:
    """Requests to enriched, filtered documents in an index.

    Each batch is planned as a batch job of its own, so its join adapts to the
    size and skew it meets. ``documents`` is read by every batch: give it a read
    of a written catalogue, not a plan over the answers. A batch that is run
    again replaces its own folders. ``report`` gets the delivery counters of each
    batch, counted while it is written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        flagged = with_allowed(enrich_or_pass(batch, judged(documents, explicit)), explicit)
        watch = Observation()
        if report is not None:
            flagged = flagged.observe(watch, *delivery_counters())
        kept = flagged.where("allowed").withColumn("topic", F.lit(topic))
        write_index(index_rows(kept, may_repeat=may_repeat), root, batch_id, topic, writer)
        if report is not None:
            report(batch_id, watch.get)

    return requests.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
