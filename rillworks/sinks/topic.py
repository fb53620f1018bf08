"""Writing topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rillworks.operators.running import running_count
from rillworks.schemas import ENVELOPE

_ROW_BITS = 33
TOPIC_PARTITIONS = 64


def as_topic(records: DataFrame, topic: str) -> DataFrame:
    """Records under a topic name; what the envelope lacks becomes NULL."""
    have = set(records.columns)
    columns = [
        (F.lit(topic) if f.name == "topic" else F.col(f.name) if f.name in have else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in ENVELOPE.fields
    ]
    return records.select(*columns)


def publish(
    records: DataFrame,
    topic: str,
    path: str,
    batch: int = 0,
    order: Sequence[str] | None = None,
    partitions: int = TOPIC_PARTITIONS,
) -> None:
    """Append keyed records to a topic folder, giving each its position.

    The position is fixed once, when the files are written, and each batch
    starts a range of its own. Writing a batch again replaces it. With ``order``
    (columns, the last a whole number unique beneath the others), a key lies in
    one of ``partitions`` and its offsets follow that order; records without a
    key are spread. Partitions are numbered in stretches, so no task holds a
    whole one. Without ``order``, the writing task is the partition.
    """
    base = F.lit(batch << _ROW_BITS)
    if order is None:
        row = F.monotonically_increasing_id()
        placed = records.withColumns(
            {
                "partition": F.shiftright(row, _ROW_BITS).cast("int"),
                "offset": row.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + base,
            }
        )
    else:
        by_key = F.xxhash64(F.coalesce("key", F.lit("")), F.when(F.col("key").isNull(), F.xxhash64(*order)))
        given = records.drop("partition", *({"offset"} - set(order))).withColumn(
            "partition", F.pmod(by_key, F.lit(partitions)).cast("int")
        )
        numbered = running_count(given, ["partition"], list(order), "_n")
        placed = numbered.withColumn("offset", F.col("_n") - 1 + base)
    as_topic(placed, topic).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def write_topic_stream(
    records: DataFrame, topic: str, path: str, checkpoint: str, fmt: str = "parquet"
) -> DataStreamWriter:
    """A stream to a topic.

    Records that bring their positions keep them, and the file sink commits each
    batch once. Others get positions when their batch is written; a batch that
    runs again replaces its own. For ``fmt='kafka'``, at least once, ``path``
    names the brokers.
    """
    if fmt == "kafka":
        writer = (
            records.select("key", "value")
            .writeStream.format("kafka")
            .option("topic", topic)
            .option("kafka.bootstrap.servers", path)
        )
    elif {"partition", "offset"} <= set(records.columns):
        writer = as_topic(records, topic).writeStream.format(fmt).option("path", path)
    else:
        writer = records.writeStream.foreachBatch(
            lambda rows, batch: publish(rows, topic, path, batch)
        )
    return writer.outputMode("append").option("checkpointLocation", checkpoint)
