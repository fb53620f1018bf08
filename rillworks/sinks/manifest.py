"""Which positions each written folder of an index holds.

A writer notes, before it writes a batch, the lowest and highest offset of its records
per index and partition. A batch of a source that may replay meets only the folders
whose ranges overlap its own, so a new writer can read a topic again from the start and
leave every position once. The notes live in ``_manifest`` under the root, which readers
of documents do not see.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillworks.schemas import INDEX_ROWS
from rillworks.session import path_exists
from rillworks.sinks.index import POSITION, index_rows, write_index

RANGES = (
    "index string, partition int, low bigint, high bigint, records bigint, writer string, batch_id bigint"
)


def _home(root: str) -> str:
    return f"{root}/_manifest"


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The noted ranges of all folders; no rows where nothing was noted."""
    if not path_exists(spark, _home(root)):
        return spark.createDataFrame([], RANGES)
    return spark.read.schema(RANGES).parquet(_home(root))


def position_ranges(records: DataFrame, position: tuple[str, ...] = POSITION) -> DataFrame:
    """``index, partition, low, high, records``: one row per topic partition."""
    topic, partition, offset = position
    return records.groupBy(F.col(topic).alias("index"), F.col(partition).alias("partition")).agg(
        F.min(offset).alias("low"), F.max(offset).alias("high"), F.count(F.lit(1)).alias("records")
    )


def overlapping(manifest: DataFrame, ranges: DataFrame, writer: str, batch_id: int) -> DataFrame:
    """Noted folders, other than the batch's own, that may hold one of its positions."""
    own = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
    asked = ranges.select(
        F.col("index").alias("_index"), F.col("partition").alias("_partition"),
        F.col("low").alias("_low"), F.col("high").alias("_high"),
    )
    meets = (
        (F.col("index") == F.col("_index"))
        & (F.col("partition") == F.col("_partition"))
        & (F.col("low") <= F.col("_high"))
        & (F.col("high") >= F.col("_low"))
    )
    found = manifest.where(~own).join(asked, meets, "left_semi")
    return found.select("index", "writer", "batch_id").distinct()


def read_folders(spark: SparkSession, root: str, folders: Iterable) -> DataFrame | None:
    """The documents of some folders only; ``None`` where none of them was written."""
    paths = [f"{root}/index={f['index']}/writer={f['writer']}/batch_id={f['batch_id']}" for f in folders]
    paths = [path for path in paths if path_exists(spark, path)]
    if not paths:
        return None
    return spark.read.schema(INDEX_ROWS).option("basePath", root).parquet(*paths)


def unwritten(docs: DataFrame, written: DataFrame | None) -> DataFrame:
    """Documents whose id no other folder holds."""
    if written is None:
        return docs
    return docs.join(written.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def write_index_once(
    records: DataFrame,
    root: str,
    batch_id: int,
    writer: str,
    position: tuple[str, ...] = POSITION,
) -> None:
    """Write a batch of topic records, leaving out positions that other folders hold.

    The note comes first. If the batch is lost after it, others read a folder that is
    not there or not complete yet, and this batch, run again, finds what they wrote.
    One batch at a time writes to a root. The list of folders that overlap is as long
    as what the source sends again.
    """
    spark = records.sparkSession
    note = f"{_home(root)}/writer={writer}/batch_id={batch_id}"
    position_ranges(records, position).coalesce(1).write.mode("overwrite").parquet(note)
    asked = spark.read.schema(RANGES).parquet(note).select("index", "partition", "low", "high")
    folders = overlapping(read_manifest(spark, root), asked, writer, batch_id).collect()
    docs = index_rows(records, position)
    write_index(unwritten(docs, read_folders(spark, root, folders)), root, batch_id, writer=writer)
