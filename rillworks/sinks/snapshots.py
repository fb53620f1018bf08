"""Snapshots of what a stream has written batch by batch.

A stream that writes changed rows leaves a folder per batch. Compaction merges the last
snapshot and the folders since into a new generation, one row per key, in buckets by
key, and a marker that appears in one step makes it the current one. Readers of a
snapshot open one generation, readers that want the newest also the few folders after
it, instead of every folder there ever was. A generation that was not finished has no
marker and is written again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillworks.session import path_exists, write_text

BUCKETS = 64
MARKER = "generation bigint, upto bigint, buckets int"


def _folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the folders ``<name>=<number>`` under a path."""
    if not path_exists(spark, path):
        return []
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(where)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{name}=") and n.split("=", 1)[1].isdigit())


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def current(spark: SparkSession, root: str) -> dict | None:
    """``generation, upto, buckets`` of the newest finished snapshot."""
    if not path_exists(spark, f"{root}/finished"):
        return None
    newest = spark.read.schema(MARKER).json(f"{root}/finished").orderBy(F.desc("generation")).first()
    return newest.asDict() if newest else None


def _rows(spark: SparkSession, changes: str, root: str, schema: str, after: dict | None) -> tuple[DataFrame, int]:
    """The snapshot and the batch folders since, and the number of the last of these."""
    upto = after["upto"] if after else -1
    fresh = [b for b in _folders(spark, changes, "batch_id") if b > upto]
    paths = [f"{changes}/batch_id={b}" for b in fresh]
    parts = [spark.read.schema(schema).parquet(*paths)] if paths else []
    if after:
        parts.append(spark.read.schema(schema).parquet(f"{root}/generation={after['generation']}").drop("bucket"))
    if not parts:
        return spark.createDataFrame([], schema), upto
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows, max(fresh, default=upto)


def compact(
    spark: SparkSession,
    changes: str,
    root: str,
    schema: str,
    keys: Sequence[str],
    reduce: Callable[[DataFrame], DataFrame],
    buckets: int = BUCKETS,
    keep: int = 2,
) -> dict:
    """Merge ``changes`` into a new generation under ``root`` and make it current.

    ``reduce`` leaves one row per key and may be applied again to its own results.
    Folders under ``changes`` are ``batch_id=<n>``, in the order written; those that a
    generation covers stay for others to delete. Of the generations ``keep`` stay, so
    readers of the one before can finish. One compaction runs at a time. Returns what
    is current now; with nothing new, nothing is written.
    """
    before = current(spark, root)
    rows, upto = _rows(spark, changes, root, schema, before)
    if before and before["upto"] == upto:
        return before
    after = {"generation": before["generation"] + 1 if before else 0, "upto": upto, "buckets": buckets}
    home = f"{root}/generation={after['generation']}"
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    merged = reduce(rows).withColumn("bucket", bucket)
    # The rows of a bucket may come from several tasks, so a large one is not one task.
    merged.write.mode("overwrite").partitionBy("bucket").parquet(home)
    write_text(spark, f"{root}/finished/{after['generation']}.json", json.dumps(after))
    for old in _folders(spark, root, "generation"):
        if old <= after["generation"] - keep:
            _delete(spark, f"{root}/finished/{old}.json")
            _delete(spark, f"{root}/generation={old}")
    return after


def read_snapshot(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of the current generation only, with their ``bucket``."""
    now = current(spark, root)
    if now is None:
        return spark.createDataFrame([], f"{schema}, bucket int")
    return spark.read.schema(f"{schema}, bucket int").parquet(f"{root}/generation={now['generation']}")


def look_up(spark: SparkSession, root: str, schema: str, keys: dict) -> DataFrame:
    """The row of one key: its bucket is the only one read."""
    now = current(spark, root)
    if now is None:
        return spark.createDataFrame([], schema)
    asked = spark.range(1).select(F.pmod(F.xxhash64(*[F.lit(v) for v in keys.values()]), F.lit(now["buckets"])))
    rows = read_snapshot(spark, root, schema).where(F.col("bucket") == asked.first()[0])
    for name, value in keys.items():
        rows = rows.where(F.col(name) == value)
    return rows.drop("bucket")


def read_newest(
    spark: SparkSession, changes: str, root: str, schema: str, reduce: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The current generation and what was written since, one row per key."""
    rows, _ = _rows(spark, changes, root, schema, current(spark, root))
    return reduce(rows)
