"""Sound and rejected records from one pass over their source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

GOOD, REJECTED = "good", "rejected"


class CountMismatch(RuntimeError):
    """What was written is not what was read."""


def split_write(records: DataFrame, ok: Column, path: str) -> dict[str, int]:
    """Write records to ``verdict=good`` and ``verdict=rejected`` folders in one scan.

    A verdict that is neither true nor false rejects. The counts are taken while the rows
    go by and once more from what was written; if they do not add up, nothing may use the
    folders. Returns ``received, good, rejected``.
    """
    spark = records.sparkSession
    verdict = F.when(ok, GOOD).otherwise(REJECTED)
    watch = Observation()
    flagged = records.withColumn("verdict", verdict).observe(
        watch,
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("verdict") == GOOD).alias("good"),
        F.count_if(F.col("verdict") == REJECTED).alias("rejected"),
    )
    flagged.write.mode("overwrite").partitionBy("verdict").parquet(path)
    counted = watch.get
    found = read_split(spark, path, records).groupBy("verdict").count().collect()
    written = {row["verdict"]: row["count"] for row in found}
    if any(written.get(v, 0) != counted[v] for v in (GOOD, REJECTED)):
        raise CountMismatch(f"read {counted}, written {written}")
    return {k: counted[k] for k in ("received", "good", "rejected")}


def read_split(spark: SparkSession, path: str, like: DataFrame, verdict: str | None = None) -> DataFrame:
    """Both folders with their ``verdict``, or the records of one; columns as in ``like``."""
    rows = spark.read.schema(like.withColumn("verdict", F.lit("")).schema).parquet(path)
    return rows if verdict is None else rows.where(F.col("verdict") == verdict).drop("verdict")
