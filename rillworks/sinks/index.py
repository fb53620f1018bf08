"""Document folders that stand for search indices.

One root holds ``index=<name>/writer=<name>/batch_id=<n>/`` Parquet folders. A
batch of a writer owns its folders: written again, it replaces what it wrote
before, and nothing of another writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillworks.schemas import INDEX_ROWS

POSITION = ("topic", "partition", "offset")
WRITER = "batch"


def index_rows(
    records: DataFrame, position: tuple[str, ...] = POSITION, may_repeat: bool = True
) -> DataFrame:
    """Topic records as documents: id from the position, index from the topic.

    The key plays no part, so a later record never replaces an earlier one.
    ``may_repeat`` drops second copies of a position, at the price of an
    exchange; a source that cannot replay within a batch does not need it. A
    record without a position ends the job: it could not be told from another.
    """
    lost = F.raise_error(F.lit("a record for an index has no position")).cast("string")
    parts = [F.coalesce(F.col(p).cast("string"), lost) for p in position]
    docs = records.select(
        F.concat_ws("+", *parts).alias("doc_id"),
        "value",
        F.col("topic").alias("index"),
    )
    return docs.dropDuplicates(["doc_id"]) if may_repeat else docs


def write_index(
    docs: DataFrame,
    root: str,
    batch_id: int = 0,
    index: str | None = None,
    writer: str = WRITER,
) -> None:
    """Write one batch of documents of one writer for all indices in a single job.

    A batch written again replaces what it wrote per index it has rows for.
    With ``index``, all rows are for that one, and the batch replaces its folder
    even when no row is left.
    """
    if index is not None:
        home = f"{root}/index={index}/writer={writer}/batch_id={batch_id}"
        docs.drop("index").write.mode("overwrite").parquet(home)
        return
    (
        docs.withColumn("writer", F.lit(writer))
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("index", "writer", "batch_id")
        .parquet(root)
    )


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """All documents of all indices."""
    return spark.read.schema(INDEX_ROWS).parquet(root)


def _files(spark: SparkSession, root: str) -> DataFrame:
    """The data files under a root; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(F.regexp_extract("path", "/index=([^/]+)/", 1).alias("index"), "length")
    )


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Every index with its number of documents, files and bytes."""
    files = _files(spark, root).groupBy("index").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    docs = read_index(spark, root).groupBy("index").agg(F.count(F.lit(1)).alias("docs"))
    return files.join(docs, "index", "left").select(
        "index", F.coalesce("docs", F.lit(0)).alias("docs"), "files", "bytes"
    )


def truncate_index(spark: SparkSession, root: str, index: str) -> DataFrame:
    """Delete the documents of an index but keep it; report what happened."""
    same = F.col("index") == index
    existed = not _files(spark, root).where(same).isEmpty()
    before = after = 0
    if existed:
        before = read_index(spark, root).where(same).count()
        empty = spark.createDataFrame([], INDEX_ROWS).drop("index", "writer", "batch_id")
        home = f"{root}/index={index}"
        empty.withColumns({"writer": F.lit(WRITER), "batch_id": F.lit(0)}).write.mode(
            "overwrite"
        ).partitionBy("writer", "batch_id").parquet(home)
        empty.write.mode("overwrite").parquet(f"{home}/writer={WRITER}/batch_id=-1")
        after = read_index(spark, root).where(same).count()
    return spark.range(1).select(
        F.lit(index).alias("index"),
        F.lit(existed).alias("existed"),
        F.lit(before).cast("bigint").alias("docs_before"),
        F.lit(after).cast("bigint").alias("docs_after"),
    )
