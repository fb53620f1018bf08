"""Written tables that cut lineage, and connected components over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillworks.session import scratch_dir


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The folder is the one that ``spark.checkpoint.dir`` names, so a later stage
    survives the loss of the executors that made the rows.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(landed: DataFrame) -> None:
    """Delete a landed table that nothing reads any more, as what came from it has landed too."""
    spark = landed.sparkSession
    files = landed.inputFiles()
    if files:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def numbered(df: DataFrame, into: str, name: str) -> DataFrame:
    """``df``, written, with whole numbers from 1 without gaps; no task sees all rows."""
    row = F.monotonically_increasing_id()
    placed = land(
        df.select("*", F.shiftright(row, 33).alias("_part"), row.bitwiseAND((1 << 33) - 1).alias("_row")), name
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition.
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    return placed.join(before, "_part").select(
        *df.columns, (F.col("_before") + F.col("_row") + 1).alias(into)
    )


def broadcast_below(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Hint a broadcast only where ``rows``, counted before, is at most ``most``."""
    return F.broadcast(df) if rows <= most else df


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """``(node, component)`` of undirected links ``(a, b)``; component: its smallest node.

    Alternating large-star and small-star steps: every step replaces a link by
    one to the smallest neighbour, and no step gathers the neighbours of a node.
    Nodes without a link are not returned; links to oneself and nulls are ignored.
    """
    spark = edges.sparkSession
    links = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    links = land(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    before = None
    while True:
        seen = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if seen[0] == 0 or seen == before:
            break
        before = seen
        links = land(_star(_star(links, large=True), large=False), name)
    least = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    return nodes.join(least, "node", "left").select(
        "node", F.coalesce("low", "node").alias("component")
    )


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links ``(a, b)`` with ``a > b``; each neighbour is linked to the smallest one."""
    if large:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = both.join(low, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def stored(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
