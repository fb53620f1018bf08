"""Inputs for the registered queries, made by Spark from the given tables.

Every row of a table becomes input; the variety of good and bad records comes
from the row's own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillworks.schemas import TOPIC_CSV, TOPIC_MESSAGES
from rillworks.session import scratch_dir

EXPLICIT = ("PROMO", "Brand#2", "Brand#17")
BROKEN_SOURCES = ("Brand#2", "Brand#17")
BLANK_SOURCE = "Brand#5"
BLANK_HEADER_SOURCE = "Brand#9"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mod(column: str, n: int) -> Column:
    return F.col(column) % F.lit(n)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event, in ten shapes from sound to broken."""
    shape = _mod("event_id", 10)
    odd = _mod("event_id", 30)
    kind = F.col("event_type")
    sound = F.to_json(
        F.struct(
            F.concat(F.lit("u"), "user_id").alias("username"),
            F.col("event_id").alias("id"),
            kind.alias("message"),
        )
    )
    value = (
        F.when(shape == 0, F.to_json(F.struct(F.col("event_id").alias("id"), kind.alias("message"))))
        .when(shape == 1, F.concat(F.lit('{"username":null,"id":"12.7","message":"'), kind, F.lit('"}')))
        .when(shape == 2, "bad{")
        .when(shape == 3, '{"username":"","id":true}')
        .when(odd == 14, '{"username":{"x":1,"x":2},"id":3000000000,"message":7}')
        .when(odd == 24, '["u",{"x":1,"x":2}]')
        .when(shape == 4, '{"username":{"x":1},"id":3000000000,"message":7} trailing')
        .otherwise(sound)
    )
    return table(spark, sf_dir, "events").select(
        F.lit(None).cast("string").alias("key"),
        value.alias("value"),
        F.lit(TOPIC_MESSAGES).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def message_topic(spark: SparkSession, sf_dir: str) -> str:
    """The messages landed as topic files."""
    path = scratch_dir(spark, "messages")
    messages(spark, sf_dir).write.parquet(path)
    return path


def line_files(spark: SparkSession, sf_dir: str) -> str:
    """A file per brand with a header and a line per part, some odd, some broken.

    One brand has a blank header, one file has nothing but its header, and lines
    hold blanks only or a character that no separator may be.
    """
    path = scratch_dir(spark, "lines")
    key = F.col("p_partkey")
    quoted = F.concat(F.lit('"'), "p_name", F.lit(', deluxe"'))
    name = (
        F.when(_mod("p_partkey", 10) == 3, quoted)
        .when(_mod("p_partkey", 10) == 4, F.concat(F.lit("\u0001 "), "p_name"))
        .otherwise(F.col("p_name"))
    )
    broken = F.col("p_brand").isin(*BROKEN_SOURCES) & (_mod("p_partkey", 5) == 0)
    blank = (F.col("p_brand") == BLANK_SOURCE) & (_mod("p_partkey", 7) == 0)
    line = (
        F.when(broken, F.concat(key, F.lit(",")))
        .when(blank, F.lit(" \t "))
        .otherwise(F.concat_ws(",", key.cast("string"), name, "p_type"))
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("source"), F.lit(1).alias("_place"), line.alias("value")
    )
    header = F.when(F.col("source") == BLANK_HEADER_SOURCE, F.lit("")).otherwise(
        F.lit("anime_id,title,type")
    )
    sources = parts.select("source").distinct().union(spark.range(1).select(F.lit("empty")))
    heads = sources.select("source", F.lit(0).alias("_place"), header.alias("value"))
    ordered = heads.union(parts).repartition("source").sortWithinPartitions("source", "_place")
    ordered.select("source", "value").write.partitionBy("source").text(path)
    return path


def _items(*names: Column) -> Column:
    return F.array(
        *[F.struct(F.lit(i).alias("id"), n.alias("name")) for i, n in enumerate(names, 1)]
    )


def _landed(parts: DataFrame, old: Column, new: Column) -> DataFrame:
    """Small parts answered twice, so an older answer is there to be ignored."""
    earlier = F.struct(F.lit(0).alias("seq"), old.alias("body"))
    latest = F.struct(F.lit(1).alias("seq"), new.alias("body"))
    twice, once = F.array(earlier, latest), F.array(latest)
    landings = F.when(F.col("p_size") <= 5, twice).otherwise(once)
    return parts.select(F.col("p_partkey").cast("int").alias("id"), F.inline(landings)).select(
        "id", F.col("seq").cast("bigint").alias("seq"), "body"
    )


def primary_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the primary service; NULL where it did not answer."""
    rank = F.when(_mod("p_partkey", 7) != 0, F.col("p_partkey"))

    def body(title: Column) -> Column:
        return F.to_json(
            F.struct(
                F.col("p_partkey").alias("id"),
                title.alias("title"),
                rank.alias("rank"),
                F.col("p_retailprice").alias("mean"),
                F.col("p_size").alias("num_episodes"),
                _items(F.col("p_type"), F.col("p_brand")).alias("genres"),
                _items(F.concat(F.lit("S"), "p_size")).alias("studios"),
            )
        )

    answered = _mod("p_partkey", 10) <= 6
    return _landed(
        table(spark, sf_dir, "part"),
        F.when(answered, body(F.lit("outdated"))),
        F.when(answered, body(F.col("p_name"))),
    )


def fallback_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the fallback service, scores one higher, some without data."""
    rank = F.when(_mod("p_partkey", 7) != 0, F.col("p_partkey"))

    def body(title: Column) -> Column:
        data = F.struct(
            F.col("p_partkey").alias("mal_id"),
            title.alias("title"),
            rank.alias("rank"),
            (F.col("p_retailprice") + 1).alias("score"),
            F.col("p_size").alias("episodes"),
            _items(F.col("p_type"), F.col("p_brand")).alias("genres"),
            _items(F.concat(F.lit("S"), "p_size")).alias("studios"),
        )
        return F.when(_mod("p_partkey", 11) == 0, '{"status":404}').otherwise(
            F.to_json(F.struct(data.alias("data")))
        )

    answered = _mod("p_partkey", 10) <= 8
    return _landed(
        table(spark, sf_dir, "part"),
        F.when(answered, body(F.lit("outdated"))),
        F.when(answered, body(F.col("p_name"))),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One enrichment request per line item."""
    value = F.to_json(
        F.struct(
            F.col("l_partkey").alias("anime_id"),
            F.concat(F.lit("order "), "l_orderkey").alias("title"),
        )
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("key"), value.alias("value")
    )


def user_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One positioned request per event, keyed by user, asking for its own number."""
    value = F.to_json(
        F.struct(F.col("event_id").alias("anime_id"), F.col("event_type").alias("title"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
        F.lit(TOPIC_CSV).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records bound for one index per event type."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.concat(F.lit("es-"), "event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
