"""Documents of many sources mixed to target weights by Pareto order sampling.

Sources get shares of all words by weight, at most ``most`` times what they have; the
excess goes to the others by weight. Within a source a document's expected copies grow
with the binary digits of its size, up to ``most``. Their whole part is certain. For the
rest, documents are ranked by their random odds divided by their inclusion odds, and the
first ones are taken until the words left to take are used up; a few later documents
follow, each of the size nearest to the gap that stays. Documents are taken whole. The
random odds come from the id (of a row without one, from its text), so reruns agree.

No source is gathered: ranks are sorted by range, and running sums go from partition to
partition as one row per partition and source.

Nulls and extras: a null text has size 0 and is taken 0 times; a null source is a source
of its own, the last; rows with a null or repeated id are drawn like any other, ties by
size, then by place in the table; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillworks.llm.land import land, numbered
from rillworks.llm.text import slices, word_counts

WEIGHTS = (5, 2, 1)
MOST = 3
#: Documents that may follow the ranked ones, per source.
FILLS = 4
_TICKETS = float(1 << 52)


def _sizes(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """``row, doc_id, key, size, ticket`` of every document; ``key`` sorts by source, null last."""
    text = F.col(text_col).cast("string")
    id_text = F.col(id_col).cast("string")
    # Thirteen hexadecimal digits: 52 bits.
    ticket = F.conv(F.substring(F.md5(F.coalesce(id_text, text, F.lit(""))), 1, 13), 16, 10).cast("long")
    source = F.col(source_col).cast("string")
    rows = docs.select(
        text.alias("text"),
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name")).alias("key"),
        ticket.alias("ticket"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [word_counts(texts) for texts in slices(batch.column(0))]
            size = pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], size], [*batch.schema.names[1:], "size"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"row long, doc_id {kind}, key struct<none: boolean, name: string>, ticket long, size long"
    return rows.mapInArrow(run, shape)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``key, source_size, target`` of the sources of ``key, size``.

    Sources above ``most`` times their size are held there, and the rest shares what is
    left by weight, until none is above: each round takes three numbers to the driver.
    """
    found = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    order = found.repartitionByRange("key").sortWithinPartitions("key")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("n") - 1) % len(weights) + 1).cast("int"))
    sources = land(numbered(order, "n", "sources").withColumn("weight", weight).drop("n"), "weighted")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit = most * F.col("source_size")
    held, level = -1, 0.0
    while True:
        above = limit < F.lit(level) * F.col("weight")
        n, words, rest = sources.agg(
            F.count_if(above), F.sum(F.when(above, F.col("source_size")).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
        ).first()
        if n == held or not rest:
            break
        held, level = n, (total - most * words) / rest
    target = F.when(limit < F.lit(level) * F.col("weight"), limit.cast("double")).otherwise(
        F.lit(level) * F.col("weight")
    )
    return sources.select("key", "source_size", target.alias("target"))


def expected_copies(classes: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``copies`` to ``key, digits, words, target``: expected copies per document.

    They are ``digits`` times a level of the source, at most ``most``; the level makes
    the expected words meet the target. Classes at the limit are the largest ones.
    """
    down = Window.partitionBy("key").orderBy(F.desc("digits"))
    earlier = down.rowsBetween(Window.unboundedPreceding, -1)
    weighed = F.col("digits") * F.col("words")
    level = (
        F.col("target") - most * F.coalesce(F.sum("words").over(earlier), F.lit(0))
    ) / (F.sum(weighed).over(Window.partitionBy("key")) - F.coalesce(F.sum(weighed).over(earlier), F.lit(0)))
    tried = classes.withColumn("_level", level)
    # The first level at which its own class, and so each smaller one, stays within the limit.
    fits = F.when(F.col("_level") * F.col("digits") <= most, F.struct((-F.col("digits")).alias("d"), "_level"))
    first = F.min(fits).over(Window.partitionBy("key"))
    return tried.withColumn("_level", first["_level"]).withColumn("_from", -first["d"]).select(
        *classes.columns,
        F.when(F.col("digits") <= F.col("_from"), F.col("_level") * F.col("digits"))
        .otherwise(F.lit(float(most)))
        .alias("copies"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` of every document."""
    digits = F.length(F.bin("size"))
    sizes = land(_sizes(docs, id_col, source_col, text_col).withColumn("digits", digits), "sizes")
    targets = land(source_targets(sizes, weights, most), "targets")
    words = sizes.where("size > 0").groupBy("key", "digits").agg(F.sum("size").alias("words"))
    classes = expected_copies(words.join(targets.select("key", "target"), "key"), most).select(
        "key", "digits", "words", F.floor("copies").alias("whole"), (F.col("copies") - F.floor("copies")).alias("part")
    )
    classes = land(classes, "classes")
    certain = classes.groupBy("key").agg(F.sum(F.col("whole") * F.col("words")).alias("certain"))
    budgets = targets.join(certain, "key", "left").withColumn(
        "budget", F.col("target") - F.coalesce("certain", F.lit(0))
    ).drop("certain")
    u = (F.col("ticket") + F.lit(0.5)) / F.lit(_TICKETS)
    rank = u * (1 - F.col("part")) / ((1 - u) * F.col("part"))
    rows = (
        sizes.join(classes.drop("words"), ["key", "digits"], "left")
        .withColumn("part", F.when(F.col("part") > 0, F.col("part")))
        .withColumn("rank", F.coalesce(rank, F.lit(float("inf"))))
    )
    order = ["key", "rank", "ticket", F.desc("size"), "row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = land(placed.withColumn("task", F.spark_partition_id()), "ranked")
    sums = placed.groupBy("key", "task").agg(F.sum("size").alias("_sum"))
    upto = Window.partitionBy("key").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("key", "task", F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("before"))
    within = Window.partitionBy("key", "task").orderBy("rank", "ticket", F.desc("size"), "row")
    running = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))
    summed = (
        placed.withColumn("running", running)
        .join(before, ["key", "task"])
        .join(budgets, "key")
        .withColumn("reached", F.col("before") + F.col("running"))
        .withColumn("drawn", F.col("part").isNotNull() & (F.col("reached") <= F.col("budget")))
    )
    summed = land(summed, "drawn")
    # A few more documents, each of the size nearest to what is left, bring the target nearer.
    gaps = summed.groupBy("key").agg(
        (F.max("budget") - F.sum(F.when(F.col("drawn"), F.col("size")).otherwise(0))).alias("gap")
    )
    waiting = summed.where("not drawn and part is not null").select("key", "size", "rank", "ticket", "row")
    fills = []
    for _ in range(FILLS):
        nearest = waiting.join(gaps, "key").where("size < 2 * gap").groupBy("key").agg(
            F.min(F.struct(F.abs(F.col("gap") - F.col("size")), "rank", "ticket", "row", "size", "gap")).alias("best")
        )
        fills.append(land(nearest.select("key", "best.row", (F.col("best.gap") - F.col("best.size")).alias("gap")), "fill"))
        gaps = fills[-1].select("key", "gap")
        waiting = waiting.join(fills[-1].select("row"), "row", "left_anti")
    added = reduce(DataFrame.unionByName, fills).select("row", F.lit(1).alias("added"))
    copies = F.coalesce("whole", F.lit(0)) + F.col("drawn").cast("int") + F.coalesce("added", F.lit(0))
    return summed.join(added, "row", "left").select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies")
    )
