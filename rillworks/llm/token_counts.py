"""Token counts for every context limit from one exact histogram of lengths.

Documents are encoded once and counted by ``(group, length)``. Suffix sums over
that histogram then answer, for each length that occurs taken as a limit: how
many documents reach it, the tokens in them, the total if all documents were
cut there, and the share of documents that fit.

Nulls and extras: a null or empty text has length 0; rows with a null or
repeated id count like any other; a null group is a group of its own (scope
``group``, name null); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillworks.llm.tokens import rank_length

#: Lengths that one step of the suffix sums spans.
STEP = 1024


def encoded_lengths(docs: DataFrame, vocabulary: str, text_col: str, *keep: str) -> DataFrame:
    """``docs`` columns ``keep`` and ``length``, the ids of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = rank_length(vocabulary)
        for batch in batches:
            sizes = [length(t) if t else 0 for t in (t.as_py() for t in batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(sizes, pa.int64())], [*keep, "length"]
            )

    rows = docs.select(F.col(text_col).alias("text"), *keep)
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.mapInArrow(run, kinds + "length long")


def length_histogram(docs: DataFrame, vocabulary: str, group_col: str, text_col: str = "text") -> DataFrame:
    """``scope, name, length, n_docs``: per group, and for all documents together."""
    rows = encoded_lengths(docs.select(F.col(text_col).alias("text"), F.col(group_col).cast("string").alias("name")), vocabulary, "text", "name")
    groups = rows.groupBy("name", "length").agg(F.count("*").alias("n_docs"))
    sets = groups.select(
        F.explode(
            F.array(
                F.struct(F.lit("group").alias("scope"), "name"),
                F.struct(F.lit("all").alias("scope"), F.lit(None).cast("string").alias("name")),
            )
        ).alias("to"),
        "length",
        "n_docs",
    )
    return sets.groupBy("to.scope", "to.name", "length").agg(F.sum("n_docs").alias("n_docs"))


def limits_report(histogram: DataFrame) -> DataFrame:
    """One row per scope, name and length, that length read as a context limit.

    ``docs_reaching``/``tokens_reaching``: documents of at least that length and
    their tokens; ``truncated_total``: tokens left if every document is cut
    there; ``docs_within``: documents of at most that length;
    ``quantile``: their share.
    """
    step = F.expr(f"div(length, {STEP})").alias("step")
    rows = histogram.withColumn("tokens", F.col("length") * F.col("n_docs")).withColumn("step", step)
    steps = rows.groupBy("scope", "name", "step").agg(
        F.sum("n_docs").alias("step_docs"), F.sum("tokens").alias("step_tokens")
    )
    beyond = Window.partitionBy("scope", "name").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("scope", "name")
    steps = steps.select(
        F.col("scope").alias("s"),
        F.col("name").alias("n"),
        F.col("step").alias("k"),
        F.coalesce(F.sum("step_docs").over(beyond), F.lit(0)).alias("docs_beyond"),
        F.coalesce(F.sum("step_tokens").over(beyond), F.lit(0)).alias("tokens_beyond"),
        F.sum("step_docs").over(whole).alias("docs"),
        F.sum("step_tokens").over(whole).alias("total_tokens"),
    )
    within = Window.partitionBy("scope", "name", "step").orderBy(F.col("length").desc())
    rows = rows.withColumns(
        {
            "docs_in": F.sum("n_docs").over(within),
            "tokens_in": F.sum("tokens").over(within),
        }
    ).join(steps, (F.col("scope") == F.col("s")) & F.col("name").eqNullSafe(F.col("n")) & (F.col("step") == F.col("k")))
    reaching = F.col("docs_in") + F.col("docs_beyond")
    tokens = F.col("tokens_in") + F.col("tokens_beyond")
    fit = F.col("docs") - reaching + F.col("n_docs")
    return rows.select(
        "scope",
        "name",
        F.col("length").alias("context_limit"),
        "n_docs",
        reaching.alias("docs_reaching"),
        tokens.alias("tokens_reaching"),
        fit.alias("docs_within"),
        (F.col("total_tokens") - tokens + reaching * F.col("length")).alias("truncated_total"),
        F.col("total_tokens"),
        (fit / F.col("docs")).alias("quantile"),
    )


def at_limits(report: DataFrame, limits: DataFrame) -> DataFrame:
    """Truncated totals for any ``limits(context_limit)``, occurring lengths or not.

    A limit between two lengths loses from the documents above it what the next
    length says; above the longest document nothing is lost.
    """
    asked = limits.select(F.col("context_limit").cast("long").alias("asked")).distinct()
    rows = report.select("scope", "name", "context_limit", "docs_reaching", "tokens_reaching", "total_tokens")
    span = Window.partitionBy("scope", "name").orderBy("at", "kind").rowsBetween(1, Window.unboundedFollowing)
    scopes = rows.select("scope", "name", "total_tokens").distinct()
    marked = rows.select("scope", "name", F.col("context_limit").alias("at"), F.lit(1).alias("kind"), "docs_reaching", "tokens_reaching", "total_tokens")
    # Few limits, one row per scope for each of them.
    probes = scopes.join(asked.agg(F.collect_set("asked").alias("all")), F.lit(True)).select(
        "scope", "name", F.explode("all").alias("at"), F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("docs_reaching"), F.lit(None).cast("long").alias("tokens_reaching"), "total_tokens",
    )
    met = marked.unionByName(probes).withColumns(
        {
            "docs_up": F.first("docs_reaching", True).over(span),
            "tokens_up": F.first("tokens_reaching", True).over(span),
        }
    )
    docs, tokens = F.coalesce("docs_up", F.lit(0)), F.coalesce("tokens_up", F.lit(0))
    return met.where("kind = 0").select(
        "scope", "name", F.col("at").alias("context_limit"),
        (F.col("total_tokens") - tokens + docs * F.col("at")).alias("truncated_total"),
    )
