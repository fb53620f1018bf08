"""Leaving out records with an unwanted genre."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillworks.functions import (
    BAD,
    SURELY_TEXT,
    elements_sql,
    field_sql,
    let,
    malformed_sql,
    parse_fields_sql,
    parse_typed_sql,
    settle,
    text_sql,
)
from rillworks.schemas import EXPLICIT_GENRES


def _free_of(genre_names: Column, explicit: Sequence[str]) -> Column:
    return ~F.arrays_overlap(genre_names, F.array(*[F.lit(g) for g in explicit]))


def _text_allowed(text: str, explicit: Sequence[str]) -> str:
    """No unwanted genre in the JSON; unreadable text and nameless genres fail."""
    listed = ", ".join("'" + g.replace("\\", "\\\\").replace("'", "\\'") + "'" for g in explicit)
    names = f"transform({elements_sql('node.genres')}, g -> {field_sql('g', 'name')})"
    unwanted = f"exists({names}, n -> n IS NULL OR {text_sql('n')} IN ({listed}))"
    return let(
        parse_fields_sql(text, ("genres",)),
        "node",
        f"NOT ({malformed_sql(text, 'node')} OR {unwanted})",
    )


def _with_allowed(
    records: DataFrame, explicit: Sequence[str], read: Column, known: Column
) -> DataFrame:
    """Add ``allowed``: from ``value`` where ``read`` holds, else ``known``.

    Genres that parse to a list of names are settled by it, provided the
    unwanted names look like words: then no number or object equals one. Only
    other records are parsed as variants.
    """
    wordy = all(re.match(SURELY_TEXT, genre) for genre in explicit)
    got, names = F.col("_quick"), F.col("_quick.genres.name")
    settled = (
        F.lit(wordy)
        & got.isNotNull()
        & got[BAD].isNull()
        & (names.isNull() | ~F.exists(names, lambda n: n.isNull()))
    )
    quick = parse_typed_sql("value", ["`genres` array<struct<name string>>"])
    slow = _text_allowed("value", explicit)
    checked = (
        records.withColumn("_read", read)
        .withColumn("_quick", F.expr(f"if(_read, {quick}, NULL)"))
        .withColumn("_sure", F.coalesce(settled, F.lit(False)))
        .withColumn("_slow", F.expr(f"if(_read AND NOT _sure, {slow}, NULL)"))
    )
    allowed = (
        F.when(~F.col("_read"), known)
        .when(F.col("_sure"), F.coalesce(_free_of(names, explicit), F.lit(True)))
        .otherwise(F.col("_slow"))
    )
    return settle(checked, {"allowed": allowed}).drop("_read", "_quick", "_sure", "_slow")


def exclude_genres(
    records: DataFrame, explicit: Sequence[str] = EXPLICIT_GENRES
) -> DataFrame:
    """Keep records whose ``value`` names none of the genres, exactly spelled."""
    flagged = _with_allowed(records, explicit, F.lit(True), F.lit(True))
    return flagged.where("allowed").drop("allowed")


def judged(documents: DataFrame, explicit: Sequence[str] = EXPLICIT_GENRES) -> DataFrame:
    """The catalogue with one flag per id, ``doc_allowed``, in place of its genres."""
    flag = _free_of(F.col("genre_names"), explicit).alias("doc_allowed")
    return documents.select(*[c for c in documents.columns if c != "genre_names"], flag)


def with_allowed(
    enriched: DataFrame, explicit: Sequence[str] = EXPLICIT_GENRES
) -> DataFrame:
    """The same test as ``allowed`` on enriched records, parsing only raw ones.

    Records enriched from a judged catalogue bring ``doc_allowed``, those from a
    plain one ``genre_names``; those passed through raw have neither.
    """
    raw = F.col("provider") == "raw"
    if "doc_allowed" in enriched.columns:
        return _with_allowed(enriched, explicit, raw, F.col("doc_allowed")).drop("doc_allowed")
    return _with_allowed(enriched, explicit, raw, _free_of(F.col("genre_names"), explicit))


def exclude_enriched(
    enriched: DataFrame, explicit: Sequence[str] = EXPLICIT_GENRES
) -> DataFrame:
    """Enriched records that :func:`with_allowed` lets through."""
    return with_allowed(enriched, explicit).where("allowed").drop("allowed")
