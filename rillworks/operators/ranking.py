"""Top-N lists in pages, and pages back to ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillworks.functions import (
    elements_sql,
    field_sql,
    int_sql,
    let,
    malformed_sql,
    parse_fields_sql,
)
from rillworks.schemas import RANK_PAGE, RANK_TOTAL


def rank_pages(
    items: DataFrame,
    item_id: str,
    order: list[Column],
    total: int = RANK_TOTAL,
    page_size: int = RANK_PAGE,
) -> DataFrame:
    """The first ``total`` items as ``rank``, ``page`` (from 0) and ``id``.

    Each task keeps its own first ``total``; only those meet, so the ranking
    window runs over ``total`` rows, whatever the size of the table.
    """
    top = items.orderBy(*order).limit(total)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    page = ((F.col("rank") - 1) / F.lit(page_size)).cast("int")
    return ranked.select(
        F.col(item_id).alias("id"), F.col("rank").cast("bigint"), page.cast("bigint").alias("page")
    )


def page_documents(ranked: DataFrame) -> DataFrame:
    """One JSON page document per page, ids in rank order."""
    entry = F.struct("rank", F.struct("id").alias("node"))
    data = F.transform(
        F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["node"].alias("node"))
    )
    return ranked.groupBy("page").agg(F.to_json(F.struct(data.alias("data"))).alias("value"))


def _page_items(pages: DataFrame) -> DataFrame:
    """Add ``_ids``, NULL per entry without an id, and ``_bad`` for the page."""
    ids = f"transform({elements_sql('page.data')}, e -> {field_sql(field_sql('e', 'node'), 'id')})"
    bad = f"{malformed_sql('value', 'page')} OR page.data IS NULL OR exists(ids, i -> i IS NULL)"
    read = let(
        parse_fields_sql("value", ("data",)),
        "page",
        let(ids, "ids", f"named_struct('_ids', ids, '_bad', {bad})"),
    )
    return pages.withColumn("_read", F.expr(read)).select(*pages.columns, "_read.*")


def page_ids(pages: DataFrame) -> DataFrame:
    """One row per page entry: its id as decimal text, with its place.

    A page is left at its first entry without an id; what came before stays.
    """
    items = _page_items(pages)
    until = F.array_position(F.transform("_ids", lambda i: i.isNull()), True)
    sound = F.when(until > 0, F.slice("_ids", F.lit(1), until.cast("int") - 1)).otherwise(
        F.col("_ids")
    )
    return items.select(*pages.columns, F.posexplode(sound).alias("place", "_id")).select(
        *pages.columns, "place", F.expr(int_sql("_id")).cast("string").alias("id")
    )


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Pages that broke off or could not be read."""
    return _page_items(pages).where("_bad").select(*pages.columns)
