"""The record flows from end to end, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillworks.functions import strict_int
from rillworks.operators.counts import count_documents, count_messages
from rillworks.operators.enrich import enrich_or_drop, enrich_or_pass
from rillworks.operators.genres import exclude_enriched, judged
from rillworks.operators.payloads import normalize_payload, payload_json, with_username
from rillworks.operators.ranking import page_ids
from rillworks.schemas import EXPLICIT_GENRES, TITLE_FIELD, ID_FIELD


def enriched_feed(
    requests: DataFrame, documents: DataFrame, explicit: Sequence[str] = EXPLICIT_GENRES
) -> DataFrame:
    """Requests to the feed that gets indexed; what has no document stays raw."""
    return exclude_enriched(enrich_or_pass(requests, judged(documents, explicit)), explicit)


def enriched_feed_strict(
    requests: DataFrame, documents: DataFrame, explicit: Sequence[str] = EXPLICIT_GENRES
) -> DataFrame:
    """The two-hop form: what has no document is lost, and keys are not kept.

    Unwanted documents go before the join. Texts made here from columns are
    JSON; only foreign ones need :func:`guarded`.
    """
    wanted = judged(documents, explicit).where("doc_allowed").drop("doc_allowed")
    return enrich_or_drop(requests, wanted).withColumn("key", F.lit(None).cast("string"))


def id_details(entries: DataFrame, documents: DataFrame) -> DataFrame:
    """Ids as text to the documents they name; no genre filter here."""
    ids = entries.select(strict_int(F.col("id")).alias("id"))
    return ids.join(documents, "id").select(
        "id", F.lit(None).cast("string").alias("key"), F.col("document").alias("value")
    )


def ranked_details(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Ranking pages to the documents of their entries."""
    return id_details(page_ids(pages), documents)


def user_counts(messages: DataFrame) -> DataFrame:
    """Messages to one count document per user."""
    return count_documents(count_messages(with_username(messages)))


def clean_messages(messages: DataFrame, policy: str = "fail_job") -> DataFrame:
    """Messages in their fixed shape, as topic records without a key."""
    clean = normalize_payload(messages, policy)
    return clean.select(F.lit(None).cast("string").alias("key"), payload_json().alias("value"))


def line_requests(parsed: DataFrame) -> DataFrame:
    """Good parsed lines as the keyed records that ask for enrichment."""
    return parsed.where("ok").select("key", "value", ID_FIELD, TITLE_FIELD)
