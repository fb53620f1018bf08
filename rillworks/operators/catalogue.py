"""Service answers to fixed-shape documents, and one document per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillworks.functions import (
    BAD,
    double_sql,
    elements_sql,
    field_sql,
    int_sql,
    let,
    malformed_sql,
    parse_fields_sql,
    parse_typed_sql,
    settle,
    surely_double,
    surely_int,
    surely_text,
    text_sql,
)
from rillworks.schemas import DOCUMENT, FALLBACK_FIELDS, PRIMARY_FIELDS

PRIMARY = "primary"
FALLBACK = "fallback"


_LISTED = "array<struct<name string>>"
_TYPES = ("string", "string", "string", "string", "string", _LISTED, _LISTED)


def _columns(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in zip(names, _TYPES))


def _typed_document(got: Column, names: Sequence[str]) -> tuple[Column, Column]:
    """A document from fields parsed to text, and whether they settle it."""
    ident, title, rank, mean, episodes, genres, studios = [got[n] for n in names]
    sure = surely_int(ident) & surely_text(title) & surely_int(rank)
    sure = sure & surely_double(mean) & surely_int(episodes)
    for listed in (genres, studios):
        sure = sure & listed.isNotNull() & F.forall(
            listed["name"], lambda n: n.isNotNull() & surely_text(n)
        )
    doc = F.struct(
        F.coalesce(ident.try_cast("int"), F.lit(0)).alias("id"),
        title.alias("title"),
        F.coalesce(rank.try_cast("int"), F.lit(0)).alias("rank"),
        F.coalesce(mean.try_cast("double"), F.lit(0.0)).alias("mean"),
        F.coalesce(episodes.try_cast("int"), F.lit(0)).alias("num_episodes"),
        genres.alias("genres"),
        studios.alias("studios"),
    )
    return sure, doc.cast(DOCUMENT)


def _variant_document(body: str, fallback: str, require_lists: bool) -> str:
    """A document from fields of any kind, NULL where the answer holds none."""
    fields = [
        f"'{ours}', if({fallback}, {field_sql('answer.data', theirs)}, answer.`{ours}`)"
        for ours, theirs in zip(PRIMARY_FIELDS, FALLBACK_FIELDS)
    ]
    bad = f"{malformed_sql(body, 'answer')} OR ({fallback} AND answer.data IS NULL)"
    lists = "raw.genres IS NULL OR raw.studios IS NULL" if require_lists else "false"

    def named(items: str) -> str:
        name = field_sql("item", "name")
        return f"transform({items}, item -> named_struct('name', {text_sql(name)}))"

    def nameless(items: str) -> str:
        return f"exists({items}, item -> {field_sql('item', 'name')} IS NULL)"

    document = f"""named_struct(
        'id', {int_sql('raw.id')},
        'title', {text_sql('raw.title')},
        'rank', {int_sql('raw.rank')},
        'mean', {double_sql('raw.mean')},
        'num_episodes', {int_sql('raw.num_episodes')},
        'genres', {named('lists.genres')},
        'studios', {named('lists.studios')})"""
    unsound = f"raw.bad OR {lists} OR {nameless('lists.genres')} OR {nameless('lists.studios')}"
    return let(
        parse_fields_sql(body, (*PRIMARY_FIELDS, "data")),
        "answer",
        let(
            f"named_struct('bad', {bad}, {', '.join(fields)})",
            "raw",
            let(
                f"""named_struct('genres', {elements_sql('raw.genres')},
                                 'studios', {elements_sql('raw.studios')})""",
                "lists",
                f"if({unsound}, NULL, {document})",
            ),
        ),
    )


def normalize_responses(
    responses: DataFrame, provider: Column | str, require_lists: bool = False
) -> DataFrame:
    """Add ``doc``, the document an answer holds, NULL where it holds none.

    ``provider`` is 'primary' or 'fallback' per row. An answer holds no
    document when it is not JSON, when a fallback answer lacks ``data``, when
    a genre or studio lacks a name, and, with ``require_lists``, when one of
    the two lists is missing.

    Usual answers are settled by a parse to text; only the others are parsed
    as variants, whose rules cover every kind of field.
    """
    provider = F.lit(provider) if isinstance(provider, str) else provider
    quick = parse_typed_sql(
        "body", [_columns(PRIMARY_FIELDS), f"`data` struct<{_columns(FALLBACK_FIELDS)}>"]
    )
    got, fallback = F.col("_quick"), F.col("_fallback")
    ours_sure, ours = _typed_document(got, PRIMARY_FIELDS)
    theirs_sure, theirs = _typed_document(got["data"], FALLBACK_FIELDS)
    sure = got[BAD].isNull() & F.when(
        fallback, got["data"].isNotNull() & theirs_sure
    ).otherwise(ours_sure)
    slow = _variant_document("body", "_fallback", require_lists)
    checked = (
        responses.withColumn("_fallback", provider == FALLBACK)
        .withColumn("_quick", F.expr(quick))
        .withColumn("_sure", F.coalesce(sure, F.lit(False)))
        .withColumn("_slow", F.expr(f"if(_sure, NULL, {slow})").cast(DOCUMENT))
    )
    doc = F.when(F.col("_sure"), F.when(fallback, theirs).otherwise(ours)).otherwise(
        F.col("_slow")
    )
    return settle(checked, {"doc": doc}).drop("_fallback", "_quick", "_sure", "_slow")


def latest_responses(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """One answer per id: the last that landed, primary before fallback.

    Both tables go through one grouping, so an id costs one exchange.
    """
    both = primary.select("id", "seq", "body", F.lit(0).alias("turn")).union(
        fallback.select("id", "seq", "body", F.lit(1).alias("turn"))
    )
    # The body, by far the largest column, is carried once per partial row.
    first = F.min_by("body", F.struct("turn", -F.col("seq"), F.xxhash64("body")))
    return (
        both.where("body is not null")
        .groupBy("id")
        .agg(first.alias("body"), F.min("turn").alias("turn"))
        .select(
            "id",
            F.when(F.col("turn") == 0, PRIMARY).otherwise(FALLBACK).alias("provider"),
            "body",
        )
    )


def catalogue(
    primary: DataFrame, fallback: DataFrame, require_lists: bool = False
) -> DataFrame:
    """Every id that has a document: ``id, provider, document, genre_names``.

    The document text is made here, once per id, not once per request.
    """
    answers = normalize_responses(
        latest_responses(primary, fallback), F.col("provider"), require_lists
    )
    return answers.where("doc is not null").select(
        "id",
        "provider",
        F.to_json("doc").alias("document"),
        F.col("doc.genres.name").alias("genre_names"),
    )


CATALOGUE = "id int, provider string, document string, genre_names array<string>"


def write_catalogue(documents: DataFrame, path: str) -> None:
    """Build the catalogue once, for streams and jobs that read it many times."""
    documents.write.mode("overwrite").parquet(path)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue that :func:`write_catalogue` has written."""
    return spark.read.schema(CATALOGUE).parquet(path)
