"""Record shapes. Every reader gets its schema from here; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# The names that records and topics carry on the wire.
ID_FIELD = "anime_id"
TITLE_FIELD = "title"
PRIMARY_FIELDS = ("id", "title", "rank", "mean", "num_episodes", "genres", "studios")
FALLBACK_FIELDS = ("mal_id", "title", "rank", "score", "episodes", "genres", "studios")
TOPIC_CSV = "csv-raw"
TOPIC_DOCS = "es-anime-data"
TOPIC_DOCS_DROP = "csv-enriched-datastream"
TOPIC_DOCS_RANKED = "to-elastic-search"
TOPIC_RANK_PAGES = "top_anime_topic"
TOPIC_RANK_IDS = "anime_details_topic"
TOPIC_MESSAGES = "sample-datastream-raw"
TOPIC_MESSAGES_CLEAN = "sample-datastream-es"
TOPIC_COUNTS = "sample-count-es"
EXPLICIT_GENRES = ("Hentai", "Ecchi", "Erotica")
MAX_TRIES = 3
PROVIDER_WINDOW_SECONDS = 60
RANK_TOTAL = 5000
RANK_PAGE = 500

ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

NAMED = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))

DOCUMENT = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("num_episodes", T.IntegerType()),
        T.StructField("genres", NAMED),
        T.StructField("studios", NAMED),
    ]
)

INDEX_ROWS = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("index", T.StringType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
