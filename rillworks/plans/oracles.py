"""The expected result of every query, stated in SQL over the given tables."""

from __future__ import annotations

_GENRES = "('PROMO', 'Brand#2', 'Brand#17')"
_BROKEN = "(p_brand IN ('Brand#2', 'Brand#17') AND p_partkey % 5 = 0)"
_BLANK = "(p_brand = 'Brand#5' AND p_partkey % 7 = 0)"
_LINE_TITLE = (
    "CASE WHEN p_partkey % 10 = 3 THEN '\"' || p_name "
    "WHEN p_partkey % 10 = 4 THEN chr(1) || ' ' || p_name ELSE p_name END"
)
_LINE_JSON = (
    "'{\"anime_id\":' || p_partkey || ',\"title\":\"' || "
    "CASE WHEN p_partkey % 10 = 3 THEN '\\\"' || p_name "
    "WHEN p_partkey % 10 = 4 THEN '\\u0001 ' || p_name ELSE p_name END || '\"}'"
)
_UNWANTED = f"(p_type IN {_GENRES} OR p_brand IN {_GENRES})"

# Messages by shape; ``user`` is what counts, NULL where nothing does.
_MESSAGES = """
msg AS (
  SELECT event_id, user_id, event_type,
         CASE WHEN event_id % 30 = 24 THEN 24 ELSE event_id % 10 END AS m,
         CASE WHEN event_id % 10 = 1 THEN 'null'
              WHEN event_id % 10 IN (0, 2, 3, 4) THEN NULL
              ELSE 'u' || user_id END AS username
  FROM events)
"""

_PAYLOAD = """
  SELECT event_id,
         CAST(CASE m WHEN 0 THEN event_id WHEN 1 THEN 12 WHEN 3 THEN 1
                     WHEN 4 THEN -1294967296 WHEN 2 THEN 0 WHEN 24 THEN 0
                     ELSE event_id END AS INTEGER) AS id,
         CASE WHEN m = 1 THEN 'null' WHEN m IN (0, 2, 3, 4, 24) THEN ''
              ELSE 'u' || user_id END AS username,
         CASE m WHEN 2 THEN '' WHEN 3 THEN '' WHEN 24 THEN '' WHEN 4 THEN '7' ELSE event_type END AS message,
         m
  FROM msg
"""

_COUNT_JSON = "'{\"username\":\"' || username || '\",\"messageCount\":' || message_count || '}'"

_RAW_MESSAGE = """
  CASE event_id % 10
    WHEN 0 THEN '{"id":' || event_id || ',"message":"' || event_type || '"}'
    WHEN 1 THEN '{"username":null,"id":"12.7","message":"' || event_type || '"}'
    WHEN 2 THEN 'bad{'
    WHEN 3 THEN '{"username":"","id":true}'
    WHEN 4 THEN CASE event_id % 30
      WHEN 14 THEN '{"username":{"x":1,"x":2},"id":3000000000,"message":7}'
      WHEN 24 THEN '["u",{"x":1,"x":2}]'
      ELSE '{"username":{"x":1},"id":3000000000,"message":7} trailing' END
    ELSE '{"username":"u' || user_id || '","id":' || event_id || ',"message":"' || event_type || '"}'
  END
"""


def _document(title: str, mean: str) -> str:
    return (
        "'{\"id\":' || p_partkey || ',\"title\":\"' || " + title + " || '\",\"rank\":' || "
        "CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE p_partkey END || ',\"mean\":' || "
        f"CAST({mean} AS VARCHAR) || ',\"num_episodes\":' || p_size || "
        "',\"genres\":[{\"name\":\"' || p_type || '\"},{\"name\":\"' || p_brand || "
        "'\"}],\"studios\":[{\"name\":\"S' || p_size || '\"}]}'"
    )


_CATALOGUE = f"""
cat AS (
  SELECT p_partkey AS id,
         CASE WHEN p_partkey % 10 <= 6 THEN 'primary' ELSE 'fallback' END AS provider,
         CASE WHEN p_partkey % 10 <= 6 THEN {_document('p_name', 'p_retailprice')}
              ELSE {_document('p_name', '(p_retailprice + 1)')} END AS doc,
         {_UNWANTED} AS unwanted
  FROM part
  WHERE p_partkey % 10 <= 6 OR (p_partkey % 10 <= 8 AND p_partkey % 11 <> 0))
"""

_ENRICHED = f"""
{_CATALOGUE},
enriched AS (
  SELECT CAST(l_partkey AS VARCHAR) AS key,
         coalesce(provider, 'raw') AS provider,
         coalesce(doc, '{{"anime_id":' || l_partkey || ',"title":"order ' || l_orderkey || '"}}') AS value,
         coalesce(unwanted, false) AS unwanted
  FROM lineitem LEFT JOIN cat ON id = l_partkey)
"""

_LANDED = """
landed AS (
  SELECT *, p_name AS title, CAST(1 AS BIGINT) AS seq FROM part
  UNION ALL
  SELECT *, 'outdated' AS title, CAST(0 AS BIGINT) AS seq FROM part WHERE p_size <= 5)
"""

_FROM_LINES = f"""
{_CATALOGUE},
feed AS (
  SELECT CAST(p_partkey AS VARCHAR) AS key, coalesce(cat.provider, 'raw') AS provider,
         coalesce(cat.doc, {_LINE_JSON}) AS value
  FROM part LEFT JOIN cat ON cat.id = p_partkey
  WHERE NOT {_BROKEN} AND NOT {_BLANK} AND NOT coalesce(cat.unwanted, false))
"""

_RANKED = """
ranked AS (
  SELECT c_custkey AS id,
         CAST(row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS rank
  FROM customer
  QUALIFY rank <= 100)
"""


def _scalars(mean: str) -> str:
    return (
        "seq, CAST(p_partkey AS INTEGER) AS id, title, "
        "CAST(CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE p_partkey END AS INTEGER) AS rank, "
        f"{mean} AS mean, p_size AS num_episodes"
    )


_LAST = """
  SELECT CAST(user_id AS VARCHAR) AS key,
         '{"anime_id":' || max(event_id) || ',"title":"' || max_by(event_type, event_id) || '"}' AS value,
         max(event_id) AS "offset"
  FROM events GROUP BY user_id
"""

_COUNTS = f"""
WITH {_MESSAGES}
SELECT username, count(*) AS message_count FROM msg WHERE username IS NOT NULL GROUP BY username
"""

_CHANGELOG = f"""
WITH {_MESSAGES},
log AS (
  SELECT username, event_id,
         CAST(row_number() OVER (PARTITION BY username ORDER BY event_id) AS BIGINT) AS message_count
  FROM msg WHERE username IS NOT NULL)
"""

_EVENT_INDEX = """
        SELECT 'es-' || event_type AS "index",
               'es-' || event_type || '+' || (user_id % 3) || '+' || event_id AS doc_id,
               props AS value
        FROM events"""

_SCANNED = f"""
        SELECT 'copied' AS topic, CAST(user_id % 3 AS INTEGER) AS partition,
               event_id AS "offset", {_RAW_MESSAGE} AS value
        FROM events"""

_WHOLE_FILES = f"""
        SELECT CAST(p_partkey AS VARCHAR) AS key, {_LINE_JSON} AS value, 'csv-raw' AS topic
        FROM part WHERE p_brand NOT IN 
          (SELECT p_brand FROM part WHERE {_BROKEN} OR {_BLANK})"""

_RESOLVED = """
        WITH log AS (
          SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, event_type,
                 coalesce(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (
                   PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS errors
          FROM events)
        SELECT user_id, day,
               min(CASE WHEN event_type NOT IN ('error', 'view') AND errors < 3 THEN event_id END)
                 AS resolved_at
        FROM log GROUP BY user_id, day"""

_CHOSEN = """
        WITH w AS (
          SELECT event_id, user_id, ts,
                 max(CASE WHEN event_type = 'error' THEN ts END) OVER (
                   PARTITION BY user_id ORDER BY event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_timeout
          FROM events)
        SELECT event_id, user_id,
               CASE WHEN last_timeout > ts - INTERVAL 12 HOUR THEN 'fallback' ELSE 'primary' END AS provider
        FROM w"""

_DELIVERED = f"""
        WITH {_ENRICHED}
        SELECT count(*) AS received,
               count(*) FILTER (provider = 'primary') AS from_primary,
               count(*) FILTER (provider = 'fallback') AS from_fallback,
               count(*) FILTER (provider = 'raw') AS failed,
               count(*) FILTER (unwanted) AS filtered_out,
               count(*) FILTER (NOT unwanted) AS delivered
        FROM enriched"""

ORACLES: dict[str, str] = {
    "payload_normalize": f"""
        WITH {_MESSAGES}, p AS ({_PAYLOAD})
        SELECT event_id AS "offset", id, username, message FROM p WHERE m <> 2""",
    "payload_topic": f"""
        WITH {_MESSAGES}, p AS ({_PAYLOAD})
        SELECT CAST(NULL AS VARCHAR) AS key, 'sample-datastream-es' AS topic,
               '{{"id":' || id || ',"username":"' || username || '","message":"' || message || '"}}' AS value
        FROM p""",
    "rejects": "SELECT event_id AS \"offset\", 'bad{' AS value FROM events WHERE event_id % 10 = 2",
    "message_count": _COUNTS,
    "message_count_stream": _COUNTS,
    "message_count_changelog": _CHANGELOG
    + 'SELECT username, event_id AS "offset", message_count FROM log',
    "message_count_changelog_stream": _CHANGELOG
    + f"SELECT 'null' AS key, {_COUNT_JSON} AS value, 'sample-count-es' AS topic FROM log",
    "topic_write": f"""
        SELECT 'null' AS key, {_COUNT_JSON} AS value, 'sample-count-es' AS topic FROM ({_COUNTS})""",
    "topic_scan": _SCANNED,
    "topic_scan_offsets": _SCANNED,
    "csv_parse": f"""
        SELECT p_brand AS source, CAST(p_partkey AS VARCHAR) AS key,
               CAST(p_partkey AS INTEGER) AS anime_id, {_LINE_TITLE} AS title, {_LINE_JSON} AS value
        FROM part WHERE NOT {_BROKEN} AND NOT {_BLANK}""",
    "csv_rejects": f"""
        SELECT p_brand AS source,
               CASE WHEN {_BROKEN} THEN p_partkey || ',' ELSE ' ' || chr(9) || ' ' END AS line
        FROM part WHERE {_BROKEN} OR {_BLANK}""",
    "csv_publish_atomic": _WHOLE_FILES,
    "csv_publish_commit": _WHOLE_FILES,
    "normalize_primary": f"""
        WITH {_LANDED} SELECT {_scalars('p_retailprice')} FROM landed WHERE p_partkey % 10 <= 6""",
    "normalize_fallback": f"""
        WITH {_LANDED} SELECT {_scalars('p_retailprice + 1')} FROM landed
        WHERE p_partkey % 10 <= 8 AND p_partkey % 11 <> 0""",
    "nested_prune": f"""
        WITH {_LANDED}
        SELECT seq, CAST(p_partkey AS INTEGER) AS id, p_type || '|' || p_brand AS genres,
               'S' || p_size AS studios
        FROM landed WHERE p_partkey % 10 <= 6""",
    "catalogue_merge": f"""
        WITH {_CATALOGUE} SELECT CAST(id AS INTEGER) AS id, provider, doc AS value FROM cat""",
    "enrich_drop": f"""
        WITH {_ENRICHED} SELECT key, provider, value FROM enriched WHERE provider <> 'raw'""",
    "enrich_passthrough": f"WITH {_ENRICHED} SELECT key, provider, value FROM enriched",
    "genre_exclude": f"WITH {_ENRICHED} SELECT key, value FROM enriched WHERE NOT unwanted",
    "enriched_feed": f"""
        WITH {_ENRICHED} SELECT key, provider, value FROM enriched WHERE NOT unwanted""",
    "enriched_feed_strict": f"""
        WITH {_ENRICHED} SELECT CAST(NULL AS VARCHAR) AS key, provider, value FROM enriched
        WHERE provider <> 'raw' AND NOT unwanted""",
    "csv_to_index": f"WITH {_FROM_LINES} SELECT key, provider, value FROM feed",
    "csv_to_index_stream": f"""
        WITH {_FROM_LINES} SELECT 'es-anime-data' AS "index", value FROM feed""",
    "lines_index_stream": f"""
        WITH {_FROM_LINES} SELECT 'es-anime-data' AS "index", value FROM feed""",
    "payload_index": f"""
        WITH {_MESSAGES}, p AS ({_PAYLOAD})
        SELECT 'sample-datastream-es' AS "index",
               '{{"id":' || id || ',"username":"' || username || '","message":"' || message || '"}}' AS value
        FROM p""",
    "count_index": _CHANGELOG
    + f"SELECT 'sample-count-es' AS \"index\", {_COUNT_JSON} AS value FROM log",
    "ranked_index": f"""
        WITH {_RANKED}, {_CATALOGUE}
        SELECT 'to-elastic-search' AS "index", doc AS value FROM ranked JOIN cat ON cat.id = ranked.id""",
    "strict_index": f"""
        WITH {_ENRICHED} SELECT 'es-anime-data' AS "index", value FROM enriched
        WHERE provider <> 'raw' AND NOT unwanted""",
    "raw_guard": f"""
        SELECT 'sample-datastream-raw' AS topic, event_id AS "offset", {_RAW_MESSAGE} AS value
        FROM events WHERE event_id % 10 <> 2""",
    "published_last": f"SELECT key, value FROM ({_LAST})",
    "lookup_ids_stream": f"""
        WITH {_CATALOGUE}
        SELECT DISTINCT CAST(l_partkey AS INTEGER) AS id
        FROM lineitem WHERE l_partkey NOT IN (SELECT id FROM cat)""",
    "last_enriched_stream": f"""
        WITH {_CATALOGUE}
        SELECT CAST(user_id AS VARCHAR) AS key, max_by(doc, event_id) AS value,
               max(event_id) AS "offset"
        FROM events JOIN cat ON id = event_id GROUP BY user_id""",
    "delivery_metrics": _DELIVERED,
    "delivery_metrics_stream": _DELIVERED,
    "attempt_resolve": _RESOLVED,
    "attempt_resolve_stream": _RESOLVED,
    "provider_window": _CHOSEN,
    "provider_window_stream": _CHOSEN,
    "lookup_dedup": """
        SELECT CAST(user_id AS VARCHAR) AS key, min(event_id) AS first_offset
        FROM events GROUP BY user_id""",
    "lookup_ids": """
        SELECT CAST(event_id AS INTEGER) AS id, min(event_id) AS first_offset
        FROM events GROUP BY event_id""",
    "lookup_pending": f"""
        WITH {_CATALOGUE}
        SELECT CAST(l_partkey AS INTEGER) AS id, count(*) AS requests
        FROM lineitem WHERE l_partkey NOT IN (SELECT id FROM cat) GROUP BY l_partkey""",
    "last_state": _LAST,
    "last_state_stream": _LAST,
    "last_state_snapshot": _LAST,
    "state_store_read": _LAST,
    "split_write": f"""
        SELECT CASE WHEN event_id % 10 = 2 THEN 'rejected' ELSE 'good' END AS verdict,
               event_id AS "offset", {_RAW_MESSAGE} AS value
        FROM events""",
    "enrich_late_stream": f"""
        WITH {_CATALOGUE}
        SELECT CAST(user_id AS VARCHAR) AS key, event_id AS "offset",
               CASE WHEN event_id % 3 < 2 THEN coalesce(provider, 'raw') ELSE 'raw' END AS provider,
               CASE WHEN event_id % 3 < 2 AND doc IS NOT NULL THEN doc
                    ELSE '{{"anime_id":' || event_id || ',"title":"' || event_type || '"}}' END AS value
        FROM events LEFT JOIN cat ON id = event_id""",
    "last_enriched": f"""
        WITH {_CATALOGUE}
        SELECT CAST(user_id AS VARCHAR) AS key, max_by(doc, event_id) AS value,
               max(event_id) AS "offset"
        FROM events JOIN cat ON id = event_id GROUP BY user_id""",
    "rank_pages": f"WITH {_RANKED} SELECT id, rank, (rank - 1) // 20 AS page FROM ranked",
    "rank_page_explode": f"""
        WITH {_RANKED}
        SELECT CAST((rank - 1) % 20 AS INTEGER) AS place, CAST(id AS VARCHAR) AS id
        FROM ranked""",
    "ranked_details": f"""
        WITH {_RANKED}, {_CATALOGUE}
        SELECT CAST(cat.id AS INTEGER) AS id, doc AS value FROM ranked JOIN cat ON cat.id = ranked.id""",
    "index_docs": _EVENT_INDEX,
    "index_replay": _EVENT_INDEX,
    "sink_inventory": """
        SELECT 'es-' || event_type AS "index", count(*) AS docs FROM events GROUP BY event_type""",
    "sink_truncate": """
        SELECT 'es-error' AS "index", count(*) > 0 AS existed, count(*) AS docs_before,
               CAST(0 AS BIGINT) AS docs_after
        FROM events WHERE event_type = 'error'
        UNION ALL
        SELECT 'es-anime-data', false, CAST(0 AS BIGINT), CAST(0 AS BIGINT)""",
    "sink_after_truncate": """
        SELECT 'es-' || event_type AS "index",
               count(*) FILTER (event_type <> 'error') AS docs
        FROM events GROUP BY event_type""",
}
