"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillworks.operators.attempts import ERROR, SUCCESS, TIMEOUT, choose_provider, resolve_attempts
from rillworks.operators.catalogue import (
    FALLBACK,
    PRIMARY,
    catalogue,
    normalize_responses,
    read_catalogue,
    write_catalogue,
)
from rillworks.operators.counts import count_changelog, count_documents, count_messages
from rillworks.operators.enrich import (
    enrich_or_drop,
    enrich_or_pass,
    first_per_key,
    ids_pending,
    ids_to_look_up,
)
from rillworks.operators.genres import exclude_enriched
from rillworks.operators.lines import keep_whole_units, parse_lines
from rillworks.operators.metrics import delivery_metrics
from rillworks.operators.payloads import guarded, is_json, normalize_payload, rejected_payloads, with_username
from rillworks.operators.ranking import page_documents, page_ids, rank_pages
from rillworks.operators.split import read_split, split_write
from rillworks.operators.state import last_documents, last_values
from rillworks.plans import derived, flows
from rillworks.schemas import (
    TOPIC_COUNTS,
    TOPIC_CSV,
    TOPIC_DOCS,
    TOPIC_DOCS_DROP,
    TOPIC_DOCS_RANKED,
    TOPIC_MESSAGES,
    TOPIC_MESSAGES_CLEAN,
    TOPIC_RANK_IDS,
    TOPIC_RANK_PAGES,
)
from rillworks.session import scratch_dir
from rillworks.sinks import (
    as_topic,
    index_rows,
    inventory,
    publish,
    publish_units,
    read_index,
    read_units,
    truncate_index,
    write_index,
    write_topic_stream,
)
from rillworks.sinks.snapshots import compact, read_snapshot
from rillworks.sources import (
    note_positions,
    raw_lines,
    read_lines,
    read_pages,
    read_responses,
    read_topic,
    stream_offsets,
    stream_topic,
)
from rillworks.streaming import (
    COUNTS,
    IDS,
    LAST,
    DeliveryListener,
    append_stream,
    changelog_stream,
    choose_provider_stream,
    delivery_totals,
    drain,
    enrich_late,
    feed_stream,
    index_stream,
    last_documents_stream,
    last_store_stream,
    last_values_stream,
    line_index_stream,
    lookup_ids_stream,
    read_deliveries,
    read_store,
    resolve_attempts_stream,
    rocksdb_state,
    topic_index_stream,
    total_counts_stream,
)

#: The store that keeps the last value of each key, by name.
LAST_STORE = "last_value"
LAST_ROWS = "key string, value string, offset bigint"

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf: str, require_lists: bool = False) -> DataFrame:
    return catalogue(
        derived.primary_responses(spark, sf), derived.fallback_responses(spark, sf), require_lists
    )


def _written(spark: SparkSession, sf: str, require_lists: bool = False) -> DataFrame:
    """The catalogue, built once and read from then on."""
    path = scratch_dir(spark, "catalogue")
    write_catalogue(_documents(spark, sf, require_lists), path)
    return read_catalogue(spark, path)


def _in_batches(spark: SparkSession, records: DataFrame, topic: str, by: Column, batches: int = 3):
    """A topic that grows batch by batch; yields its path each time it has grown."""
    path = scratch_dir(spark, topic)
    part = F.pmod(F.xxhash64(by), F.lit(batches))
    for batch in range(batches):
        publish(records.where(part == batch), topic, path, batch)
        yield path


def _joined(lists: str) -> F.Column:
    return F.array_join(F.col(f"doc.{lists}.name"), "|").alias(lists)


# Messages


def payload_normalize(spark: SparkSession, sf: str) -> DataFrame:
    clean = normalize_payload(derived.messages(spark, sf), policy="skip")
    return clean.select("offset", "id", "username", "message")


def payload_topic(spark: SparkSession, sf: str) -> DataFrame:
    clean = flows.clean_messages(derived.messages(spark, sf), policy="empty")
    return as_topic(clean, TOPIC_MESSAGES_CLEAN).select("key", "value", "topic")


def rejects(spark: SparkSession, sf: str) -> DataFrame:
    return rejected_payloads(derived.messages(spark, sf)).select("offset", "value")


def split_messages(spark: SparkSession, sf: str) -> DataFrame:
    path, records = scratch_dir(spark, "split"), derived.messages(spark, sf)
    split_write(records, is_json("value"), path)
    return read_split(spark, path, records).select("verdict", "offset", "value")


def message_count(spark: SparkSession, sf: str) -> DataFrame:
    return count_messages(with_username(derived.messages(spark, sf)))


def message_count_changelog(spark: SparkSession, sf: str) -> DataFrame:
    keyed = with_username(derived.messages(spark, sf))
    return count_changelog(keyed, position=("offset",))


def topic_write(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "counts")
    publish(flows.user_counts(derived.messages(spark, sf)), TOPIC_COUNTS, path)
    return read_topic(spark, path).select("key", "value", "topic")


def topic_scan(spark: SparkSession, sf: str) -> DataFrame:
    source = stream_topic(spark, derived.message_topic(spark, sf))
    path, checkpoint = scratch_dir(spark, "copy"), scratch_dir(spark, "checkpoint")
    drain(write_topic_stream(source, "copied", path, checkpoint))
    return read_topic(spark, path).select("topic", "partition", "offset", "value")


def topic_scan_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """A topic that grows, read by offsets in batches that end within its files."""
    topic, path = scratch_dir(spark, "messages"), scratch_dir(spark, "copy")
    checkpoint, positions = scratch_dir(spark, "checkpoint"), scratch_dir(spark, "positions")
    records = derived.messages(spark, sf)
    n, last = records.agg(F.count(F.lit(1)), F.max("offset")).first()
    for batch, later in enumerate((False, True)):
        some = records.where((F.col("offset") > (last or 0) // 2) == F.lit(later))
        some.write.parquet(f"{topic}/batch={batch}")
        note_positions(spark, topic, batch)
        source = stream_offsets(spark, topic, positions, max(1, n // 3))
        # A run, as a restart after a stop would, goes on where the last one ended.
        while drain(write_topic_stream(source, "copied", path, checkpoint)):
            pass
    return read_topic(spark, path).select("topic", "partition", "offset", "value")


def message_count_stream(spark: SparkSession, sf: str) -> DataFrame:
    keyed = with_username(stream_topic(spark, derived.message_topic(spark, sf)))
    path, checkpoint = scratch_dir(spark, "totals"), scratch_dir(spark, "checkpoint")
    drain(total_counts_stream(keyed, path, checkpoint))
    changes = spark.read.schema(COUNTS).parquet(path)
    return changes.groupBy("username").agg(F.max("message_count").alias("message_count"))


def message_count_changelog_stream(spark: SparkSession, sf: str) -> DataFrame:
    keyed = with_username(stream_topic(spark, derived.message_topic(spark, sf)))
    path, checkpoint = scratch_dir(spark, "changelog"), scratch_dir(spark, "checkpoint")
    records = count_documents(changelog_stream(keyed))
    drain(write_topic_stream(records, TOPIC_COUNTS, path, checkpoint))
    return read_topic(spark, path).select("key", "value", "topic")


# Lines


def csv_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_lines(read_lines(spark, derived.line_files(spark, sf)))
    return parsed.where("ok").select("source", "key", "anime_id", "title", "value")


def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_lines(read_lines(spark, derived.line_files(spark, sf)))
    return parsed.where("not ok").select("source", "line")


def csv_publish_atomic(spark: SparkSession, sf: str) -> DataFrame:
    path = derived.line_files(spark, sf)
    parsed = parse_lines(read_lines(spark, path))
    whole = keep_whole_units(parsed, "source")
    topic = scratch_dir(spark, "csv-raw")
    publish(whole.select("key", "value"), TOPIC_CSV, topic)
    return read_topic(spark, topic).select("key", "value", "topic")


def csv_publish_commit(spark: SparkSession, sf: str) -> DataFrame:
    """Files published whole by commit markers, in one scan of the lines."""
    path = scratch_dir(spark, "published")
    parsed = parse_lines(read_lines(spark, derived.line_files(spark, sf)))
    publish_units(parsed.select("file", "ok", "key", "value"), path, "csv", "file")
    rows = read_units(spark, path, "file string, key string, value string")
    return as_topic(rows, TOPIC_CSV).select("key", "value", "topic")


# Answers and enrichment


def _normalized(responses: DataFrame, provider: str) -> DataFrame:
    docs = normalize_responses(responses.where("body is not null"), provider)
    return docs.where("doc is not null")


def normalize_primary(spark: SparkSession, sf: str) -> DataFrame:
    docs = _normalized(derived.primary_responses(spark, sf), PRIMARY)
    return docs.select("seq", "doc.id", "doc.title", "doc.rank", "doc.mean", "doc.num_episodes")


def normalize_fallback(spark: SparkSession, sf: str) -> DataFrame:
    docs = _normalized(derived.fallback_responses(spark, sf), FALLBACK)
    return docs.select("seq", "doc.id", "doc.title", "doc.rank", "doc.mean", "doc.num_episodes")


def nested_prune(spark: SparkSession, sf: str) -> DataFrame:
    docs = _normalized(derived.primary_responses(spark, sf), PRIMARY)
    return docs.select("seq", "doc.id", _joined("genres"), _joined("studios"))


def catalogue_merge(spark: SparkSession, sf: str) -> DataFrame:
    primary, fallback = scratch_dir(spark, "primary"), scratch_dir(spark, "fallback")
    derived.primary_responses(spark, sf).write.parquet(primary)
    derived.fallback_responses(spark, sf).write.parquet(fallback)
    documents = catalogue(read_responses(spark, primary), read_responses(spark, fallback))
    return documents.select("id", "provider", F.col("document").alias("value"))


def enrich_drop(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_or_drop(derived.requests(spark, sf), _documents(spark, sf)).select(
        "key", "provider", "value"
    )


def enrich_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_or_pass(derived.requests(spark, sf), _documents(spark, sf)).select(
        "key", "provider", "value"
    )


def genre_exclude(spark: SparkSession, sf: str) -> DataFrame:
    enriched = enrich_or_pass(derived.requests(spark, sf), _documents(spark, sf))
    return exclude_enriched(enriched, derived.EXPLICIT).select("key", "value")


def enriched_feed(spark: SparkSession, sf: str) -> DataFrame:
    return flows.enriched_feed(
        derived.requests(spark, sf), _documents(spark, sf), derived.EXPLICIT
    ).select("key", "provider", "value")


def enriched_feed_strict(spark: SparkSession, sf: str) -> DataFrame:
    return flows.enriched_feed_strict(
        derived.requests(spark, sf), _documents(spark, sf), derived.EXPLICIT
    ).select("key", "provider", "value")


def csv_to_index(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_lines(read_lines(spark, derived.line_files(spark, sf)))
    return flows.enriched_feed(
        flows.line_requests(parsed), _documents(spark, sf), derived.EXPLICIT
    ).select("key", "provider", "value")


def csv_to_index_stream(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_lines(read_lines(spark, derived.line_files(spark, sf)))
    asked = flows.line_requests(parsed).select("key", "value")
    documents, root = _written(spark, sf), scratch_dir(spark, "index")
    checkpoint = scratch_dir(spark, "checkpoint")
    for topic in _in_batches(spark, asked, TOPIC_CSV, F.col("key")):
        stream = stream_topic(spark, topic)
        drain(index_stream(stream, documents, root, checkpoint, "feed", derived.EXPLICIT))
    return read_index(spark, root).select("index", "value")


def lines_index_stream(spark: SparkSession, sf: str) -> DataFrame:
    documents, root = _written(spark, sf), scratch_dir(spark, "index")
    lines = raw_lines(spark, derived.line_files(spark, sf), streaming=True)
    checkpoint = scratch_dir(spark, "checkpoint")
    drain(line_index_stream(lines, documents, root, checkpoint, "lines", derived.EXPLICIT))
    return read_index(spark, root).select("index", "value")


def _indexed(spark: SparkSession, topic: str, writer: str) -> DataFrame:
    """A published topic taken to its index by a stream."""
    root, checkpoint = scratch_dir(spark, "index"), scratch_dir(spark, "checkpoint")
    drain(topic_index_stream(stream_topic(spark, topic), root, checkpoint, writer))
    return read_index(spark, root).select("index", "value")


def payload_index(spark: SparkSession, sf: str) -> DataFrame:
    clean = flows.clean_messages(derived.messages(spark, sf), policy="empty")
    topic = scratch_dir(spark, "clean")
    publish(clean, TOPIC_MESSAGES_CLEAN, topic)
    return _indexed(spark, topic, "messages")


def count_index(spark: SparkSession, sf: str) -> DataFrame:
    keyed = with_username(stream_topic(spark, derived.message_topic(spark, sf)))
    topic, checkpoint = scratch_dir(spark, "changelog"), scratch_dir(spark, "checkpoint")
    drain(write_topic_stream(count_documents(changelog_stream(keyed)), TOPIC_COUNTS, topic, checkpoint))
    return _indexed(spark, topic, "counts")


def ranked_index(spark: SparkSession, sf: str) -> DataFrame:
    pages, ids, details = (scratch_dir(spark, n) for n in ("pages", "ids", "details"))
    no_key = F.lit(None).cast("string").alias("key")
    publish(page_documents(_ranked(spark, sf)).select(no_key, "value"), TOPIC_RANK_PAGES, pages)
    entries = page_ids(read_topic(spark, pages))
    publish(entries.select(no_key, F.col("id").alias("value")), TOPIC_RANK_IDS, ids)
    asked = read_topic(spark, ids).select(F.col("value").alias("id"))
    publish(flows.id_details(asked, _documents(spark, sf, True)), TOPIC_DOCS_RANKED, details)
    return _indexed(spark, details, "ranking")


def strict_index(spark: SparkSession, sf: str) -> DataFrame:
    feed = flows.enriched_feed_strict(derived.requests(spark, sf), _documents(spark, sf), derived.EXPLICIT)
    hop, topic = scratch_dir(spark, "enriched"), scratch_dir(spark, "filtered")
    publish(feed.select("key", "value"), TOPIC_DOCS_DROP, hop)
    publish(guarded(read_topic(spark, hop)).select("key", "value"), TOPIC_DOCS, topic)
    return _indexed(spark, topic, "strict")


def raw_guard(spark: SparkSession, sf: str) -> DataFrame:
    sound = guarded(derived.messages(spark, sf))
    return as_topic(sound, TOPIC_MESSAGES).select("topic", "offset", "value")


def published_last(spark: SparkSession, sf: str) -> DataFrame:
    topic = scratch_dir(spark, "csv-raw")
    asked = derived.user_requests(spark, sf).repartition(7)
    publish(asked, TOPIC_CSV, topic, order=["offset"], partitions=3)
    return last_values(read_topic(spark, topic)).select("key", "value")


def delivery_metrics_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches, each a restart; the table is written while they run."""
    documents, checkpoint = _written(spark, sf), scratch_dir(spark, "checkpoint")
    notes, path = scratch_dir(spark, "deliveries"), scratch_dir(spark, "feed")
    listener = DeliveryListener(spark, notes)
    spark.streams.addListener(listener)
    try:
        for topic in _in_batches(spark, derived.requests(spark, sf), TOPIC_CSV, F.col("value")):
            feed = feed_stream(stream_topic(spark, topic), documents, path, checkpoint, derived.EXPLICIT)
            with rocksdb_state(spark):
                query = feed.trigger(availableNow=True).start()
                query.awaitTermination()
            listener.wait(str(query.runId))
    finally:
        spark.streams.removeListener(listener)
    return delivery_totals(read_deliveries(spark, notes))


def enrich_late_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Requests and answers as two streams; of three answers one is early, one late, one too late."""
    asked, came = scratch_dir(spark, "requests"), scratch_dir(spark, "answers")
    path, checkpoint = scratch_dir(spark, "enriched"), scratch_dir(spark, "checkpoint")
    requests = derived.user_requests(spark, sf)
    n = max(1, requests.count())
    turn = F.col("id") % 3
    answers = (
        _documents(spark, sf)
        .join(derived.table(spark, sf, "events").select(F.col("event_id").cast("int").alias("id"), "ts"), "id")
        .select(
            "id", "provider", "document",
            (
                F.col("ts").cast("timestamp")
                + F.when(turn == 0, F.expr("INTERVAL '-1' HOUR")).when(turn == 1, F.expr("INTERVAL '2' HOUR"))
                .otherwise(F.expr("INTERVAL '60' DAY"))
            ).alias("answered_at"),
        )
    )
    answers = answers.withColumn("part", F.least(F.floor((F.col("id") + n // 25) * 3 / n), F.lit(2)))
    held = scratch_dir(spark, "all-answers")
    answers.write.parquet(held)
    answers = spark.read.schema(answers.schema).parquet(held)
    placed = requests.withColumn("part", F.least(F.floor(F.col("offset") * 3 / n), F.lit(2)))
    end = F.lit("2100-01-01").cast("timestamp")
    for batch in range(4):
        if batch < 3:
            left = placed.where(F.col("part") == batch).drop("part")
            right = answers.where(F.col("part") == batch).drop("part")
        else:
            # The end of time on both sides, so that every request is settled.
            left = requests.limit(1).withColumns({"key": F.lit("end"), "timestamp": end})
            right = answers.limit(1).drop("part").withColumns({"id": F.lit(-1), "answered_at": end})
        left.write.parquet(f"{asked}/batch={batch}")
        right.write.parquet(f"{came}/batch={batch}")
        late = enrich_late(
            stream_topic(spark, asked),
            spark.readStream.schema(answers.drop("part").schema).parquet(came),
            "1 DAY", "1 DAY", "4 days",
        )
        drain(append_stream(late, path, checkpoint))
    found = spark.read.schema(late.schema).parquet(path)
    return found.where("key <> 'end'").select("key", "offset", "provider", "value")


def delivery_counts(spark: SparkSession, sf: str) -> DataFrame:
    return delivery_metrics(
        derived.requests(spark, sf), _documents(spark, sf), derived.EXPLICIT
    )


# Lookups and state


def attempt_resolve(spark: SparkSession, sf: str) -> DataFrame:
    log = derived.table(spark, sf, "events").withColumn(
        "day", F.col("ts").cast("date").cast("string")
    )
    return resolve_attempts(log, ["user_id", "day"], _lookup_kind(), "event_id")


def provider_window(spark: SparkSession, sf: str) -> DataFrame:
    calls = derived.table(spark, sf, "events")
    chosen = choose_provider(
        calls, ["user_id"], ["event_id"], F.col("event_type") == "error", 12 * 3600
    )
    return chosen.select("event_id", "user_id", "provider")


def _arriving(spark: SparkSession, sf: str, batches: int = 3):
    """The events batch by batch, out of order within bounds; yields them as a stream.

    The last batch holds one row without a user, long after all others, so that time
    moves past them.
    """
    path = scratch_dir(spark, "arriving")
    events = derived.table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")
    )
    n = max(1, events.count())
    late = F.col("event_id") + F.pmod(F.col("event_id") * 37, F.lit(max(1, n // 25)))
    part = F.least(F.floor(late * batches / n), F.lit(batches - 1))
    end = spark.range(1).select(
        *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in ("event_id", "user_id", "event_type")],
        F.lit("2100-01-01").cast("timestamp").alias("ts"),
    )
    for batch, rows in enumerate([*(events.where(part == b) for b in range(batches)), end]):
        rows.write.parquet(f"{path}/batch={batch}")
        yield spark.readStream.schema(events.schema).parquet(path)


def _lookup_kind() -> Column:
    return (
        F.when(F.col("event_type") == "error", ERROR)
        .when(F.col("event_type") == "view", TIMEOUT)
        .otherwise(SUCCESS)
    )


def attempt_resolve_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches and the end, each a restart on one checkpoint."""
    path, checkpoint = scratch_dir(spark, "resolved"), scratch_dir(spark, "checkpoint")
    for events in _arriving(spark, sf):
        day = F.when(F.col("user_id").isNotNull(), F.col("ts").cast("date").cast("string"))
        log = events.withColumn("day", day)
        over = F.date_add(F.col("ts").cast("date"), 1)
        settled = resolve_attempts_stream(log, ["user_id", "day"], _lookup_kind(), "event_id", over, "4 days")
        drain(append_stream(settled, path, checkpoint))
    return spark.read.schema(settled.schema).parquet(path)


def provider_window_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches and the end, each a restart on one checkpoint."""
    path, checkpoint = scratch_dir(spark, "chosen"), scratch_dir(spark, "checkpoint")
    for events in _arriving(spark, sf):
        timed_out = F.col("event_type") == "error"
        chosen = choose_provider_stream(events, ["user_id"], "event_id", timed_out, "4 days", 12 * 3600)
        drain(append_stream(chosen, path, checkpoint))
    found = spark.read.schema(chosen.schema).parquet(path)
    return found.select(F.col("at").alias("event_id"), "user_id", "provider")


def lookup_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return first_per_key(derived.user_requests(spark, sf))


def lookup_ids(spark: SparkSession, sf: str) -> DataFrame:
    return ids_to_look_up(derived.user_requests(spark, sf))


def lookup_pending(spark: SparkSession, sf: str) -> DataFrame:
    return ids_pending(derived.requests(spark, sf), _documents(spark, sf))


def last_state(spark: SparkSession, sf: str) -> DataFrame:
    return last_values(derived.user_requests(spark, sf))


def last_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    topic = scratch_dir(spark, "csv-raw")
    derived.user_requests(spark, sf).write.parquet(topic)
    path, checkpoint = scratch_dir(spark, "last"), scratch_dir(spark, "checkpoint")
    drain(last_values_stream(stream_topic(spark, topic), path, checkpoint))
    return last_values(spark.read.schema(LAST).parquet(path))


def last_state_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches with a compaction after each; one generation is read."""
    path, root, checkpoint = (scratch_dir(spark, n) for n in ("last", "snapshots", "checkpoint"))
    topic, asked = scratch_dir(spark, "csv-raw"), derived.user_requests(spark, sf)
    for batch in range(3):
        asked.where(F.col("offset") % 3 == batch).write.mode("append").parquet(topic)
        drain(last_values_stream(stream_topic(spark, topic), path, checkpoint))
        compact(spark, path, root, LAST_ROWS, ["key"], last_values)
    return read_snapshot(spark, root, LAST_ROWS).select("key", "value", "offset")


def state_store_read(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches into a named store, which is read as a table."""
    path, checkpoint, topic = (scratch_dir(spark, n) for n in ("changes", "checkpoint", "csv-raw"))
    asked = derived.user_requests(spark, sf)
    for batch in range(3):
        asked.where(F.col("offset") % 3 == batch).write.mode("append").parquet(topic)
        drain(append_stream(last_store_stream(stream_topic(spark, topic), LAST_STORE), path, checkpoint))
    return read_store(spark, checkpoint, LAST_STORE)


def last_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return last_documents(derived.user_requests(spark, sf), _documents(spark, sf))


def last_enriched_stream(spark: SparkSession, sf: str) -> DataFrame:
    documents, path = _written(spark, sf), scratch_dir(spark, "last")
    checkpoint, topic = scratch_dir(spark, "checkpoint"), scratch_dir(spark, "csv-raw")
    asked = derived.user_requests(spark, sf)
    for batch in range(3):
        asked.where(F.col("offset") % 3 == batch).write.mode("append").parquet(topic)
        drain(last_documents_stream(stream_topic(spark, topic), documents, path, checkpoint))
    return last_values(spark.read.schema(LAST).parquet(path))


def lookup_ids_over_batches(spark: SparkSession, sf: str) -> DataFrame:
    documents, path = _written(spark, sf), scratch_dir(spark, "pending")
    checkpoint = scratch_dir(spark, "checkpoint")
    for topic in _in_batches(spark, derived.requests(spark, sf), TOPIC_CSV, F.col("value")):
        drain(lookup_ids_stream(stream_topic(spark, topic), documents, path, checkpoint))
    return spark.read.schema(IDS).parquet(path).select("id")


# Ranking


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    return rank_pages(derived.table(spark, sf, "customer"), "c_custkey", order, 100, 20)


def rank_pages_top(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf)


def rank_page_explode(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "pages")
    page_documents(_ranked(spark, sf)).select("value").write.text(path)
    return page_ids(read_pages(spark, path)).select("place", "id")


def ranked_details(spark: SparkSession, sf: str) -> DataFrame:
    pages = page_documents(_ranked(spark, sf))
    return flows.ranked_details(pages, _documents(spark, sf, True)).select("id", "value")


# Index sink


def index_docs(spark: SparkSession, sf: str) -> DataFrame:
    docs = derived.event_documents(spark, sf)
    root = scratch_dir(spark, "index")
    write_index(index_rows(docs.union(docs)), root, 0)
    write_index(index_rows(docs.union(docs)), root, 0)
    return read_index(spark, root).select("index", "doc_id", "value")


def index_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Two writers with checkpoints of their own read one growing topic from its start."""
    root, topic = scratch_dir(spark, "index"), scratch_dir(spark, "topic")
    docs = derived.event_documents(spark, sf)
    for writer, parts in (("first", (0, 1)), ("second", (2,))):
        checkpoint = scratch_dir(spark, "checkpoint")
        for part in parts:
            some = docs.where(F.col("offset") % 3 == part)
            some.write.parquet(f"{topic}/batch={part}")
            drain(topic_index_stream(stream_topic(spark, topic), root, checkpoint, writer, replays=True))
    return read_index(spark, root).select("index", "doc_id", "value")


def _event_index(spark: SparkSession, sf: str) -> str:
    root = scratch_dir(spark, "index")
    docs = index_rows(derived.event_documents(spark, sf), may_repeat=False)
    write_index(docs, root, 0)
    return root


def sink_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return inventory(spark, _event_index(spark, sf)).select("index", "docs")


def sink_truncate(spark: SparkSession, sf: str) -> DataFrame:
    root = _event_index(spark, sf)
    report = truncate_index(spark, root, "es-error")
    return report.union(truncate_index(spark, root, TOPIC_DOCS))


def sink_after_truncate(spark: SparkSession, sf: str) -> DataFrame:
    root = _event_index(spark, sf)
    truncate_index(spark, root, "es-error")
    return inventory(spark, root).select("index", "docs")


QUERIES: dict[str, Query] = {
    "payload_normalize": payload_normalize,
    "payload_topic": payload_topic,
    "rejects": rejects,
    "split_write": split_messages,
    "message_count": message_count,
    "message_count_changelog": message_count_changelog,
    "topic_write": topic_write,
    "topic_scan": topic_scan,
    "topic_scan_offsets": topic_scan_offsets,
    "message_count_stream": message_count_stream,
    "message_count_changelog_stream": message_count_changelog_stream,
    "csv_parse": csv_parse,
    "csv_rejects": csv_rejects,
    "csv_publish_atomic": csv_publish_atomic,
    "csv_publish_commit": csv_publish_commit,
    "normalize_primary": normalize_primary,
    "normalize_fallback": normalize_fallback,
    "nested_prune": nested_prune,
    "catalogue_merge": catalogue_merge,
    "enrich_drop": enrich_drop,
    "enrich_passthrough": enrich_passthrough,
    "genre_exclude": genre_exclude,
    "enriched_feed": enriched_feed,
    "enriched_feed_strict": enriched_feed_strict,
    "csv_to_index": csv_to_index,
    "csv_to_index_stream": csv_to_index_stream,
    "lines_index_stream": lines_index_stream,
    "payload_index": payload_index,
    "count_index": count_index,
    "ranked_index": ranked_index,
    "strict_index": strict_index,
    "raw_guard": raw_guard,
    "published_last": published_last,
    "delivery_metrics": delivery_counts,
    "delivery_metrics_stream": delivery_metrics_stream,
    "enrich_late_stream": enrich_late_stream,
    "attempt_resolve": attempt_resolve,
    "attempt_resolve_stream": attempt_resolve_stream,
    "provider_window": provider_window,
    "provider_window_stream": provider_window_stream,
    "lookup_dedup": lookup_dedup,
    "lookup_ids": lookup_ids,
    "lookup_pending": lookup_pending,
    "last_state": last_state,
    "last_state_stream": last_state_stream,
    "last_state_snapshot": last_state_snapshot,
    "state_store_read": state_store_read,
    "last_enriched": last_enriched,
    "last_enriched_stream": last_enriched_stream,
    "lookup_ids_stream": lookup_ids_over_batches,
    "rank_pages": rank_pages_top,
    "rank_page_explode": rank_page_explode,
    "ranked_details": ranked_details,
    "index_docs": index_docs,
    "index_replay": index_replay,
    "sink_inventory": sink_inventory,
    "sink_truncate": sink_truncate,
    "sink_after_truncate": sink_after_truncate,
}
