"""Streams over files: several runs on one checkpoint, equal to one batch."""

import json

import pytest
from pyspark.sql import functions as F

from rillworks.operators.catalogue import catalogue
from rillworks.operators.counts import count_changelog, count_messages
from rillworks.operators.enrich import enrich_or_pass
from rillworks.operators.genres import exclude_enriched
from rillworks.operators.payloads import with_username
from rillworks.schemas import ENVELOPE
from rillworks.sinks import (
    index_rows,
    inventory,
    publish,
    read_index,
    truncate_index,
    write_index,
    write_topic_stream,
)
from rillworks.operators.state import last_documents, last_values
from rillworks.sources import raw_lines, read_topic, stream_topic
from rillworks.streaming import (
    LAST,
    changelog_stream,
    drain,
    index_stream,
    last_documents_stream,
    last_values_stream,
    line_index_stream,
    rocksdb_state,
    total_counts_stream,
)


def _land(spark, path, records, first=0):
    rows = [(k, v, "t", 0, first + i, None) for i, (k, v) in enumerate(records)]
    spark.createDataFrame(rows, ENVELOPE).write.mode("append").parquet(path)
    return first + len(rows)


def _message(name):
    return None, json.dumps({"username": name})


@pytest.fixture
def dirs(tmp_path):
    return lambda name: str(tmp_path / name)


BATCHES = ["aabac", "cab", "aaaaaaad"]


def test_changelog_over_restarts(spark, dirs):
    at = 0
    for names in BATCHES:
        at = _land(spark, dirs("in"), map(_message, names), at)
        keyed = with_username(stream_topic(spark, dirs("in")))
        records = changelog_stream(keyed).select(
            F.col("username").alias("key"), F.col("message_count").cast("string").alias("value")
        )
        drain(write_topic_stream(records, "counts", dirs("out"), dirs("ck")))
    got = sorted((r.key, int(r.value)) for r in read_topic(spark, dirs("out")).collect())
    batch = count_changelog(with_username(read_topic(spark, dirs("in"))))
    assert got == sorted((r.username, r.message_count) for r in batch.collect())
    assert len(got) == sum(map(len, BATCHES))


def test_totals_over_restarts(spark, dirs):
    at = 0
    for names in BATCHES:
        at = _land(spark, dirs("in"), map(_message, names), at)
        keyed = with_username(stream_topic(spark, dirs("in")))
        drain(total_counts_stream(keyed, dirs("out"), dirs("ck")))
    changes = spark.read.parquet(dirs("out"))
    got = changes.groupBy("username").agg(F.max("message_count").alias("n")).collect()
    batch = count_messages(with_username(read_topic(spark, dirs("in"))))
    assert {tuple(r) for r in got} == {tuple(r) for r in batch.collect()}
    assert changes.where("username = 'c'").count() == 2


def test_last_values_over_restarts(spark, dirs):
    at = _land(spark, dirs("in"), [("a", "1"), ("b", "2"), ("a", "3")])
    drain(last_values_stream(stream_topic(spark, dirs("in")), dirs("out"), dirs("ck")))
    _land(spark, dirs("in"), [("b", "4")], at)
    drain(last_values_stream(stream_topic(spark, dirs("in")), dirs("out"), dirs("ck")))
    rows = spark.read.parquet(dirs("out")).collect()
    assert {(r.key, r.value, r.offset) for r in rows} == {("a", "3", 2), ("b", "2", 1), ("b", "4", 3)}


def _documents(spark):
    def body(i, genre):
        return json.dumps({"id": i, "title": f"t{i}", "genres": [{"name": genre}], "studios": []})

    rows = [(i, 0, body(i, "Ecchi" if i == 2 else "A")) for i in range(4)]
    schema = "id int, seq long, body string"
    return catalogue(spark.createDataFrame(rows, schema), spark.createDataFrame([], schema))


def _request(i):
    return str(i), json.dumps({"anime_id": i})


def test_index_over_restarts_equals_batch(spark, dirs):
    documents = _documents(spark)
    at = _land(spark, dirs("in"), map(_request, [0, 1, 2, 3]))
    for more in ([1, 1, 9], [2]):
        stream = stream_topic(spark, dirs("in"))
        drain(index_stream(stream, documents, dirs("index"), dirs("ck"), "feed"))
        at = _land(spark, dirs("in"), map(_request, more), at)
    drain(index_stream(stream_topic(spark, dirs("in")), documents, dirs("index"), dirs("ck"), "feed"))
    got = read_index(spark, dirs("index")).collect()
    want = exclude_enriched(enrich_or_pass(read_topic(spark, dirs("in")), documents)).collect()
    assert sorted((r.doc_id, r.value) for r in got) == sorted(
        (f"es-anime-data+0+{r.offset}", r.value) for r in want
    )
    assert len(got) == 6 and {r["index"] for r in got} == {"es-anime-data"}


def test_a_repeated_batch_replaces_itself(spark, dirs):
    _land(spark, dirs("in"), map(_request, range(5)))
    docs = index_rows(read_topic(spark, dirs("in")))
    for batch in (0, 0, 1, 1):
        write_index(docs, dirs("index"), batch)
    rows = read_index(spark, dirs("index"))
    assert rows.count() == 10 and rows.where("batch_id = 1").count() == 5
    assert rows.select("doc_id").distinct().count() == 5


def test_a_repeated_batch_can_shrink_to_nothing(spark, dirs):
    _land(spark, dirs("in"), map(_request, range(5)))
    docs = index_rows(read_topic(spark, dirs("in")))
    write_index(docs, dirs("index"), 0, "t")
    write_index(docs, dirs("index"), 1, "t")
    write_index(docs.where("false"), dirs("index"), 0, "t")
    assert read_index(spark, dirs("index")).where("batch_id = 1 and index = 't'").count() == 5
    assert read_index(spark, dirs("index")).count() == 5


def test_truncating_keeps_the_index(spark, dirs):
    _land(spark, dirs("in"), map(_request, range(5)))
    records = read_topic(spark, dirs("in"))
    for batch in range(2):
        docs = index_rows(records.union(records.withColumn("topic", F.lit("other"))))
        write_index(docs, dirs("index"), batch)
    assert truncate_index(spark, dirs("index"), "t").first() == ("t", True, 10, 0)
    assert truncate_index(spark, dirs("index"), "none").first() == ("none", False, 0, 0)
    assert truncate_index(spark, dirs("index"), "t").first() == ("t", True, 0, 0)
    counts = {r["index"]: r.docs for r in inventory(spark, dirs("index")).collect()}
    assert counts == {"t": 0, "other": 10}
    write_index(index_rows(records), dirs("index"), 7)
    assert {r["index"]: r.docs for r in inventory(spark, dirs("index")).collect()} == {"t": 5, "other": 10}


def test_published_positions_are_unique_and_stable(spark, dirs):
    df = spark.range(100).repartition(4).select(
        F.col("id").cast("string").alias("key"), F.lit("{}").alias("value")
    )
    for batch in (0, 1, 1):
        publish(df, "csv-raw", dirs("topic"), batch)
    rows = read_topic(spark, dirs("topic"))
    assert rows.count() == 200
    assert rows.select("partition", "offset").distinct().count() == 200


def test_each_batch_reports_its_counters(spark, dirs):
    seen = []
    _land(spark, dirs("in"), map(_request, [0, 1, 2, 9]))
    for more in ([], [2, 2]):
        if more:
            _land(spark, dirs("in"), map(_request, more), 4)
        stream = stream_topic(spark, dirs("in"))
        drain(
            index_stream(
                stream, _documents(spark), dirs("index"), dirs("ck"), "feed",
                report=lambda batch, counts: seen.append((batch, counts)),
            )
        )
    names = ["received", "from_primary", "from_fallback", "failed", "filtered_out", "delivered"]
    assert seen == [(0, dict(zip(names, [4, 3, 0, 1, 1, 3]))), (1, dict(zip(names, [2, 2, 0, 0, 2, 0])))]


def test_two_writers_keep_their_documents(spark, dirs):
    documents = _documents(spark)
    for writer, ids in (("one", [0, 1, 3]), ("two", [1, 3])):
        _land(spark, dirs(writer), map(_request, ids))
        stream = stream_topic(spark, dirs(writer))
        drain(index_stream(stream, documents, dirs("index"), dirs("ck-" + writer), writer))
    rows = read_index(spark, dirs("index"))
    assert {r.writer: r["count"] for r in rows.groupBy("writer").count().collect()} == {"one": 3, "two": 2}


def test_a_crash_after_the_sink_leaves_each_document_once(spark, dirs):
    _land(spark, dirs("in"), map(_request, [0, 1, 3, 9]))
    documents = _documents(spark)

    def crash(batch, counts):
        raise RuntimeError("lost after the write")

    stream = lambda report=None: index_stream(
        stream_topic(spark, dirs("in")), documents, dirs("index"), dirs("ck"), "feed", report=report
    )
    with pytest.raises(Exception, match="lost after the write"):
        drain(stream(crash))
    assert read_index(spark, dirs("index")).count() == 4
    drain(stream())
    ids = [r.doc_id for r in read_index(spark, dirs("index")).collect()]
    assert len(ids) == len(set(ids)) == 4


def test_a_record_without_a_position_is_an_error(spark, dirs):
    rows = spark.createDataFrame([("k", "v", "t", None, 1, None)], ENVELOPE)
    with pytest.raises(Exception, match="no position"):
        index_rows(rows).collect()


def test_streamed_topics_have_positions(spark, dirs):
    _land(spark, dirs("in"), map(_message, "aab"))
    records = changelog_stream(with_username(stream_topic(spark, dirs("in")))).select(
        F.col("username").alias("key"), F.col("message_count").cast("string").alias("value")
    )
    drain(write_topic_stream(records, "counts", dirs("out"), dirs("ck")))
    rows = read_topic(spark, dirs("out"))
    assert rows.where("partition is null or offset is null").count() == 0
    assert index_rows(rows).count() == 3


def test_ordered_publishing_keeps_a_key_together(spark, dirs):
    df = spark.range(4000).repartition(5).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, (F.col("id") % 50).cast("string")).alias("key"),
        F.col("id").cast("string").alias("value"),
        F.col("id").alias("offset"),
    )
    publish(df, "t", dirs("topic"), order=["offset"], partitions=4)
    rows = read_topic(spark, dirs("topic")).collect()
    assert len({(r.partition, r.offset) for r in rows}) == len(rows) == 4000
    by_key = {}
    for r in rows:
        by_key.setdefault(r.key, []).append(r)
    for key, mine in by_key.items():
        if key is not None:
            assert len({r.partition for r in mine}) == 1
            values = [int(r.value) for r in sorted(mine, key=lambda r: r.offset)]
            assert values == sorted(values)
    assert len({r.partition for r in by_key[None]}) == 4


def test_last_documents_over_restarts(spark, dirs):
    documents = _documents(spark)
    at = _land(spark, dirs("in"), [("a", _request(1)[1]), ("b", _request(0)[1]), (None, _request(1)[1]), ("a", "bad{")])
    stream = lambda: last_documents_stream(stream_topic(spark, dirs("in")), documents, dirs("out"), dirs("ck"))
    drain(stream())
    _land(spark, dirs("in"), [("a", _request(2)[1]), ("b", _request(77)[1]), ("c", _request(3)[1])], at)
    drain(stream())
    rows = last_values(spark.read.schema(LAST).parquet(dirs("out")))
    want = last_documents(read_topic(spark, dirs("in")), documents)
    assert {tuple(r) for r in rows.collect()} == {tuple(r) for r in want.collect()}
    assert {(r.key, r.offset) for r in rows.collect()} == {("a", 4), ("b", 1), ("c", 6)}


def test_line_files_over_restarts(spark, tmp_path, dirs):
    lines = tmp_path / "lines"
    lines.mkdir()
    documents = _documents(spark)
    for name, text in (("a.csv", "id,t\n0,x\n9,raw\n"), ("b.csv", "\n2,unwanted\n  \n1,y\n")):
        (lines / name).write_text(text)
        stream = raw_lines(spark, str(lines), streaming=True)
        drain(line_index_stream(stream, documents, dirs("index"), dirs("ck"), "lines"))
    values = sorted(r.value for r in read_index(spark, dirs("index")).collect())
    assert len(values) == 3 and '{"anime_id":9,"title":"raw"}' in values


def test_state_settings_are_put_back(spark, dirs):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    with rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name) == before


def test_replayed_topic_keeps_first_positions_and_reads_only_overlapping_folders(spark, tmp_path):
    from rillworks.sinks.manifest import (
        overlapping,
        position_ranges,
        read_folders,
        read_manifest,
        write_index_once,
    )

    def records(first, last, value):
        return spark.range(first, last).select(
            F.lit("k").alias("key"),
            F.concat(F.lit(value), F.col("id").cast("string")).alias("value"),
            F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("topic"),
            (F.col("id") % 3).cast("int").alias("partition"),
            F.col("id").alias("offset"),
        )

    root = str(tmp_path / "index")
    write_index_once(records(0, 100, "old"), root, 0, "first")
    write_index_once(records(100, 200, "old"), root, 1, "first")
    again = records(150, 250, "new")
    asked = position_ranges(again)
    folders = overlapping(read_manifest(spark, root), asked, "second", 0).collect()
    assert {(f["index"], f["writer"], f["batch_id"]) for f in folders} == {("even", "first", 1), ("odd", "first", 1)}
    files = read_folders(spark, root, folders).inputFiles()
    assert files and all("batch_id=1/" in f for f in files)
    write_index_once(again, root, 0, "second")
    want = {(f"{'even' if i % 2 == 0 else 'odd'}+{i % 3}+{i}", f"{'old' if i < 200 else 'new'}{i}") for i in range(250)}
    for _ in range(2):
        got = [(r["doc_id"], r["value"]) for r in read_index(spark, root).select("doc_id", "value").collect()]
        assert len(got) == 250 and set(got) == want
        # Batches that run again leave everything as it was.
        write_index_once(records(100, 200, "old"), root, 1, "first")
        write_index_once(again, root, 0, "second")


def test_note_of_a_lost_batch_does_not_hide_positions(spark, tmp_path):
    from rillworks.sinks.manifest import _home, position_ranges, write_index_once

    root = str(tmp_path / "index")
    rows = spark.range(10).select(
        F.lit("v").alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset")
    )
    # The first writer noted its batch and was lost before it wrote it.
    position_ranges(rows).write.parquet(f"{_home(root)}/writer=lost/batch_id=0")
    write_index_once(rows, root, 0, "second")
    write_index_once(rows, root, 0, "lost")
    assert read_index(spark, root).count() == 10
