"""Streams that wait for late rows, keep named stores, and are counted while they run."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rillworks.operators.attempts import ERROR, SUCCESS, TIMEOUT, choose_provider, resolve_attempts
from rillworks.operators.split import CountMismatch, read_split, split_write
from rillworks.operators.state import last_values
from rillworks.schemas import ENVELOPE
from rillworks.sinks import snapshots
from rillworks.streaming import (
    DeliveryListener,
    append_stream,
    choose_provider_stream,
    delivery_totals,
    drain,
    enrich_late,
    feed_stream,
    last_store_stream,
    last_values_stream,
    read_deliveries,
    read_store,
    resolve_attempts_stream,
    rocksdb_state,
)

LOG = "request string, kind string, at long, deadline timestamp"


class Feed:
    """A folder of files that a stream reads; each run is a restart on one checkpoint."""

    def __init__(self, spark, tmp_path, schema):
        self.spark, self.schema, self.n = spark, schema, 0
        self.path, self.out, self.checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def add(self, rows):
        df = self.spark.createDataFrame(rows, self.schema)
        df.coalesce(1).write.parquet(f"{self.path}/batch={self.n}")
        self.n += 1

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.path)

    def run(self, make):
        result = make(self.stream())
        drain(append_stream(result, self.out, self.checkpoint))
        return [tuple(r) for r in self.spark.read.schema(result.schema).parquet(self.out).collect()]


def at(spark, seconds):
    return spark.sql(f"select timestamp_seconds({seconds})").first()[0]


def test_attempts_out_of_order_resolve_as_in_the_batch(spark, tmp_path):
    draw = random.Random(3)
    log = []
    for request in range(40):
        for position in range(draw.randrange(1, 12)):
            kind = draw.choice([SUCCESS, ERROR, ERROR, ERROR, TIMEOUT])
            log.append((f"r{request}", kind, 100 * request + position, at(spark, 1000 * (request + 1))))
    feed = Feed(spark, tmp_path, LOG)
    arrival = sorted(log, key=lambda r: r[2] + draw.randrange(300))

    def make(rows):
        return resolve_attempts_stream(rows, ["request"], F.col("kind"), "at", F.col("deadline"), "6000 seconds")

    for part in (arrival[: len(log) // 3], arrival[len(log) // 3 : 2 * len(log) // 3], arrival[2 * len(log) // 3 :]):
        feed.add(part)
        got = feed.run(make)
    # The last requests wait for time to go on.
    assert 0 < len(got) < 40
    feed.add([(None, None, None, at(spark, 10**7))])
    got = feed.run(make)
    want = resolve_attempts(spark.createDataFrame(log, LOG), ["request"], F.col("kind"), "at").collect()
    assert sorted(got) == sorted(map(tuple, want)) and len(got) == 40
    # What comes after its request is settled changes nothing.
    feed.add([("r1", SUCCESS, 100, at(spark, 2000))])
    assert sorted(feed.run(make)) == sorted(got)


def test_a_request_with_very_many_attempts_keeps_few(spark, tmp_path):
    feed = Feed(spark, tmp_path, LOG)
    end = at(spark, 5000)
    feed.add([("hot", TIMEOUT, k, end) for k in range(3000)] + [("hot", ERROR, 5000, end)])
    feed.add([("hot", ERROR, 5001, end), ("hot", SUCCESS, 5002, end), ("hot", ERROR, 4000, end), (None, None, 0, at(spark, 10**6))])

    def make(rows):
        return resolve_attempts_stream(rows, ["request"], F.col("kind"), "at", F.col("deadline"), "0 seconds")

    # Errors at 4000, 5000 and 5001 use up the tries before the success at 5002.
    assert feed.run(make) == [("hot", None)]


def state_rows(rows, feed):
    """Rows that the state holds after a run."""
    with rocksdb_state(feed.spark):
        query = append_stream(rows, feed.out, feed.checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_many_requests_share_keys_of_the_state(spark, tmp_path):
    feed = Feed(spark, tmp_path, LOG)
    end = at(spark, 5000)
    feed.add([(f"r{k}", (ERROR, SUCCESS)[k % 2], k, end) for k in range(600)])

    def make(rows):
        return resolve_attempts_stream(rows, ["request"], F.col("kind"), "at", F.col("deadline"), "0 seconds", packs=4)

    # Four keys with a value each, and their timers.
    assert state_rows(make(feed.stream()), feed) <= 40
    feed.add([(None, None, 0, at(spark, 10**6))])
    assert sorted(feed.run(make)) == sorted((f"r{k}", k if k % 2 else None) for k in range(600))


CALLS = "worker long, id long, ts timestamp, kind string"


def test_providers_are_chosen_as_in_the_batch(spark, tmp_path):
    draw = random.Random(4)
    calls = [
        (draw.choice([7, 7, 7, 8, None if k == 1 else 9]), k, at(spark, 100_000 + 10 * k), draw.choice(["ok", "ok", "ok", "timeout"]))
        for k in range(400)
    ]
    calls = [c for c in calls if c[0] is not None]
    feed = Feed(spark, tmp_path, CALLS)
    arrival = sorted(calls, key=lambda c: c[1] + draw.randrange(40))

    def make(rows):
        return choose_provider_stream(rows, ["worker"], "id", F.col("kind") == "timeout", "1000 seconds", 60, shares=3)

    for part in (arrival[:150], arrival[150:300], arrival[300:]):
        feed.add(part)
        feed.run(make)
    feed.add([(None, None, at(spark, 10**7), None)])
    got = feed.run(make)
    batch = choose_provider(
        spark.createDataFrame(calls, CALLS), ["worker"], ["id"], F.col("kind") == "timeout", 60
    )
    want = [tuple(r) for r in batch.select("worker", "id", "provider").collect()]
    assert sorted(got) == sorted(want) and {p for *_, p in got} == {"primary", "fallback"}


def test_many_workers_share_keys_of_the_state(spark, tmp_path):
    feed = Feed(spark, tmp_path, CALLS)
    feed.add([(k // 2, k, at(spark, 1000 + 2 * (k % 2)), "timeout" if k % 4 == 0 else "ok") for k in range(600)])

    def make(rows):
        return choose_provider_stream(rows, ["worker"], "id", F.col("kind") == "timeout", "10 seconds", 60, shares=2, packs=2)

    # Four keys with lists of rows, and their timers.
    assert state_rows(make(feed.stream()), feed) <= 40
    feed.add([(None, None, at(spark, 10**6), None)])
    assert sorted(feed.run(make)) == sorted((k // 2, k, "fallback" if k % 4 == 1 else "primary") for k in range(600))


ANSWERS = "id int, provider string, document string, answered_at timestamp"


def test_answers_before_after_and_too_late(spark, tmp_path):
    asked, came = Feed(spark, tmp_path / "a", ENVELOPE), Feed(spark, tmp_path / "b", ANSWERS)

    def request(number, second, key="k"):
        return (key, json.dumps({"anime_id": number}), "t", 0, number * 10, at(spark, second))

    def run():
        late = enrich_late(asked.stream(), came.stream(), "100 SECOND", "50 SECOND", "500 seconds")
        drain(append_stream(late, asked.out, asked.checkpoint))
        rows = spark.read.schema(late.schema).parquet(asked.out).where("topic = 't'").collect()
        return sorted((r.offset, r.provider, r.value) for r in rows)

    asked.add([request(n, 1000) for n in (1, 2, 3, 4, 5, 7)] + [request(6, 1000, None)])
    came.add([(1, "primary", "one", at(spark, 990)), (6, "primary", "six", at(spark, 1000)), (None, "primary", "x", at(spark, 1000))])
    assert [r[:2] for r in run()] == [(10, "primary")]
    # Answers in a later batch: in time, at the bound, beyond it, long before, and twice.
    asked.add([request(8, 1001)])
    came.add(
        [(2, "fallback", "two", at(spark, 1050)), (3, "primary", "three", at(spark, 1100)), (4, "primary", "four", at(spark, 1101)),
         (5, "primary", "five", at(spark, 949)), (7, "primary", "seven", at(spark, 1010)), (7, "fallback", "other", at(spark, 1010))]
    )
    run()
    asked.add([("k", "{}", "end", 0, 0, at(spark, 10**6))])
    came.add([(-1, "primary", "end", at(spark, 10**6))])
    got = run()
    found = {offset: (provider, value) for offset, provider, value in got}
    assert len(got) == len(found) == 8
    assert found[10] == ("primary", "one") and found[20] == ("fallback", "two") and found[30] == ("primary", "three")
    assert found[70][1] in ("seven", "other")
    assert all(found[o] == ("raw", json.dumps({"anime_id": o // 10})) for o in (40, 50, 60, 80))


def test_late_answers_keep_one_store_per_partition(spark, tmp_path):
    asked, came = Feed(spark, tmp_path / "a", ENVELOPE), Feed(spark, tmp_path / "b", ANSWERS)
    asked.add([("k", json.dumps({"anime_id": 1}), "t", 0, 1, at(spark, 1000))])
    came.add([(1, "primary", "one", at(spark, 1000))])
    late = enrich_late(asked.stream(), came.stream(), "100 SECOND", "50 SECOND", "500 seconds")
    drain(append_stream(late, asked.out, asked.checkpoint))
    stores = {p.name for p in (tmp_path / "a" / "checkpoint" / "state").glob("*/[0-9]*/*") if p.is_dir()}
    assert not any(name.startswith(("left-", "right-")) for name in stores)


ROWS = "key string, value string, offset bigint"


def records(spark, first, last, name):
    return spark.range(first, last).select(
        F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("key"),
        F.concat(F.lit(name), F.col("id").cast("string")).alias("value"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.timestamp_seconds("id").alias("timestamp"),
    )


def test_snapshots_read_one_generation(spark, tmp_path):
    topic, changes, root, checkpoint = (str(tmp_path / n) for n in ("topic", "changes", "snapshots", "checkpoint"))

    def run(first, last):
        records(spark, first, last, "v").write.mode("append").parquet(topic)
        stream = spark.readStream.schema(ENVELOPE).parquet(topic)
        drain(last_values_stream(stream, changes, checkpoint))

    def compact():
        return snapshots.compact(spark, changes, root, ROWS, ["key"], last_values, buckets=4)

    assert snapshots.read_snapshot(spark, root, ROWS).count() == 0
    run(0, 50)
    assert compact()["generation"] == 0 and compact()["generation"] == 0
    run(50, 52)
    # A generation that was lost before its marker appeared counts for nothing.
    spark.range(1).write.parquet(f"{root}/generation=1/bucket=0")
    assert snapshots.current(spark, root)["generation"] == 0
    newest = {r.key: r.offset for r in snapshots.read_newest(spark, changes, root, ROWS, last_values).collect()}
    assert newest["k1"] == 50 and newest["k2"] == 51
    assert compact()["generation"] == 1
    run(52, 90)
    compact()
    held = snapshots.read_snapshot(spark, root, ROWS)
    assert all("generation=2/" in f for f in held.inputFiles())
    assert {r.key: (r.value, r.offset) for r in held.collect()} == {
        f"k{i % 7}": (f"v{i}", i) for i in range(83, 90)
    }
    one = snapshots.look_up(spark, root, ROWS, {"key": "k3"})
    assert [tuple(r) for r in one.collect()] == [("k3", "v87", 87)]
    # The generation before the current one stays for its readers, older ones go.
    assert snapshots._folders(spark, root, "generation") == [1, 2]


def test_a_named_store_is_read_as_a_table(spark, tmp_path):
    topic, out, checkpoint = (str(tmp_path / n) for n in ("topic", "out", "checkpoint"))
    for first, last in ((0, 30), (30, 33)):
        records(spark, first, last, "v").union(
            records(spark, 100, 101, "lost").withColumn("key", F.lit(None).cast("string"))
        ).write.mode("append").parquet(topic)
        stream = spark.readStream.schema(ENVELOPE).parquet(topic)
        changed = last_store_stream(stream, "the-store")
        drain(append_stream(changed, out, checkpoint))
    held = {r.key: (r.value, r.offset) for r in read_store(spark, checkpoint, "the-store").collect()}
    assert held == {f"k{i % 7}": (f"v{i}", i) for i in range(26, 33)}
    first = {r.key: r.offset for r in read_store(spark, checkpoint, "the-store", 0).collect()}
    assert first == {f"k{i % 7}": i for i in range(23, 30)}
    # Only what changed went out.
    assert spark.read.schema(changed.schema).parquet(out).count() == 7 + 3


def test_running_streams_are_counted_once(spark, tmp_path):
    topic, notes, out, checkpoint = (str(tmp_path / n) for n in ("topic", "notes", "out", "checkpoint"))
    documents = spark.createDataFrame(
        [(1, "primary", '{"id":1}', ["X"]), (2, "fallback", '{"id":2}', ["Ecchi"])],
        "id int, provider string, document string, genre_names array<string>",
    )
    assert delivery_totals(read_deliveries(spark, notes)).first().received == 0
    listener = DeliveryListener(spark, notes)
    spark.streams.addListener(listener)
    try:
        for part in range(2):
            rows = [("k", json.dumps({"anime_id": n}), "t", 0, n, None) for n in (1, 1, 2, 3)]
            spark.createDataFrame(rows, ENVELOPE).write.mode("append").parquet(topic)
            stream = spark.readStream.schema(ENVELOPE).parquet(topic)
            with rocksdb_state(spark):
                query = feed_stream(stream, documents, out, checkpoint).trigger(availableNow=True).start()
                query.awaitTermination()
            listener.wait(str(query.runId))
    finally:
        spark.streams.removeListener(listener)
    table = read_deliveries(spark, notes)
    assert table.select("query").distinct().count() == 1 and table.select("run").distinct().count() == 2
    assert delivery_totals(table).first().asDict() == {
        "received": 8, "from_primary": 4, "from_fallback": 2, "failed": 2, "filtered_out": 2, "delivered": 6
    }


def test_one_scan_gives_sound_and_rejected_rows(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "split")
    spark.range(100).select("id", F.when(F.col("id") % 10 < 8, F.col("id") % 10 < 6).alias("ok")).write.parquet(source)
    rows = spark.read.parquet(source)
    assert split_write(rows, F.col("ok"), path) == {"received": 100, "good": 60, "rejected": 40}
    assert read_split(spark, path, rows, "good").count() == 60
    assert read_split(spark, path, rows, "rejected").where("ok").count() == 0
    flagged = rows.withColumn("verdict", F.when(F.col("ok"), "good").otherwise("rejected"))
    assert flagged._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert split_write(rows.limit(0), F.col("ok"), str(tmp_path / "none")) == {"received": 0, "good": 0, "rejected": 0}


def test_counts_that_do_not_add_up_stop_the_job(spark, tmp_path, monkeypatch):
    from rillworks.operators import split

    rows = spark.range(10)
    whole = split.read_split
    monkeypatch.setattr(split, "read_split", lambda *a: whole(*a).where("id > 0"))
    with pytest.raises(CountMismatch):
        split_write(rows, F.col("id") > 4, str(tmp_path / "split"))
