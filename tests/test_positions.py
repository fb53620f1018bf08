"""Topics read by offset ranges, and units that a marker makes visible."""

import os

import pytest
from pyspark.sql import functions as F

from rillworks.sinks import committed_units, publish_units, read_units
from rillworks.sources import note_positions, read_lines, read_offsets, read_topic, stream_offsets
from rillworks.sources.offsets import Note, file_ranges, reach
from rillworks.streaming import drain
from rillworks.sinks import write_topic_stream


def topic(spark, path, batch, first, last, parts=3, files=2):
    rows = spark.range(first, last).select(
        F.lit(None).cast("string").alias("key"),
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("value"),
        F.lit("t").alias("topic"),
        (F.col("id") % parts).cast("int").alias("partition"),
        F.col("id").alias("offset"),
        F.timestamp_seconds(F.col("id")).alias("timestamp"),
    )
    rows.repartition(files, "id").write.parquet(f"{path}/batch={batch}")
    note_positions(spark, path, batch)


def test_positions_move_by_shares_and_cut_files():
    notes = [Note("a", "0", 0, 99, 100), Note("b", "0", 50, 149, 100), Note("a", "1", 0, 9, 10)]
    assert reach(notes, {}, None) == {"0": 150, "1": 10}
    some = reach(notes, {}, 105)
    assert 0 < some["0"] < 150 and 0 < some["1"] < 10
    first = file_ranges(notes, {}, some)
    assert {f.file for f in first} == {"a", "b"} or {f.file for f in first} == {"a"}
    rest = file_ranges(notes, some, {"0": 150, "1": 10})
    low = {f.file: f.ranges for f in rest}
    assert low["b"]["0"][0] == max(50, some["0"]) and low["a"]["1"] == (some["1"], 10)
    # No step goes back, and each goes on.
    at = {}
    for _ in range(300):
        after = reach(notes, at, 7)
        if after == at:
            break
        assert all(after[p] >= at.get(p, 0) for p in after)
        at = after
    assert at == {"0": 150, "1": 10}
    assert reach([], {"0": 5}, 1) == {"0": 5}


def test_a_stream_resumes_within_a_file(spark, tmp_path):
    path, out = str(tmp_path / "topic"), str(tmp_path / "out")
    checkpoint, positions = str(tmp_path / "checkpoint"), str(tmp_path / "positions")
    topic(spark, path, 0, 0, 1000, files=1)

    def run():
        source = stream_offsets(spark, path, positions, 300)
        return drain(write_topic_stream(source, "copy", out, checkpoint))

    first = run()
    assert 0 < first <= 300
    seen = {r.offset for r in read_topic(spark, out).collect()}
    # The one file there is was read in part, from its start.
    assert len(seen) == first and max(seen) < 400
    topic(spark, path, 1, 1000, 1100)
    total = first
    while step := run():
        total += step
    offsets = sorted(r.offset for r in read_topic(spark, out).collect())
    assert total == 1100 and offsets == list(range(1100))


def test_a_stopped_batch_is_read_again_with_the_same_bounds(spark, tmp_path):
    path, positions, checkpoint = (str(tmp_path / n) for n in ("topic", "positions", "checkpoint"))
    topic(spark, path, 0, 0, 500)
    seen: list = []

    def fail_once(batch, batch_id):
        seen.append((batch_id, sorted(r.offset for r in batch.collect())))
        if len(seen) == 2:
            raise RuntimeError("lost")

    def run():
        rows = stream_offsets(spark, path, positions, 200).writeStream
        return drain(rows.option("checkpointLocation", checkpoint).foreachBatch(fail_once))

    run()
    with pytest.raises(Exception, match="lost"):
        run()
    while run():
        pass
    assert seen[1] == seen[2] and seen[0][1] and not set(seen[0][1]) & set(seen[1][1])
    assert sorted(o for batch_id, offsets in [seen[0], *seen[2:]] for o in offsets) == list(range(500))


def test_a_range_of_offsets_as_a_batch(spark, tmp_path):
    path = str(tmp_path / "topic")
    topic(spark, path, 0, 0, 300)
    rows = read_offsets(spark, path, {"0": 30, "1": 100, "2": 0}, {"0": 60, "1": 100, "2": 9})
    assert sorted(r.offset for r in rows.collect()) == sorted([*range(30, 60, 3), 2, 5, 8])
    assert read_offsets(spark, path).count() == 300
    assert [f.dataType for f in rows.schema.fields] == [f.dataType for f in read_topic(spark, path).schema.fields]


def test_an_empty_topic_has_no_rows(spark, tmp_path):
    path = str(tmp_path / "topic")
    os.makedirs(path)
    assert read_offsets(spark, path).count() == 0


def units(spark):
    rows = spark.range(400).select(
        F.concat(F.lit("u"), (F.col("id") % 4).cast("string")).alias("unit"),
        F.when(F.col("id") == 6, False).when(F.col("id") == 7, F.lit(None)).otherwise(True).alias("ok"),
        F.col("id").cast("string").alias("value"),
    )
    return rows.repartition(5)


def test_units_with_a_broken_row_stay_invisible(spark, tmp_path):
    path = str(tmp_path)
    publish_units(units(spark), path, "one")
    assert {(r.unit, r.records) for r in committed_units(spark, path).collect()} == {("u0", 100), ("u1", 100)}
    got = read_units(spark, path, "unit string, value string").collect()
    assert sorted(int(r.value) for r in got) == [i for i in range(400) if i % 4 < 2]
    # No file of a unit that was left out stays behind, and a run again replaces the first.
    listed = {f for r in committed_units(spark, path).collect() for f in r.files}
    assert {f"{path}/staged/one/{f}" for f in os.listdir(f"{path}/staged/one")} == listed
    publish_units(units(spark).where("unit = 'u0'"), path, "one")
    assert [r.unit for r in committed_units(spark, path).collect()] == ["u0"]


def test_a_failing_task_leaves_nothing_visible(spark, tmp_path):
    path = str(tmp_path)
    bad = units(spark).withColumn("value", F.when(F.col("value") == "333", F.raise_error(F.lit("broken"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        publish_units(bad, path, "one")
    assert committed_units(spark, path).count() == 0
    assert read_units(spark, path, "unit string, value string").count() == 0
    publish_units(units(spark).where("unit = 'u1'"), path, "two")
    assert read_units(spark, path, "unit string, value string").count() == 100


def test_no_rows_and_null_units(spark, tmp_path):
    path = str(tmp_path)
    publish_units(units(spark).limit(0), path, "none")
    assert committed_units(spark, path).count() == 0
    publish_units(units(spark).withColumn("unit", F.lit(None).cast("string")).where("ok"), path, "null")
    assert [(r.unit, r.records) for r in committed_units(spark, path).collect()] == [("", 398)]


def test_lines_keep_their_place_however_files_are_cut(spark, tmp_path):
    lines = [f"{i},name {i}" for i in range(5000)]
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("\n".join(["id,name", *lines]))
    (tmp_path / "c.csv").write_text("only a header")
    (tmp_path / "d.csv").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "7000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = read_lines(spark, str(tmp_path))
            got = rows.collect()
            assert sorted(r.line for r in got) == sorted(lines * 2)
            by_place = sorted((r.file, r["at"], r.line) for r in got)
            assert [line for _, _, line in by_place] == lines * 2
            assert len({(f, at) for f, at, _ in by_place}) == len(by_place)
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert plan.count("FileScan") == 1 and "Exchange" not in plan
            again = sorted((r.file, r["at"], r.line) for r in read_lines(spark, str(tmp_path)).collect())
            assert again == by_place
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_are_scanned_once_or_twice(spark, tmp_path):
    from rillworks.operators.lines import keep_whole_units, parse_lines
    from rillworks.streaming import drain, line_index_stream
    from rillworks.sinks import read_index
    from rillworks.sources import raw_lines

    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.csv").write_text("id,name\n1,x\n2,y\n3,z\n")
    lines = str(tmp_path / "lines")
    parsed = parse_lines(read_lines(spark, lines))
    assert parsed.where("ok")._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert keep_whole_units(parsed)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    # A batch that runs again gives its documents the same ids.
    documents = spark.createDataFrame(
        [(1, "primary", '{"id":1}', ["X"])], "id int, provider string, document string, genre_names array<string>"
    )
    ids = []
    for run in range(2):
        root = str(tmp_path / f"index{run}")
        stream = raw_lines(spark, lines, streaming=True)
        drain(line_index_stream(stream, documents, root, str(tmp_path / f"checkpoint{run}"), "w"))
        ids.append(sorted((r.doc_id, r.value) for r in read_index(spark, root).collect()))
    assert ids[0] == ids[1] and len({i for i, _ in ids[0]}) == 3
