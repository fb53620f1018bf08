"""Small cases with known answers."""

import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rillworks.operators.attempts import choose_provider, resolve_attempts
from rillworks.operators.catalogue import catalogue, normalize_responses
from rillworks.operators.counts import count_changelog, count_messages
from rillworks.operators.enrich import enrich_or_drop, enrich_or_pass, ids_pending, with_lookup_id
from rillworks.operators.genres import exclude_enriched, exclude_genres
from rillworks.operators.lines import keep_whole_units, parse_lines
from rillworks.operators.metrics import delivery_metrics
from rillworks.operators.payloads import (
    apply_policy,
    guarded,
    normalize_payload,
    rejected_payloads,
    with_username,
)
from rillworks.operators.ranking import page_ids, rejected_pages
from rillworks.operators.state import last_documents
from rillworks.sources import read_lines


def _values(spark, docs):
    return spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, value string")


# Lines


@pytest.fixture(scope="module")
def line_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("lines")
    (root / "good.csv").write_text('id,title\n1,x,y\n2,"p, q",z\n+5,t\n007,t\n8,back\\slash\n9,é,\n')
    (root / "bad.csv").write_text("id,title\n10,x\n3,\n 20,only\nzz,t\n4,,x\n,x\n2147483648,x\n")
    (root / "blank.csv").write_text("id,title\n30,x\n\n31,y\n")
    (root / "header.csv").write_text("id,title\n")
    return str(root)


def test_lines_are_read_whole_and_parsed(spark, line_dir):
    rows = parse_lines(read_lines(spark, line_dir)).collect()
    by_line = {r.line: r for r in rows}
    assert len(rows) == 16
    good = {r.line: (r.key, r.anime_id, r.title) for r in rows if r.ok}
    assert good == {
        "1,x,y": ("1", 1, "x"),
        '2,"p, q",z': ("2", 2, '"p'),
        "+5,t": ("+5", 5, "t"),
        "007,t": ("007", 7, "t"),
        "8,back\\slash": ("8", 8, "back\\slash"),
        "9,é,": ("9", 9, "é"),
        "10,x": ("10", 10, "x"),
        "4,,x": ("4", 4, ""),
        "30,x": ("30", 30, "x"),
        "31,y": ("31", 31, "y"),
    }
    assert by_line['2,"p, q",z'].value == '{"anime_id":2,"title":"\\"p"}'


def test_one_bad_or_blank_line_holds_back_its_file(spark, line_dir):
    parsed = parse_lines(read_lines(spark, line_dir))
    whole = keep_whole_units(parsed)
    assert {r.file.rsplit("/", 1)[-1] for r in whole.select("file").collect()} == {"good.csv"}
    assert whole.count() == 6


def test_odd_lines_stay_as_they_are(spark, tmp_path):
    odd = ["1,a", " \t ", "3,ab\x01cd,e", "\x004,nul", "", "5,z  "]
    (tmp_path / "odd.csv").write_text("id,title\n" + "\n".join(odd) + "\n")
    (tmp_path / "blank-header.csv").write_text("\n6,first\n7,second\n")
    (tmp_path / "header.csv").write_text("id,title\n")
    (tmp_path / "empty.csv").write_text("")
    rows = read_lines(spark, str(tmp_path)).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file.rsplit("/", 1)[-1], []).append(r.line)
    assert by_file == {"odd.csv": odd, "blank-header.csv": ["6,first", "7,second"]}
    whole = keep_whole_units(parse_lines(read_lines(spark, str(tmp_path))))
    assert sorted(r.key for r in whole.collect()) == ["6", "7"]


def test_blank_header_of_a_split_file(spark, tmp_path):
    lines = [f"{i},title {i}" for i in range(20_000)]
    (tmp_path / "big.csv").write_text("\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert {r.line for r in read_lines(spark, str(tmp_path)).collect()} == set(lines)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_header_is_dropped_once_from_a_split_file(spark, tmp_path):
    lines = [f"{i},title {i}" for i in range(20_000)]
    (tmp_path / "big.csv").write_text("id,title\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_lines(spark, str(tmp_path))
        assert df.select(F.spark_partition_id()).distinct().count() > 1
        assert {r.line for r in df.collect()} == set(lines)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# Answers


def _docs(spark, provider, bodies, **options):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    rows = normalize_responses(df, provider, **options).orderBy("id").collect()
    return [None if r.doc is None else json.loads(json.dumps(r.doc.asDict(True))) for r in rows]


EMPTY = {"id": 0, "title": "", "rank": 0, "mean": 0.0, "num_episodes": 0, "genres": [], "studios": []}
USUAL = {
    "id": 5, "title": "T", "rank": 3, "mean": 8.5, "num_episodes": 12,
    "genres": [{"id": 1, "name": "A"}, {"id": 2, "name": "B"}], "studios": [{"id": 9, "name": "S"}],
}


def test_primary_answers(spark):
    bodies = [
        json.dumps(USUAL | {"more": {"x": 1}}),
        "{}",
        "",
        "[1]",
        "bad{",
        json.dumps(USUAL | {"title": None, "rank": "7", "mean": "8.25", "genres": None}),
        json.dumps(USUAL | {"genres": [{"id": 1}]}),
        json.dumps(USUAL | {"genres": [{"name": None}]}),
        json.dumps(USUAL | {"studios": ["x"]}),
        json.dumps(USUAL | {"studios": {"a": {"name": "S1"}}, "title": "7up"}),
        json.dumps(USUAL | {"genres": 5}),
    ]
    named = {k: USUAL[k] for k in EMPTY} | {
        "genres": [{"name": "A"}, {"name": "B"}], "studios": [{"name": "S"}],
    }
    assert _docs(spark, "primary", bodies) == [
        named,
        EMPTY,
        EMPTY,
        EMPTY,
        None,
        named | {"title": "null", "rank": 7, "mean": 8.25, "genres": []},
        None,
        named | {"genres": [{"name": "null"}]},
        None,
        named | {"studios": [{"name": "S1"}], "title": "7up"},
        named | {"genres": []},
    ]


def test_fallback_answers(spark):
    data = {"mal_id": 5, "title": "T", "rank": None, "score": 8.5, "episodes": 12}
    lists = {"genres": [{"name": "A"}], "studios": []}
    bodies = [json.dumps({"data": data | lists}), '{"status":404}', '{"data":null}', '{"data":[]}', ""]
    first = {"id": 5, "title": "T", "rank": 0, "mean": 8.5, "num_episodes": 12} | lists
    assert _docs(spark, "fallback", bodies) == [first, None, EMPTY, EMPTY, None]


def test_lists_can_be_required(spark):
    bodies = [json.dumps(USUAL), "{}", '{"genres":[]}', '{"genres":null,"studios":[]}']
    got = _docs(spark, "primary", bodies, require_lists=True)
    assert [d is None for d in got] == [False, True, True, False]


# Enrichment


@pytest.fixture
def documents(spark):
    def body(i, title, genre):
        return {"id": i, "title": title, "genres": [{"name": genre}], "studios": []}

    def second(i, title, genre):
        return json.dumps({"data": {"mal_id": i, "title": title, "genres": [{"name": genre}], "studios": []}})

    primary = [
        (1, 0, json.dumps(body(1, "old", "A"))),
        (1, 1, json.dumps(body(1, "one", "A"))),
        (2, 0, json.dumps(body(2, "two", "Ecchi"))),
        (5, 0, "bad{"),
        (6, 0, json.dumps(body(6, "six", "ecchi"))),
        (0, 0, json.dumps(body(0, "zero", "A"))),
    ]
    fallback = [(1, 0, second(1, "other", "B")), (3, 0, second(3, "three", "C")),
                (4, 0, '{"status":404}'), (5, 0, second(5, "five", "C"))]
    schema = "id int, seq long, body string"
    return catalogue(
        spark.createDataFrame(primary, schema), spark.createDataFrame(fallback, schema)
    )


REQUESTS = [
    ("1", '{"anime_id":1}'), ("2", '{"anime_id":2}'), ("3", '{"anime_id":"3"}'),
    ("4", '{"anime_id":4}'), ("5", '{"anime_id":5}'), ("6", '{"anime_id":6}'),
    ("7", '{"anime_id":7,"genres":[{"name":"Hentai"}]}'), ("8", '{"title":"x"}'), ("9", "bad{"),
    (None, '{"anime_id":1}'), ("11", ""), ("12", '{"anime_id":null}'), ("13", None),
]


def test_passing_through_what_has_no_document(spark, documents):
    requests = spark.createDataFrame(REQUESTS, "key string, value string")
    rows = enrich_or_pass(requests, documents).collect()
    by_key = {r.key: r for r in rows}
    assert len(rows) == len(REQUESTS)
    titles = {k: json.loads(r.value)["title"] for k, r in by_key.items() if r.provider != "raw"}
    assert titles == {"1": "one", "2": "two", "3": "three", "6": "six", "12": "zero"}
    assert by_key["3"].provider == "fallback"
    raw = {k: r.value for k, r in by_key.items() if r.provider == "raw"}
    assert raw == {k: v for k, v in REQUESTS if k in raw}
    kept = {r.key for r in exclude_enriched(enrich_or_pass(requests, documents)).collect()}
    assert kept == {"1", "3", "4", "5", "6", "8", None, "11", "12"}
    again = {r.key for r in exclude_genres(enrich_or_pass(requests, documents)).collect()}
    assert again == kept


def test_dropping_what_has_no_document(spark, documents):
    requests = spark.createDataFrame(REQUESTS, "key string, value string")
    got = enrich_or_drop(requests, documents)
    assert sorted(str(r.key) for r in got.collect()) == ["1", "12", "2", "3", "6", "None"]
    pending = {r.id: r.requests for r in ids_pending(requests, documents).collect()}
    assert pending == {4: 1, 5: 1, 7: 1}


def test_counts_of_what_went_where(spark, documents):
    requests = spark.createDataFrame(REQUESTS, "key string, value string")
    row = delivery_metrics(requests, documents).first().asDict()
    assert row == {
        "received": 13, "from_primary": 4, "from_fallback": 1, "failed": 8,
        "filtered_out": 4, "delivered": 9,
    }


def test_last_document_counts_successes_only(spark, documents):
    rows = [("a", '{"anime_id":1}', 0), ("a", '{"anime_id":2}', 1), ("a", '{"anime_id":4}', 2),
            ("b", '{"anime_id":9}', 3), (None, '{"anime_id":1}', 4)]
    requests = spark.createDataFrame(rows, "key string, value string, offset long")
    got = [(r.key, json.loads(r.value)["title"], r.offset) for r in last_documents(requests, documents).collect()]
    assert got == [("a", "two", 1)]


def test_genres_by_value(spark):
    docs = {
        '{"x":1}': True, '{"genres":null}': True, '{"genres":[]}': True, '{"genres":5}': True,
        '{"genres":[{"name":"A"},{"name":"Erotica"}]}': False, '{"genres":[{"name":"ecchi"}]}': True,
        '{"genres":[{"id":1}]}': False, '{"genres":[{"name":null}]}': True, '{"genres":["Ecchi"]}': False,
        '{"genres":{"a":{"name":"Ecchi"}}}': False, '{"genres":{"a":{"name":"B"}}}': True,
        '{"genres":[{"name":{"Ecchi":1}}]}': True, '{"genres":[null]}': False, "": True, "[1]": True,
        "bad{": False,
    }
    df = _values(spark, list(docs))
    kept = {r.value for r in exclude_genres(df).collect()}
    assert kept == {d for d, keep in docs.items() if keep}
    odd = {r.value for r in exclude_genres(df, ("null", "", "it's", "5")).collect()}
    assert '{"genres":[{"name":null}]}' not in odd and '{"genres":[{"name":{"Ecchi":1}}]}' not in odd
    assert '{"genres":[{"name":"ecchi"}]}' in odd


# Messages


def test_bad_input_by_policy(spark):
    df = _values(spark, ['{"id":1,"username":"a","message":"m"}', "bad{", None])
    assert normalize_payload(df, "skip").count() == 1
    emptied = normalize_payload(df, "empty").orderBy("i").collect()
    assert [(r.id, r.username, r.message) for r in emptied] == [(1, "a", "m"), (0, "", ""), (0, "", "")]
    with pytest.raises(Exception, match="not valid JSON"):
        normalize_payload(df, "fail_job").collect()
    with pytest.raises(ValueError):
        apply_policy(df, F.lit(True), "other", "value")


def test_counts_drop_empty_and_keep_null_names(spark):
    docs = ['{"username":"a"}', '{"username":""}', '{"username":null}', '{"username":"null"}',
            "bad{", "{}", '{"username":5}', '{"username":"5"}', None, ""]
    got = count_messages(with_username(_values(spark, docs))).collect()
    assert {r.username: r.message_count for r in got} == {"a": 1, "null": 2, "5": 2}


def test_changelog_with_one_hot_user_over_many_stretches(spark):
    rng = random.Random(7)
    rows, totals, want = [], defaultdict(int), set()
    for offset in range(0, 6_000, 2):
        name = "hot" if rng.random() < 0.7 else f"u{rng.randrange(40)}"
        totals[name] += 1
        rows.append((name, offset))
        want.add((name, offset, totals[name]))
    df = spark.createDataFrame(rows, "username string, offset long").repartition(5)
    got = count_changelog(df, ("offset",), stretch=64).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_changelog_over_several_partitions(spark):
    rows = [("a", p, o) for p in range(3) for o in range(0, 40, 3)]
    df = spark.createDataFrame(rows, "username string, partition int, offset long")
    got = count_changelog(df, stretch=10).orderBy("partition", "offset").collect()
    assert [r.message_count for r in got] == list(range(1, len(rows) + 1))


# Attempts


def test_attempts_against_replay(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abcdefgh") if i % 3 else "hot", i, rng.choice(["success", "error", "timeout"] if i > 60 else ["error", "timeout"]))
            for i in range(400)]
    want = {}
    for request in {r[0] for r in rows}:
        errors, found = 0, None
        for _, at, kind in sorted(r for r in rows if r[0] == request):
            if kind == "success" and errors < 3:
                found = at
                break
            errors += kind == "error"
        want[request] = found
    df = spark.createDataFrame(rows, "request string, at long, kind string")
    got = resolve_attempts(df, ["request"], F.col("kind"), "at").collect()
    assert {r.request: r.resolved_at for r in got} == want


@pytest.mark.parametrize(
    "kinds,found",
    [("s", 0), ("ees", 2), ("eees", None), ("etetes", None), ("ettttes", 6), ("ttt", None), ("eseees", 1)],
)
def test_tries_run_out_by_errors_only(spark, kinds, found):
    names = {"s": "success", "e": "error", "t": "timeout"}
    df = spark.createDataFrame([("r", i, names[k]) for i, k in enumerate(kinds)], "r string, at long, kind string")
    assert resolve_attempts(df, ["r"], F.col("kind"), "at").collect() == [("r", found)]


def test_provider_against_replay(spark):
    rng = random.Random(11)
    rows, now = [], 0
    for i in range(600):
        now += rng.randrange(0, 40)
        rows.append(("w1" if rng.random() < 0.7 else "w2", i, now, rng.random() < 0.15))
    want, last = {}, {}
    for worker, i, at, timed_out in rows:
        before = last.get(worker)
        want[i] = "fallback" if before is not None and at - before < 60 else "primary"
        if timed_out:
            last[worker] = at
    df = spark.createDataFrame(rows, "worker string, i long, at long, timed_out boolean")
    calls = df.withColumn("ts", F.timestamp_seconds("at"))
    got = choose_provider(calls, ["worker"], ["i"], F.col("timed_out"), stretch=16)
    assert {r.i: r.provider for r in got.collect()} == want


# Ranking


def test_pages_stop_at_their_first_bad_entry(spark):
    pages = [
        '{"data":[{"node":{"id":1}},{"node":{"id":"2"}},{"node":{"id":null}}]}',
        '{"data":[{"node":{"id":3}},{"node":{}},{"node":{"id":4}}]}',
        '{"data":[{},{"node":{"id":5}}]}', '{"x":1}', "bad{", '{"data":[]}', '{"data":null}', "",
    ]
    df = _values(spark, pages)
    got = page_ids(df).orderBy("i", "place").collect()
    assert [(r.i, r.place, r.id) for r in got] == [(0, 0, "1"), (0, 1, "2"), (0, 2, "0"), (1, 0, "3")]
    assert sorted(r.i for r in rejected_pages(df).collect()) == [1, 2, 3, 4, 7]


def test_lookup_ids(spark):
    df = _values(spark, ['{"anime_id":1}', '{"anime_id":"x"}', "{}", "bad{", '{"anime_id":2.5}'])
    got = with_lookup_id(df).orderBy("i").collect()
    assert [r.lookup_id for r in got] == [1, 0, None, None, 2]


def test_a_record_is_good_or_rejected_whatever_the_session(spark):
    values = [
        '{"username":{"a":1,"a":2}}', '{"a":1,"a":2}', '[{"x":1,"x":2}]', "[1]", "5", '"t"', "", " ",
        '{"id":1} trailing', "bad{", "{", None, '{"id":01}', "[1", '{"a":{"b":}}', "nul", "null", "true",
    ]
    df = _values(spark, values)
    seen = []
    name = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(name)
    for setting in ("true", "false"):
        spark.conf.set(name, setting)
        try:
            good = {r.i for r in normalize_payload(df, "skip").collect()}
            bad = {r.i for r in rejected_payloads(df).collect()}
        finally:
            spark.conf.set(name, before)
        assert good | bad == set(range(len(values))) and not good & bad
        seen.append(bad)
    assert seen[0] == seen[1] == {values.index(v) for v in ("bad{", "{", None, "[1", '{"a":{"b":}}', "nul", '{"id":01}')}
    assert {r.i for r in guarded(df).collect()} == set(range(len(values))) - seen[0]


def test_requests_without_a_lookup_are_spread(spark):
    requests = spark.range(40_000).select(
        F.col("id").cast("string").alias("key"),
        F.when(F.col("id") % 5 == 0, F.concat(F.lit('{"anime_id":'), "id", F.lit("}"))).otherwise(F.concat(F.lit("bad "), "id")).alias("value"),
    )
    documents = spark.createDataFrame([(5, "primary", "{}", ["A"])], "id int, provider string, document string, genre_names array<string>")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        placed = enrich_or_pass(requests, documents).withColumn("task", F.spark_partition_id())
        tasks = [r["count"] for r in placed.groupBy("task").count().collect()]
        found = placed.where("provider <> 'raw'").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(tasks) == 40_000 and found == 1 and max(tasks) < 8_000
