"""Leaks in every place, lines in any number, and columns of any name."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from rillworks.llm import decontamination
from rillworks.llm.decontamination import _FOLD, banded_distance, budget, build_index, clean_documents, leaks, text_leaks
from rillworks.llm.line_dedup import count_columns, drop_repeated_lines
from rillworks.llm.secrets import scan
from rillworks.llm.text import slices
from tests.llm.conftest import prose


def plain_leak(text, item):
    """Any window of the item within its budget of any stretch, by trying all."""
    t, x = (_FOLD[np.frombuffer(s.encode(), np.uint8)] for s in (text, item))
    size = min(len(x), decontamination.WINDOW)
    return any(banded_distance(x[s : s + size], t, budget(size)) <= budget(size) for s in range(len(x) - size + 1))


def changed(draw, text, edits):
    out = list(text)
    for _ in range(edits):
        i, kind = draw.randrange(len(out)), draw.random()
        out[i : i + (kind > 0.3)] = [] if kind > 0.6 else ["q"]
    return "".join(out)


@pytest.mark.parametrize("pairs", [1 << 20, 60])
def test_windows_from_any_start_are_found(monkeypatch, pairs):
    monkeypatch.setattr(decontamination, "PAIRS", pairs)
    draw = random.Random(8)
    items = [prose(500 + k, draw.choice([14, 16, 25, 40])) for k in range(20)]
    seen = []
    for _ in range(60):
        item = draw.choice(items)
        at = draw.randrange(max(1, len(item) - 95))
        part = changed(draw, item[at : at + draw.choice([70, 96, 97, 120, 143, 200])], draw.choice([0, 0, 4, 8, 9, 10, 14]))
        text = f"{prose(draw.randrange(400), 15)} {part} {prose(draw.randrange(400), 15)}"
        index = build_index([7, 8], [item, items[0]])
        got = any(i == 7 for some in slices(pa.array([prose(1, 4), None, text])) for _, i, *_ in text_leaks(some, index, True))
        seen.append(got)
        assert got == plain_leak(text, item)
    assert 10 < sum(seen) < 55


def test_repeated_grams_are_counted_in_bounded_parts():
    import resource

    index = build_index([1, 2], ["a" * 4000, prose(3, 40)])
    before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.perf_counter()
    for some in slices(pa.array(["a" * 12_000, " " * 12_000, ("a" * 30 + " ") * 400])):
        # A blank in every thirty bytes is within the budget.
        assert {r for r, *_ in text_leaks(some, index, True)} == {0, 2}
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000
    assert time.perf_counter() - start < 60


def test_short_items_must_be_whole(spark):
    rows = [(1, "The answer is 42"), (2, "yes"), (3, "who wrote it?"), (4, ""), (5, "   "), (6, "x" * 63)]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    texts = ["so the ANSWER\tis 42.", "the answer is 421", "yes", " YES\n", "yes no", "oh, who wrote it? me", "who wrote its", "y" + "x" * 63, "y " + "x" * 63]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.item_id): (r.start, r.length) for r in leaks(docs, benchmark).collect()}
    assert found == {(0, 1): (3, 16), (2, 2): (0, 3), (3, 2): (1, 3), (5, 3): (4, 13), (8, 6): (2, 63)}
    assert {r.doc_id for r in clean_documents(docs, benchmark).collect()} == {1, 4, 6, 7}


def test_a_benchmark_in_several_blocks(spark, monkeypatch):
    items = [(k, prose(900 + k, 20)) for k in range(12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(k, f"{prose(k, 30)} {items[k][1] if k < 12 else ''}") for k in range(20)], "doc_id long, text string")
    whole = sorted(map(tuple, leaks(docs, benchmark).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 600)
    assert sorted(map(tuple, leaks(docs, benchmark).collect())) == whole and {r[:2] for r in whole} == {(k, k) for k in range(12)}
    assert {r.doc_id for r in clean_documents(docs, benchmark).collect()} == set(range(12, 20))


def test_columns_of_any_name_survive(spark):
    names = ["_id", "_of", "_gone", "_lines", "_removed", "id", "of", "runs", "key", "row", "asked", "lines", "text2"]
    part = "\n".join(prose(k, 6) for k in range(4))
    rows = [(k, f"{prose(50 + k, 9)}\n{part}", *[f"{n}{k}" for n in names]) for k in range(3)]
    df = spark.createDataFrame(rows, ["doc_id", "text", *names])
    kept = drop_repeated_lines(df, drop_emptied=True, extend=True)
    assert count_columns(df.columns) == ("__lines", "__removed")
    assert kept.columns == [*df.columns, "__lines", "__removed"]
    got = {r.doc_id: r for r in kept.collect()}
    assert [got[k]["__removed"] for k in range(3)] == [0, 4, 4] and got[2]["__lines"] == 5
    assert all(got[k][n] == f"{n}{k}" for k in range(3) for n in names)
    docs = df.withColumns({"lang": df["key"], "source": df["key"], "n_chars": df["doc_id"]})
    assert corpus_pipeline.line_dedup(spark, docs, "").columns == docs.columns
    assert clean_documents(df, spark.createDataFrame([(1, "z" * 99)], "item_id long, text string")).columns == df.columns


def test_very_many_blank_lines_stay_quick(spark):
    blank = "\n" * 100_000
    long = "a line of more than forty-eight bytes, to be sure of it"
    rows = [(1, blank), (2, blank + "end"), (3, long + blank), (4, "u" + blank + long[::-1]), (5, "v" + blank + long[::-1])]
    start = time.perf_counter()
    got = {r.doc_id: r for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), extend=True).collect()}
    assert time.perf_counter() - start < 40
    # Blank lines fill no window, so none is a run of 48 bytes.
    assert [got[k]["_removed"] for k in (1, 2, 3)] == [0, 0, 0] and got[1].text == blank
    # Before a long line they are windows of it, each from its own start.
    assert got[4]["_removed"] == 0 and got[5]["_removed"] == 100_000 and got[5].text == "v"


def test_long_runs_of_short_and_blank_lines_go_as_one(spark):
    body = "\n".join(["x" * 60] + [""] * 3000 + [str(k) for k in range(3000)] + ["z" * 60])
    rows = [(1, "first\n" + body), (2, "second\n" + body + "\nlast")]
    got = {r.doc_id: r for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), extend=True).collect()}
    assert got[1]["_removed"] == 0 and got[2]["_removed"] == 6002 and got[2].text == "second\nlast"


def test_many_repositories_make_a_value_common(spark):
    token = "Zx81Qw7Lk29Pm4Vt6Ry3"
    rows = [(k, f"see {token} there", "one-owner", f"lang{k}") for k in range(5)]
    names = "doc_id long, text string, source string, lang string"
    got = scan(spark.createDataFrame(rows, names)).collect()
    assert all(r.spans == "" and r.n_widely_copied == 0 and r.most_repositories == 0 for r in got)
    few = scan(spark.createDataFrame(rows[:4], names)).collect()
    assert all(r.spans == "bare:4:24" and r.most_repositories == 4 and r.n_owner_specific == 1 for r in few)
    base = [(k, f"password={token}", "one-owner", f"lang{k}") for k in range(5)]
    assert all(r.n_widely_copied == 1 and r.most_repositories == 5 for r in scan(spark.createDataFrame(base, names)).collect())
    bare = spark.createDataFrame([(1, f"see {token}")], "doc_id long, text string")
    assert [r.spans for r in scan(bare).collect()] == ["bare:4:24"]
