"""Whole texts as bytes: words, runs of words, connected components."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from rillworks.llm.land import components
from rillworks.llm.text import shingles, slices, words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@settings(deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \n\t\x0b\xa0", max_size=12)), max_size=8), st.integers(1, 9))
def test_words_and_runs_match_a_plain_reading(texts, limit):
    seen, runs = [], []
    for part in slices(pa.array(texts, pa.string()), limit):
        found = words(part)
        seen += [(part.first + r, bytes(part.data[a:b])) for a, b, r in zip(found.start, found.end, found.text)]
        hashes, row = shingles(found, len(part.at) - 1, 3)
        runs += [(part.first + r, int(h)) for h, r in zip(hashes, row)]
    want, want_runs = [], []
    for i, text in enumerate(texts):
        found = WORD.findall((text or "").encode())
        want += [(i, w) for w in found]
        low = [w.lower() for w in found]
        spans = [tuple(low[k : k + 3]) for k in range(len(low) - 2)] if len(low) >= 3 else [tuple(low)] if low else []
        want_runs += [(i, s) for s in spans]
    assert seen == want
    assert [r for r, _ in runs] == [r for r, _ in want_runs]
    names = {}
    for (_, h), (_, s) in zip(runs, want_runs):
        assert names.setdefault(s, h) == h
    assert len(set(names.values())) == len(names)


def test_sliced_columns_keep_their_rows():
    column = pa.array(["a b", "c", None, "d e f"])
    parts = list(slices(column.slice(1, 3), 1))
    assert sum(len(p.at) - 1 for p in parts) == 3
    assert b"".join(p.data.tobytes() for p in parts) == b"cd e f"


def test_components_of_a_path_a_star_and_odd_links(spark):
    path = [(k, k + 1) for k in range(100, 130)]
    star = [(k, 5) for k in range(6, 20)]
    links = path + star + [(1, 1), (None, 2), (40, 41), (41, 40)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {got[k] for k in range(100, 131)} == {100}
    assert {got[k] for k in range(5, 20)} == {5}
    assert got[41] == got[40] == 40
    assert set(got) == {*range(100, 131), *range(5, 20), 40, 41}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_text_has_no_words():
    for part in slices(pa.array([None, "", None], pa.string())):
        assert len(words(part).hash) == 0
        assert len(shingles(words(part), 3, 5)[0]) == 0
    assert list(slices(pa.array([], pa.string()))) == []
    assert np.size(words(next(slices(pa.array(["  "])))).hash) == 0
