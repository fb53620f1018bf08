"""Paths that only large tables take, forced on small ones."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillworks.llm import embedding_dedup, jaccard_join, suffix_dedup
from tests.llm.conftest import prose
from tests.llm.test_near_copies import plain_removal


@pytest.mark.parametrize("ranges, hot", [(1, 2), (3, 2), (1 << 17, 2_000)])
def test_texts_of_one_hash_are_told_apart(spark, monkeypatch, ranges, hot):
    monkeypatch.setattr(suffix_dedup, "_short_name", lambda text: (F.length(text) % 5).cast("long"))
    monkeypatch.setattr(suffix_dedup, "RANGE_STRINGS", ranges)
    monkeypatch.setattr(suffix_dedup, "HOT_PLACES", hot)
    draw, passage = random.Random(3), prose(50, 60)
    docs = [(k, prose(k, draw.randint(0, 40)) + passage[: draw.randint(150, 500)] + prose(100 + k, 30)) for k in range(20)]
    docs += [(90, "a" * 199), (91, "a" * 200), (93, None), (94, ""), (95, "xy" * 400), (None, passage), (97, docs[0][1])]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = collections.Counter(
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(rows).collect()
    )
    assert got == collections.Counter((d[0], *w) for d, w in zip(docs, plain_removal([t for _, t in docs])))


def test_vectors_just_above_the_bound_are_linked(spark):
    draw = np.random.default_rng(12)
    pairs, vectors = 150, []
    for k in range(pairs):
        a = draw.normal(size=64)
        a /= np.linalg.norm(a)
        b = draw.normal(size=64)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        cosine = draw.uniform(0.9005, 0.92) if k % 2 else draw.uniform(0.88, 0.8995)
        vectors += [a.tolist(), (cosine * a + np.sqrt(1 - cosine**2) * b).tolist()]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.link_vectors(df).collect()}
    linked = [got[2 * k].n_links for k in range(pairs)]
    assert sum(linked[1::2]) >= 0.98 * (pairs // 2) and not any(linked[0::2])


def test_vectors_travel_little_and_are_hashed_once(spark):
    n, size = 615_384, 64
    tables, turns = embedding_dedup.tables_for(n, size, 0.9)
    body = embedding_dedup._body("<f4", size, tables, turns)
    # Before: 80 buckets of 552 bytes each.
    assert turns >= 2 and tables * (1 + turns) * body.itemsize < 16_000
    x = np.random.default_rng(5).normal(size=(50, size)).astype("<f4")
    rows = [(k, bytes([k] * 16), k + 1, v.tobytes()) for k, v in enumerate(x)]
    classes = spark.createDataFrame(rows, "node long, key binary, copies long, raw binary")
    found = {}
    for r in embedding_dedup._hashed(classes, "<f4", size, tables, turns).collect():
        one = np.frombuffer(r.body, body)[0]
        found[int(one["node"])] = r.buckets
        assert one["copies"] == one["node"] + 1 and (one["raw"] == x[one["node"]]).all()
        assert embedding_dedup.numbers(one["vertices"][None], size).ravel().tolist() == r.buckets
    assert sorted(found) == list(range(50))
    unit = embedding_dedup._unit(x)
    turned = embedding_dedup._turned(unit, 3, 1)
    assert np.allclose(embedding_dedup.rotate(unit, 3, 1), turned, rtol=0, atol=1e-9)
    assert embedding_dedup.buckets(unit, tables, turns).tolist() == [found[k] for k in range(50)]


def test_pairs_at_the_bound_are_settled_in_double_precision():
    draw = np.random.default_rng(8)
    a = embedding_dedup._unit(draw.normal(size=(400, 64)))
    b = draw.normal(size=a.shape)
    b = embedding_dedup._unit(b - (b * a).sum(1, keepdims=True) * a)
    cosine = 0.9 + draw.choice([-1, 1], 400) * draw.uniform(1e-12, 1e-8, 400)
    x = np.concatenate([a, cosine[:, None] * a + np.sqrt(1 - cosine[:, None] ** 2) * b])
    left, right = np.arange(400), np.arange(400, 800)
    i, j = embedding_dedup._near(x, x.astype(np.float32), 0.9, left, right)
    got = set(i[j == i + 400].tolist())
    assert got == set(np.flatnonzero((x[:400] * x[400:]).sum(1) >= 0.9).tolist()) and 100 < len(got) < 300


def test_ids_by_a_shuffle_and_groups_in_blocks_link_the_same(spark, monkeypatch):
    draw, rows = random.Random(14), []
    for k in range(12):
        words = prose(k, 120).split()
        for copy in range(draw.randrange(1, 6)):
            some = list(words)
            for _ in range(draw.choice([0, 0, 1, 2, 6])):
                some[draw.randrange(len(some))] = f"w{draw.randrange(99)}"
            rows.append((len(rows), " ".join(some)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, jaccard_join.link_documents(df).collect()))
    assert len({c for *_, c in want}) < len(rows)
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
    monkeypatch.setattr(jaccard_join, "BLOCK_RUNS", 200)
    assert sorted(map(tuple, jaccard_join.link_documents(df).collect())) == want
