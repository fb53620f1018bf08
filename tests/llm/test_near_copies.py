"""Jaccard join, line de-duplication, suffix arrays and embeddings against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rillworks.llm import embedding_dedup, jaccard_join, queries, suffix_dedup
from rillworks.llm.jaccard_join import all_links, keep_first_of_each, link_documents
from rillworks.llm.line_dedup import drop_repeated_lines
from tests.llm.conftest import prose


def groups(n, linked):
    label = list(range(n))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_tree_links_match_all_pairs():
    draw = random.Random(4)
    sets = []
    for _ in range(30):
        base = draw.sample(range(2000), draw.randint(1, 120))
        for _ in range(draw.randint(1, 6)):
            sets.append(sorted({*base[draw.randint(0, 3) :], *draw.sample(range(5000), draw.randint(0, 8))}))
    at = np.cumsum([0, *map(len, sets)])
    for percent in (80, 90):

        def near(i, j):
            both = len({*sets[i]} & {*sets[j]})
            return 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)

        want = groups(len(sets), near)
        got = all_links(np.concatenate(sets).astype(np.int64), at, percent)
        assert groups(len(sets), lambda i, j: got[i] == got[j]) == want


def test_tree_links_of_chains_match_all_pairs():
    draw = random.Random(12)
    first = set(range(20))
    chains = [[first, first - {18}, first - {18, 15}, first - {19} | {100}]]
    for _ in range(400):
        chain = [set(range(draw.randint(15, 40)))]
        for _ in range(draw.randint(4, 12)):
            near = set(draw.choice(chain))
            for _ in range(draw.randint(1, 2)):
                near ^= {draw.choice([draw.randrange(40), draw.randrange(100, 104)])}
            chain.append(near)
        chains.append(chain)
    for sets in chains:
        at = np.cumsum([0, *map(len, sets)])
        got = all_links(np.concatenate([sorted(s) for s in sets]).astype(np.int64), at, 90)
        want = groups(len(sets), lambda i, j: 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]))
        assert groups(len(sets), lambda i, j: got[i] == got[j]) == want


@pytest.mark.parametrize("block", [jaccard_join.BLOCK_RUNS, 150])
def test_linked_documents_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_RUNS", block)
    draw, texts = random.Random(7), []
    for k in range(12):
        body = prose(k, 70).split()
        for _ in range(draw.randint(1, 5)):
            copy = list(body)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(70)] = "changed" + str(draw.randrange(9))
            texts.append(" ".join(copy))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in link_documents(rows, 3, 80).collect()}
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (t.split() for t in texts)]
    want = groups(len(sets), lambda i, j: 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    assert [got[i].component_id for i in range(len(sets))] == want
    assert [got[i].n_shingles for i in range(len(sets))] == [len(s) for s in sets]


def test_odd_documents_keep_a_component(odd_documents, no_documents):
    got = collections.Counter(tuple(r) for r in link_documents(odd_documents).collect())
    component = {r[0]: r[2] for r in got}
    assert sum(got.values()) == 12
    assert component[1] == component[2] == 1 and component[None] is None
    assert component[5] == 5 and component[3] == 3 and component[4] == 4 and component[8] == 8
    assert component[6] == component[7] == 6
    kept = keep_first_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.select("doc_id").collect())
    assert ids == [(False, k) for k in (1, 3, 4, 5, 6, 8, 9)] + [(True, 0), (True, 0)]
    assert link_documents(no_documents).count() == 0


def plain_line_dedup(docs, least):
    seen, out = {}, {}
    for key, text in sorted(docs):
        lines = text.split("\n")
        filled = [x.encode() for x in (lines[:-1] if lines[-1] == "" else lines)]
        gone = set()
        for a in range(len(filled)):
            size, b = 0, a
            while b < len(filled) and size < least:
                size, b = size + len(filled[b]), b + 1
            if size >= least:
                if tuple(filled[a:b]) in seen:
                    gone |= set(range(a, b))
                else:
                    seen[tuple(filled[a:b])] = key
        out[key] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    return out


def test_repeated_lines_match_a_plain_reading(spark):
    draw = random.Random(9)
    pool = [prose(k, draw.randint(0, 9)) for k in range(14)] + ["", "é", "x" * 80]
    docs = [(k, "\n".join(draw.choice(pool) for _ in range(draw.randint(0, 12)))) for k in range(60)]
    got = {r.doc_id: (r.text, r._removed) for r in drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = plain_line_dedup([d for d in docs if d[1]], 48)
    assert {k: got[k] for k in want} == want


def maximal_common_runs(docs, least):
    texts = {key: [x.encode() for x in text.split("\n")] for key, text in docs}
    filled = {key: x[:-1] if x[-1] == b"" else x for key, x in texts.items()}
    places = [(key, a) for key in sorted(filled) for a in range(len(filled[key]))]
    gone = {key: set() for key in texts}
    for i, (key, a) in enumerate(places):
        for other, b in places[:i]:
            x, y = filled[key][a:], filled[other][b:]
            n = next((k for k, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
            if sum(map(len, x[:n])) >= least:
                gone[key] |= set(range(a, a + n))
    return {k: (b"\n".join(x for i, x in enumerate(t) if i not in gone[k]).decode(), len(gone[k])) for k, t in texts.items()}


def test_repeated_lines_match_maximal_common_runs(spark):
    draw = random.Random(21)
    pool = [prose(k, draw.randint(0, 6)) for k in range(9)] + ["", "", "é", "}", "x" * 80]
    docs = [(k, "\n".join(draw.choice(pool) for _ in range(draw.randint(1, 14)))) for k in range(50)]
    run = "\n".join(["y" * 50, "}", "", "", "end"])
    docs += [(60, run + "\nother"), (61, run + "\nlast"), (62, run), (63, "y" * 50 + "\n}\n\n\n\n" + "z" * 60)]
    docs = [d for d in docs if d[1]]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.text, r._removed) for r in drop_repeated_lines(rows, extend=True).collect()}
    assert got == maximal_common_runs(docs, 48)
    assert got[61] == ("last", 5) and got[62] == ("", 5)


def test_registered_line_dedup_extends_runs(spark, monkeypatch):
    run = "\n".join(["y" * 50, "}", "end"])
    rows = spark.createDataFrame([(1, run + "\na", 1), (2, run + "\nb", 1)], "doc_id long, text string, n_chars long")
    monkeypatch.setattr(queries, "stored", lambda *_: rows)
    got = {r.doc_id: r.n_removed for r in queries.op6_line_dedup(spark, "").collect()}
    assert got == {1: 0, 2: 3}
    kept = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, rows, "").collect()}
    assert kept == {1: run + "\na", 2: "b"}


def test_odd_documents_keep_their_lines(odd_documents, no_documents):
    rows = drop_repeated_lines(odd_documents)
    assert rows.count() == 12
    by_id = {r.doc_id: r for r in rows.collect()}
    assert by_id[2].text == "" and by_id[2]._removed == 1 and by_id[1]._removed == 0
    assert by_id[5]._removed == 0 and by_id[3].text is None and by_id[8].text == " \n\t \n"
    left = drop_repeated_lines(odd_documents, drop_emptied=True)
    assert left.where("doc_id = 2").count() == 0 and left.count() == 11
    assert drop_repeated_lines(no_documents).count() == 0


def plain_removal(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone, last = bytearray(len(b)), 0
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                start = max(i, last)
                gone[start : i + length] = b"\1" * (i + length - start)
                last = i + length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_PLACES, 2])
def test_repeated_bytes_match_a_plain_reading(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_PLACES", hot)
    draw, passage = random.Random(3), prose(50, 60)
    docs = [(k, prose(k, draw.randint(0, 40)) + passage[: draw.randint(150, 500)] + prose(100 + k, 30)) for k in range(25)]
    docs += [(90, "a" * 199), (91, "a" * 200), (92, "b" * 201), (93, None), (94, ""), (95, "xy" * 400), (None, passage)]
    docs += [(96, "é" * 150), (97, docs[0][1]), (97, docs[0][1]), (None, None)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("of", F.lit(1)).repartition(3)
    got = collections.Counter(
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(rows).collect()
    )
    assert got == collections.Counter((d[0], *w) for d, w in zip(docs, plain_removal([t for _, t in docs])))


def test_suffix_array_and_common_prefixes_match_sorting():
    draw = np.random.default_rng(5)
    data = draw.integers(97, 100, 900).astype(np.uint8)
    data[300:500] = data[0:200]
    end = np.repeat([400, 900], [400, 500])
    order, _ = suffix_dedup.suffix_array(data, end, 64)
    cut = [data[i : min(end[i], i + 64)].tobytes() for i in range(900)]
    assert [cut[i] for i in order] == sorted(cut)
    shared = suffix_dedup.common_prefixes(data, end, order, 64)
    for k in range(1, 900):
        a, b = cut[order[k - 1]], cut[order[k]]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == same


def test_no_documents_have_no_repeats(no_documents):
    assert suffix_dedup.remove_repeats(no_documents).count() == 0


@pytest.mark.parametrize("block", [embedding_dedup.BLOCK, 5])
def test_linked_vectors_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    draw = np.random.default_rng(6)
    vectors = []
    for _ in range(40):
        base = draw.normal(size=32)
        vectors += [(base + draw.normal(size=32) * s).tolist() for s in draw.choice([0, 0.05, 0.2, 0.5], draw.integers(1, 9))]
    n = len(vectors)
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [None, 1.0], [1.0, 2.0], [2.0, 4.0]]
    rows = [(k, v, 1, "x") for k, v in enumerate(vectors + odd)] + [(None, vectors[0], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, bucket int, key string")
    got = {r.vec_id: r for r in embedding_dedup.link_vectors(df).collect()}
    x = np.array(vectors) / np.linalg.norm(vectors, axis=1)[:, None]
    near = x @ x.T >= 0.9
    found = sum(got[i].n_links for i in range(n))
    assert found >= 0.98 * (near.sum() - n) and all(got[i].n_links <= near[i].sum() - 1 for i in range(n))
    if found == near.sum() - n:
        assert [got[i].component_id for i in range(n)] == groups(n, lambda i, j: near[i, j])
    for k in range(n, n + 5):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert got[n + 5].n_links == got[n + 6].n_links == 1 and got[n + 6].component_id == n + 5
    assert got[None].n_links == 0 and got[None].component_id is None and got[None].kept is False


def test_no_vectors(spark):
    assert embedding_dedup.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
