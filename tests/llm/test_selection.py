"""Quality, benchmark leaks, secrets, token counts, packing, language model, pipeline."""

import hashlib
import math
import pickle
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from rillworks.llm import mixing_lm, quality
from rillworks.llm.decontamination import banded_distance, clean_documents, leaks
from rillworks.llm.packing import best_fit_decreasing, lower_bound, pack_documents
from rillworks.llm.queries import ORACLES, QUERIES
from rillworks.llm.secrets import scan
from rillworks.llm.token_counts import at_limits, length_histogram, limits_report
from rillworks.llm.tokens import rank_length
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def test_thresholds_are_ordered_and_grades_found_again(spark):
    draw, rows, ratings = random.Random(2), [], []
    for k in range(1200):
        words = prose(k, 40).split()
        grade = k % 3
        if grade == 1:
            words[draw.randrange(40)] = "awful"
        if grade == 0:
            words = [w + "!!" for w in words]
        rows.append((k, " ".join(words)))
        ratings.append((k, grade))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rated = spark.createDataFrame([r for r in ratings if r[0] < 900], "doc_id long, grade int")
    model = quality.fit(docs, rated)
    assert model.grades == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    new = [(got[k], g) for k, g in ratings if k >= 900]
    assert np.mean([(r.top_probability >= 0.5) == (g == 2) for r, g in new]) >= 0.9
    assert np.mean([r.expected_grade for r, g in new if g == 0]) < np.mean([r.expected_grade for r, g in new if g == 2]) - 1


def test_odd_documents_are_scored_and_unrated_tables_select_all(spark, odd_documents, no_documents):
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = quality.fit(odd_documents, none)
    assert quality.select_documents(odd_documents, model).count() == 12
    rated = spark.createDataFrame([(1, 2), (1, 0), (9, 2), (None, 1), (7, None)], "doc_id long, grade int")
    model = quality.fit(odd_documents, rated)
    assert model.grades == [0, 2] and quality.score(odd_documents, model).count() == 12
    assert quality.select_documents(odd_documents, model).columns == odd_documents.columns
    assert quality.score(no_documents, model).count() == 0


def test_grades_of_labels(spark):
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 1), (3, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    assert [r.grade for r in quality.grades_of_labels(labels).orderBy("doc_id").collect()] == [0, 1, 2, 2]


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_banded_distance_matches_the_plain_one():
    draw = np.random.default_rng(3)
    for _ in range(40):
        text = draw.integers(97, 101, 40).astype(np.uint8)
        pattern = np.delete(text[5:30], draw.integers(0, 25, 3))
        want = plain_distance(pattern.tolist(), text.tolist())
        assert banded_distance(pattern, text, 40) == want
        assert banded_distance(pattern, text, 1) == min(want, 2)


def test_leaks_are_found_with_edits_and_clean_texts_stay(spark, odd_documents, no_documents):
    items = [(k, prose(1000 + k, 20)) for k in range(8)] + [(20, None), (None, "x" * 99), (21, "short")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    edited = items[1][1][:30] + "Z" + items[1][1][31:90] + items[1][1][91:]
    docs = [(0, prose(1, 50) + " " + items[0][1] + prose(2, 20)), (1, edited), (2, prose(3, 400)), (3, items[2][1].upper().replace(" ", "\n"))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r.edits for r in leaks(df, benchmark).collect()}
    assert set(found) == {(0, 0), (1, 1), (3, 2)} and found[0, 0] == found[3, 2] == 0
    assert [r.doc_id for r in clean_documents(df, benchmark).collect()] == [2]
    assert clean_documents(odd_documents, benchmark).count() == 12
    assert clean_documents(no_documents, benchmark).count() == leaks(no_documents, benchmark).count() == 0
    assert clean_documents(df, benchmark.where("item_id < 0")).count() == 4


ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = (("assign", ASSIGN, 8), ("access", re.compile("AKIA[A-Z0-9]+"), 16), ("hex", re.compile("[0-9a-f]+"), 32))


def base_spans(text):
    out = []
    for order, (kind, pattern, least) in enumerate(KINDS):
        for m in pattern.finditer(text or ""):
            if len(m[1] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def test_spans_match_a_plain_reading_and_owners_part_values(spark, odd_documents, no_documents):
    live, copied = "Zx81Qw7Lk29Pm4Vt6Ry3", "EXAMPLEKEY0123456789abc"
    texts = [
        "é password=short token=secret: xyz12345 " + "a1" * 20,
        'API_KEY : "abcdefgh" AKIA1234567890AB AKIAx AKIA12',
        f"use {live} here",
        *(f"see {copied} there" for _ in range(4)),
        "passwordpassword='12345678'=" + "0" * 31 + " " + "0" * 32,
        None,
    ]
    rows = [(k, t, f"s{k}", "en") for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()}
    for k, text in enumerate(texts):
        want = base_spans(text)
        assert got[k].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert Counter(s.split(":")[0] for s in want) == +Counter(assign=got[k].n_assign, access=got[k].n_access, hex=got[k].n_hex)
        assert set(want) <= {*got[k].spans.split(","), ""}
    assert got[2].spans == f"bare:4:{4 + len(live)}" and got[3].spans == ""
    assert scan(odd_documents).count() == 12 and scan(no_documents).count() == 0


def test_secrets_run_without_python(spark):
    plan = QUERIES["op8_secrets"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_limits_match_a_plain_count(spark, odd_documents, no_documents):
    report = limits_report(length_histogram(odd_documents, "byte_bpe_50k.tiktoken", "source"))
    length = rank_length("byte_bpe_50k.tiktoken")
    rows = [(r.source, length(r.text or "")) for r in odd_documents.collect()]
    for r in report.collect():
        mine = [n for s, n in rows if r.scope == "all" or s == r.name]
        limit = r.context_limit
        assert r.n_docs == mine.count(limit) and r.total_tokens == sum(mine)
        assert r.docs_reaching == sum(n >= limit for n in mine) and r.tokens_reaching == sum(n for n in mine if n >= limit)
        assert r.truncated_total == sum(min(n, limit) for n in mine)
        assert r.docs_within == sum(n <= limit for n in mine) and math.isclose(r.quantile, r.docs_within / len(mine))
    asked = spark.createDataFrame([(0,), (17,), (10**6,)], "context_limit long")
    for r in at_limits(report, asked).where("scope = 'all'").collect():
        assert r.truncated_total == sum(min(n, r.context_limit) for _, n in rows)
    assert limits_report(length_histogram(no_documents, "byte_bpe_50k.tiktoken", "source")).count() == 0


@pytest.mark.parametrize("text", ["", " ", "a  b\n c", "it's\t\tfine  ", "  x", "é ü \x85 z", "<|endoftext|> a"])
def test_lengths_of_pieces_are_those_of_the_text(text):
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert rank_length("byte_bpe_50k.tiktoken")(text) == len(plain.encode_ordinary(text))


def test_packed_pieces_are_whole_and_gapless(spark, odd_documents, no_documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    got = pack_documents(odd_documents, capacity=64).toPandas()
    want = Counter()
    for r in odd_documents.collect():
        ids = [*encode.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), 64)):
            part = ids[a : a + 64]
            want[r.doc_id, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    rows = zip(got.doc_id.astype(object).where(got.doc_id.notna(), None), got.piece, got.start, got.length, got.ids_crc32)
    assert Counter((d if d is None else int(d), *x) for d, *x in rows) == want
    for _, pieces in got.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        assert (pieces.offset.to_numpy() == np.cumsum([0, *pieces.length])[:-1]).all() and pieces.length.sum() <= 64
    assert pack_documents(no_documents).count() == 0


def test_bounds_never_exceed_packings():
    draw = np.random.default_rng(1)
    for _ in range(60):
        sizes = np.sort(draw.integers(1, 101, draw.integers(1, 60)))[::-1]
        bins, offsets, left = best_fit_decreasing(sizes, 100)
        filled = np.bincount(bins, sizes)
        assert filled.max() <= 100 and (100 - filled == left).all()
        assert -(-sizes.sum() // 100) <= lower_bound(sizes, 100) <= len(left)
    assert lower_bound(np.array([51, 51, 51]), 100) == 3 and lower_bound(np.array([], int), 100) == 0


def test_language_model_counts_and_beats_the_share_of_words(spark, no_documents):
    docs = [(k, prose(k, 300).upper() if k % 7 == 0 else prose(k, 300)[:: 1 - 2 * (k % 2)], "ed"[k % 2], "s", 1) for k in range(80)]
    docs += [(200, None, None, None, None), (201, "", "en", "s", 0), (None, "new words", "en", "s", 2), (None, None, "xx", "s", 2)]
    df = spark.createDataFrame(docs, no_documents.schema)
    got = mixing_lm.score_documents(df).collect()
    words = [(d, (t or "").lower().split(), mixing_lm.is_held_out(d)) for d, t, *_ in docs]
    count = Counter(w for _, ws, held in words if not held for w in ws)
    ends = sum(not held for *_, held in words)
    total, kinds = sum(count.values()) + ends, len(count) + 1
    base = lambda c: math.log10((c + 0.5) / (total + 0.5 * (kinds + 1)))
    want = Counter()
    for d, ws, held in words:
        want[d, held, len(ws) + 1, sum(w in count for w in ws) + 1, total, round(sum(base(count[w]) for w in ws) + base(ends), 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    held = [r for r in got if r.held_out and r.n_tokens > 9]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert mixing_lm.score_documents(no_documents).count() == 0


def test_language_model_learns_from_every_training_word(spark):
    def learned(rows, parts):
        schema = "word binary, n0 long, n1 long, n2 long, n3 long, c long"
        words = spark.createDataFrame([(w.encode(), n, 0, 0, 0, n) for w, n in rows], schema).repartition(parts)
        return mixing_lm.learn(*mixing_lm.count_tables(words), words, np.array([sum(n for _, n in rows), 0, 0, 0], float))

    rows = [(w, 1 + len(w) % 3) for w in {w.lower() for k in range(40) for w in prose(k, 60)}]
    one, other = learned(rows, 2), learned([*rows, ("unheld", 0)], 5)
    # Words of no training document change nothing, and neither does how words are dealt.
    assert np.allclose(one.weights, other.weights) and np.allclose(one.refine, other.refine) and np.allclose(one.share, other.share)
    # Single precision would round this count.
    common = learned([("the", (1 << 24) + 2)], 1)
    assert all(np.isfinite(x).all() for x in (common.weights, common.refine, common.share))
    more = learned([*rows, ("zzyzx", 1)], 3)
    assert not np.allclose(one.weights, more.weights) and not np.allclose(one.refine, more.refine)


def test_language_model_tables_travel_small(spark, monkeypatch):
    sent, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(
        type(spark.sparkContext), "broadcast", lambda self, value: sent.append(len(pickle.dumps(value))) or broadcast(self, value)
    )
    docs = spark.createDataFrame([(k, prose(k, 200)) for k in range(40)], "doc_id long, text string")
    assert mixing_lm.score_documents(docs).count() == 40
    # Every executor and the driver keep each of them as a file.
    assert sent and sum(sent) < 4_000_000


def test_language_model_tables_keep_counts_and_leave_one_out():
    draw = np.random.default_rng(3)
    met = [np.append(draw.integers(0, 30, (1 << b) - 2), [0, 2**53 - 1]).astype(float) for b in mixing_lm.TABLE_BITS]
    ones = [np.floor(m * draw.random(len(m))) for m in met]
    tables = pickle.loads(pickle.dumps(mixing_lm.Tables(met, ones)))
    for k, (m, o) in enumerate(zip(met, ones)):
        assert (tables.whole[0][k] == mixing_lm.log_odds(m, o).astype(np.float32)).all()
        assert (tables.whole[1][k] == mixing_lm.evidence(m)).all()
        assert (tables.but_one[1][k] == mixing_lm.evidence(np.maximum(m - 1, 0))).all()
        for value, seen in ((0, m - o > 0), (1, o > 0)):
            want = mixing_lm.log_odds(m - 1, o - value)[seen]
            assert (tables.but_one[0][k][value::2][seen] == want).all()


def test_words_coded_together_equal_each_alone():
    draw = random.Random(8)
    words = ["".join(draw.choice("aab\x00é") for _ in range(draw.randrange(1, 12))).encode() for _ in range(600)] + [b"", b"a" * 900]
    column, each = pa.array(words, pa.binary()), np.arange(1.0, 603.0)
    s, plain = mixing_lm.cells(column), mixing_lm.spell(column)
    assert len(s.byte) < len(s.of) == len(plain.byte)
    assert (s.byte[s.of] == plain.byte).all() and all((c[s.of] == p).all() for c, p in zip(s.contexts, plain.contexts))
    want = Counter()
    for context, byte, word in zip(plain.contexts[-1], plain.byte, plain.word):
        want[int(context), int(byte)] += each[word]
    assert Counter({(int(c), int(b)): n for c, b, n in zip(s.contexts[-1], s.byte, s.counted(each))}) == want
    sizes = np.array([len(w) + 1 for w in words])
    assert (s.by_word(np.ones(len(s.byte)), len(words)) == sizes).all()
    batches = [pa.RecordBatch.from_arrays([column.slice(a, 50)], ["word"]) for a in range(0, len(column), 50)]
    assert sum((b.column(0).to_pylist() for b in mixing_lm._joined(iter(batches))), []) == words


def test_language_model_learns_each_distinct_cell_once(spark):
    draw = random.Random(5)
    words = sorted({"".join(draw.choice("ab\x00é") for _ in range(draw.randrange(1, 12))).encode() for _ in range(500)})
    counts = [draw.choice([0, 1, 3, 250, (1 << 31) + 1]) for _ in words]
    df = spark.createDataFrame(list(zip(map(bytearray, words), counts)), "word binary, c long").repartition(4)
    found = mixing_lm.distinct_cells(df).collect()
    every, least = Counter(), Counter()
    for word, count in zip(words, counts):
        for k, byte in enumerate(word + b" " if count else b""):
            cell = min(k, 7), word[max(k - 6, 0) : k], byte
            every[cell] += count
            least[cell] += min(count, 100)
    assert sorted((r.c, r.least) for r in found) == sorted((n, least[cell]) for cell, n in every.items())
    byte, contexts = mixing_lm._unkeyed(np.array([r.cell for r in found], np.int64).view(np.uint64))
    s = mixing_lm.spell(pa.array([w for w, c in zip(words, counts) if c], pa.binary()))
    assert set(zip(byte, *contexts)) == set(zip(s.byte, *s.contexts))


def _plain_cells(words):
    """How many bytes of a text are before each (seven: or more), up to six of them, and the byte."""
    raw = "".join(w + " " for w in words).lower().encode()
    return [(min(k, 7), raw[max(k - 6, 0) : k], b) for k, b in enumerate(raw)]


def _cell(key):
    key = int(key)
    depth = key >> 56
    return depth, bytes(key >> 8 * k & 255 for k in range(min(depth, 6), 0, -1)), key & 255


@pytest.mark.parametrize("met", [mixing_lm.MET_BYTES, 40])
def test_language_model_counts_cells_across_words(spark, monkeypatch, met):
    monkeypatch.setattr(mixing_lm, "MET_BYTES", met)
    draw = random.Random(21)
    texts = [" ".join(draw.choice(["a", "bc", "the", "Zwölf", "longer-word", "x" * 50]) for _ in range(draw.randrange(30))) for _ in range(40)]
    docs = [(k, t, k % 4) for k, t in enumerate([*texts, None, "", " \n "])]
    want = Counter()
    for k, text, _ in docs:
        if not mixing_lm.is_held_out(k):
            want.update(_plain_cells((text or "").split()))
    df = spark.createDataFrame(docs, "id long, text string, kind int").repartition(3)
    found = mixing_lm.text_cells(mixing_lm.text_chunks(df, 5)).collect()
    assert len(found) == len(want) and {_cell(np.int64(r.cell).view(np.uint64)): r.c for r in found} == want
    # And a long text in pieces as whole.
    words = [w.encode() for w in ("ab", "c", "defghijk", "l")]
    size, raw = np.array([len(w) for w in words]), np.frombuffer(b"".join(words), np.uint8)
    place = np.array([draw.randrange(4) for _ in range(200)])
    pieces = list(mixing_lm.streams(place, np.array([200]), size, raw))
    assert len(pieces) > 1 or met > 40
    plain = _plain_cells([words[k].decode() for k in place])
    assert [_cell(key) for s in pieces for key in s.key] == plain and sum(len(s.token) for s in pieces) == 200


def test_language_model_reads_texts_in_order(spark):
    held = [k for k in range(1000, 3000) if mixing_lm.is_held_out(k)][:2]
    draw, rows = random.Random(4), []
    for k in range(120):
        rows.append((k, " ".join(draw.choice(["red apple", "blue river", "old stone", "green leaf"]) for _ in range(60))))
    same = " ".join(["red apple blue river old stone green leaf"] * 8)
    rows += [(held[0], same), (held[1], " ".join(reversed(same.split())))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in mixing_lm.score_documents(df.repartition(1)).collect()}
    # The same words: only what is before each of them tells the two apart.
    assert abs(got[held[0]].base_score - got[held[1]].base_score) < 1e-9
    assert got[held[0]].score > got[held[1]].score + 5
    other = {r.doc_id: r for r in mixing_lm.score_documents(df.repartition(4)).collect()}
    assert all(abs(got[k].score - other[k].score) < 1e-3 for k in got)


def test_language_model_memo_changes_nothing(monkeypatch):
    draw = np.random.default_rng(2)
    predict = lambda key: (key % np.uint64(1009)).astype(np.float64)
    monkeypatch.setattr(mixing_lm, "MEMO_CELLS", 50)
    key = np.sort(draw.choice(1000, 100, False).astype(np.uint64))
    memo = mixing_lm.Memo((key, predict(key)), predict)
    for _ in range(30):
        some = np.sort(draw.permutation(1000)[: draw.integers(0, 120)]).astype(np.uint64)
        assert (memo.logs(some) == predict(some)).all() and len(memo.known[1][0]) <= 50
    columns = [np.array([0, 1 << 40, 3]), np.array([7, 8, 9]), np.zeros(0, np.int64), np.array([-1, 2]), np.array([True, False])]
    columns += [np.array([1.5, -2], np.float32), np.array([1 << 63], np.uint64), np.array([1, 255], np.uint8)]
    back = mixing_lm._unpack(mixing_lm._pack(*columns))
    assert all((x == y).all() and x.dtype == y.dtype for x, y in zip(columns, back)) and len(back) == len(columns)


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        kept = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert kept.columns == docs.columns
        after = {r.doc_id for r in kept.collect()}
        assert after <= before
        if name == "quality_classifier":
            good = {d for d in before if d in labels and labels[d].quality == 1 and labels[d].toxic == 0}
            assert len(good - after) <= 0.05 * len(good)
        if name == "decontamination":
            assert not any(i in r.text for r in kept.collect() for i in items)
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_every_operator_has_a_query():
    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES if q != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES and set(ORACLES) <= set(QUERIES)


def test_long_unseen_words_cost_by_their_length(spark):
    draw = random.Random(31)
    held = next(k for k in range(1000, 2000) if mixing_lm.is_held_out(k))
    sizes = (400, 4000, 40000)
    rows = [(k, prose(k, 80)) for k in range(60)]
    for size in sizes:
        rows.append((held, "".join(draw.choice("0123456789abcdef") for _ in range(size))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scores = sorted((r.score for r in mixing_lm.score_documents(df).collect() if r.doc_id == held), reverse=True)
    per_byte = [-score / size for score, size in zip(scores, sizes)]
    # At least half a digit a byte of sixteen that training has not shown in a row.
    assert all(x > 0.5 for x in per_byte) and max(per_byte) < 1.5 * min(per_byte)
