"""Phrases, source mixing, conversation repair, and the rounds of packing."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillworks.llm import collocations, packing, repair, source_mix
from rillworks.llm.collocations import mine
from rillworks.llm.packing import lower_bound, pack_documents
from rillworks.llm.repair import cheapest, damage, damaged_report, join_segments
from rillworks.llm.source_mix import mix_sources
from rillworks.llm.text import slices
from rillworks.llm.tokens import tokenizer_file, word_ids

SF = "/root/testdata/sf0.001"


# Phrases


def plain_phrases(rows, least, top):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        rows = []
        for p, a in found.items():
            if 100 * inside.get(p, -1) >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [
            (lang, i, p.decode(), -a, left, right, n[lang], -s)
            for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)
        ]
    return sorted(out)


def phrases(df, **kwargs):
    return sorted(tuple(r) for r in mine(df, **kwargs).collect())


def test_phrases_equal_plain_counts_over_many_blocks_and_shelves(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_phrases([(r.lang, r.text) for r in docs.collect()], 5, 40)
    assert phrases(docs, least=5, top=40) == want and len(want) > 100
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 30_000)
    monkeypatch.setattr(collocations, "SHELF_RUNS", 1_000)
    assert phrases(docs.repartition(5), least=5, top=40) == want


def test_phrases_of_odd_texts(spark, odd_documents, no_documents):
    draw = random.Random(4)
    rows = [(draw.choice(["en", None, "und", "x"]), draw.choice([None, "", " ", "a b c. A b", "a\tb c d e", "É b;É b", "z" * 5000 + " y", "b a\x01 b a\x01", "b a b a", "\x0bq\x0cq"])) for _ in range(400)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "lang string, text string, block string, a int")
    assert phrases(df, least=3, top=7) == plain_phrases(rows, 3, 7)
    assert phrases(odd_documents, least=2, top=50) == plain_phrases([(r.lang, r.text) for r in odd_documents.collect()], 2, 50)
    assert phrases(no_documents) == [] and phrases(odd_documents, least=10**9) == []


@pytest.mark.parametrize("id_bits, n", [(1, 3), (15, 4000), (16, 4000), (20, 5000), (31, 3000)])
def test_filters_lose_nothing(id_bits, n):
    draw = np.random.default_rng(id_bits)
    for longest in (2, 4):
        for shelf_bits in (0, 3):
            coding = collocations._Coding(id_bits, shelf_bits, 1)
            half, shelf_bits = coding.half(longest), coding.shelf_bits[longest]
            hi, lo = (draw.integers(0, 1 << half, n).astype(np.uint64) for _ in range(2))
            p, q = collocations._permute(hi, lo, half)
            assert all((x == y).all() for x, y in zip(collocations._restore(p, q, half), (hi, lo)))
            assert int(max(p.max(), q.max())) < 1 << half
            order, first = collocations._distinct(p, q, half)
            counts = draw.choice([1, 2, 254, 255, 256, 1 << 40], len(first))
            a, b = p[order[first]], q[order[first]]
            rows = list(collocations._write(a, b, counts, half, shelf_bits, 7))
            assert [r[0] for r in rows] == sorted({r[0] for r in rows})
            back = [collocations._read(r[0], *r[2:], half, shelf_bits) for r in rows]
            got = [np.concatenate(c) for c in zip(*back)]
            assert (got[0] == a).all() and (got[1] == b).all() and (got[2] == counts).all()


# Mixing


def check_mix(df, most=3):
    rows = mix_sources(df).collect()
    total = sum(r.size for r in rows)
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r.taken <= most * r.size and r.taken == r.copies * r.size
        by[r.source_size, r.target].append(r)
    for (size, target), some in by.items():
        assert target <= most * size + 1e-9
    return rows, total


def test_targets_are_reshared_by_weight_up_to_three_times(spark):
    # Weights go by code point order: A 5, B 2, C 1, a 5, null 2.
    sizes = {"A": 10, "B": 400, "C": 400, "a": 90, None: 100}
    rows = [(k * 100 + i, s, "w " * (n // 10)) for k, (s, n) in enumerate(sizes.items()) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found, total = check_mix(df)
    source = {r[0]: r[1] for r in rows}
    target = {source[r.doc_id]: r.target for r in found}
    assert total == 1000 and abs(sum(target.values()) - 1000) < 1e-6
    # A stops at 30, a at 270; the other 700 are shared 2 : 1 : 2, the null source stops at 280.
    assert target["A"] == 30 and target["a"] == 270
    assert abs(target["B"] - 280) < 1e-9 and abs(target["C"] - 140) < 1e-9 and abs(target[None] - 280) < 1e-9
    taken = Counter()
    for r in found:
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - t) <= 40 for s, t in target.items())


def test_taken_words_come_near_targets_and_reruns_agree(spark):
    draw = random.Random(9)
    rows = [
        (i, draw.choice(["hot"] * 6 + ["s1", "s2", "s3", "s4"]), " ".join("x" * draw.choice([1, 2, 5, 40, 41, 300])))
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found, _ = check_mix(df)
    taken, target = Counter(), {}
    for r in found:
        taken[rows[r.doc_id][1]] += r.taken
        target[rows[r.doc_id][1]] = r.target
    assert all(abs(taken[s] / t - 1) < 0.005 for s, t in target.items())
    again = mix_sources(df.repartition(13, F.xxhash64("doc_id"))).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))
    # Longer documents are likelier: of those in the hot source, by class.
    drawn = defaultdict(list)
    for r in found:
        if rows[r.doc_id][1] == "hot":
            drawn[r.size].append(r.copies)
    assert np.mean(drawn[300]) > np.mean(drawn[5]) > np.mean(drawn[1])


def test_mixing_of_odd_documents(spark, odd_documents, no_documents):
    rows, total = check_mix(odd_documents)
    assert len(rows) == 12 and total == sum(len(re.findall("[^\x20\x09-\x0d]+", r.text or "")) for r in odd_documents.collect())
    assert mix_sources(no_documents).count() == 0
    empty = spark.createDataFrame([(1, None, None), (2, "", "s")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mix_sources(empty).collect()] == [(0.0, 0), (0.0, 0)]
    same = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit("a b").alias("text"))
    both = same.unionByName(same.withColumn("source", F.lit("t")))
    found = mix_sources(both).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 2 for r in found)


# Conversations

NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
ROLE = {"u": "user", "a": "assistant"}


def plain_repair(rows):
    """Least cost and edits, by going through all states row by row."""
    best = {(0, 0): (0, "")}

    def offer(node, label):
        if node not in best or label < best[node]:
            best[node] = label
            return True
        return False

    for i in range(len(rows) + 1):
        moved = True
        while moved:
            moved = False
            for q in range(4):
                if (i, q) in best:
                    cost, audit = best[i, q]
                    moved |= any([offer((i, NEXT[q][r]), (cost + 3, audit + "I")) for r in "ua" if r in NEXT[q]])
        if i == len(rows):
            break
        initial, gone, unfinished = rows[i]
        for q in range(4):
            if (i, q) in best:
                cost, audit = best[i, q]
                offer((i + 1, q), (cost + 4, audit + "D"))
                if not gone:
                    more = 3 * unfinished
                    if initial in NEXT[q]:
                        offer((i + 1, NEXT[q][initial]), (cost + more, audit + "K"))
                    for r in "ua":
                        if r in NEXT[q]:
                            offer((i + 1, NEXT[q][r]), (cost + 3 + more, audit + "R"))
    return min(best[len(rows), q] for q in (0, 3) if (len(rows), q) in best)


def test_the_two_searches_find_the_least_edits():
    draw = random.Random(5)
    for _ in range(1500):
        rows = []
        for _ in range(draw.randrange(9)):
            gone = draw.random() < 0.2
            rows.append((draw.choice("suaoua"), gone, not gone and draw.random() < 0.3))
        symbols = "".join("x" if gone else i.upper() if t else i for i, gone, t in rows)
        want = plain_repair(rows)
        assert cheapest(symbols) == want
        cuts = sorted(draw.choices(range(len(symbols) + 1), k=2))
        parts = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]
        assert join_segments([[cheapest(s, q, (p,)) for q in range(4) for p in range(4)] for s in parts]) == want


def plain_report(table):
    word, rows = re.compile("[^\x20\x09-\x0d]"), defaultdict(list)
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind:
            rows[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)

    def place(row):
        same = hashlib.sha256(f"{len(row[1])}:{row[1]}{row[2]}".encode()).hexdigest()
        return row[0] is not None, row[0] or 0, row[1], same

    out = []
    for conv in {r[0] for r in table}:
        mine, seen, faults, lattice = sorted(rows[conv], key=place), set(), [0, 0, 0], []
        for _, role, text in mine:
            found = word.findall(text)
            gone = not found or (role, text) in seen
            unfinished = not gone and found[-1] not in ".!?"
            faults[0] += not found
            faults[1] += bool(found) and gone
            faults[2] += unfinished
            seen.add((role, text))
            lattice.append((role[:1], gone, unfinished))
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(lattice, lattice[1:]))
        cost, audit = plain_repair(lattice)
        state, left, lines = 0, iter(mine), []
        for edit in audit:
            made = "a" if state == 2 else "u"
            _, role, text = (None, ROLE[made], "") if edit == "I" else next(left)
            if edit != "D":
                role = role if edit == "K" else ROLE[made]
                lines.append(f"{role}:{text}")
                state = NEXT[state][role[:1]]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *faults, illegal, cost, audit, digest))
    return sorted(out, key=repr)


def report(df):
    return sorted((tuple(r) for r in damaged_report(df).collect()), key=repr)


def test_reports_equal_a_plain_repair(spark, monkeypatch):
    draw = random.Random(6)
    rows = [
        (
            draw.choice([1, 1, 2, None, draw.randrange(4, 120)]),
            draw.choice([None, *range(300)]),
            draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
            draw.choice(["Hi.", "Hi", "", "\n ", None, "ok!", f"word {draw.randrange(40)}?", f"é {draw.randrange(400)}.", "x" * 3000]),
        )
        for _ in range(1500)
    ]
    names = "conv_id long, turn long, role string, text string, conv string, audit int"
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], names)
    want = plain_report(rows)
    assert report(df) == want
    # Long conversations in many segments, over many tasks.
    monkeypatch.setattr(repair, "SEGMENT_ROWS", 7)
    assert report(df.repartition(6)) == want
    assert report(df.limit(0)) == []


def test_conversations_of_the_tables(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert report(df) == plain_report([tuple(r) for r in df.collect()])


def test_a_conversation_without_rows_is_returned(spark):
    gone = [(c, t) for c in range(200) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    df = spark.createDataFrame([(*r, "user", "a.") for r in gone], "conv_id long, turn long, role string, text string")
    assert damage(df).count() == 0
    none = hashlib.sha256().hexdigest()
    assert report(df) == sorted(((c, 0, 0, 0, 0, 0, 0, "", none) for c, _ in gone), key=repr)


def test_the_repaired_turns_are_given_in_order(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "user", "u."), (1, 2, "user", "v"), (1, 3, "assistant", "  ")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plans = repair.plan_repairs(df)
    turns = repair.apply_repairs(df, plans).collect()
    audit = plans.first().audit
    assert [r.place for r in turns] == list(range(len(turns)))
    assert [r.edit for r in turns] == [e for e in audit if e != "D"]
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in turns))


# Packing


def test_ids_equal_the_plain_tokenizer(monkeypatch):
    from tokenizers import Tokenizer

    from rillworks.llm import tokens

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    plain = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    draw = random.Random(1)
    signs = [*"abcXYZ019 '’.,;:!?-_()<>|=\n\t\r\x0b\x0c\x00\x1f\x85\xa0éÉßİıſKΣσς中文ﬁ한😀", "́", "̸", "'s", "'T", "'re", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "n't"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randrange(60))) for _ in range(8000)] + [None, ""]
    # A memo that forgets all the time.
    monkeypatch.setattr(tokens, "MEMO", 2000)
    for some in slices(pa.array(texts), 3000):
        at, ids = word_ids(some, "word_bpe_49k.json")
        for i in range(len(at) - 1):
            want = plain.encode(texts[some.first + i] or "", add_special_tokens=False).ids
            assert ids[at[i] : at[i + 1]].tolist() == want


def test_rounds_of_exchange_keep_sequences_near_their_bound(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = pack_documents(docs).collect()
    monkeypatch.setattr(packing, "PART_PIECES", 16)
    monkeypatch.setattr(packing, "MEET", 2)
    parts = pack_documents(docs).collect()

    def pieces(rows):
        return sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)

    assert pieces(whole) == pieces(parts)
    bound = lower_bound(np.array([r.length for r in whole]), 4096)
    for rows in (whole, parts):
        held = defaultdict(list)
        for r in rows:
            held[r.sequence_id].append((r.offset, r.length))
        for places in held.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 4096
        assert len(held) <= bound + max(1, bound // 50)


def test_equal_rows_are_dealt_over_the_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_PIECES", 500)
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    seen = []
    pack = packing._pack

    def watched(pieces, parts, *rest):
        placed = pieces.withColumn("row", F.monotonically_increasing_id()).repartition(parts, F.xxhash64("row"))
        seen.append(sorted(r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()))
        return pack(pieces, parts, *rest)

    monkeypatch.setattr(packing, "_pack", watched)
    rows = pack_documents(df).collect()
    assert len(rows) == 4000 and len(seen[0]) == 8 and seen[0][-1] < 2 * seen[0][0]
    assert len({r.sequence_id for r in rows}) <= 8
