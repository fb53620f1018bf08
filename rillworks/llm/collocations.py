"""Phrases whose words keep together, counted in counting quotient filters.

Whole texts are cut into blocks of one language. A word's id is its number among
all words that are frequent enough to lie in a phrase; runs of ids are packed,
permuted invertibly, and counted per block in a sorted filter: the top bits of
the permuted value are the quotient, of which only run lengths are kept, the
rest is the full remainder. So a filter is compact and loses nothing. Filters are
cut at quotients into shelves, and a shelf's filters of all blocks are merged.
The first round counts pairs and answers each block with one bit per pair, whether
it is frequent; the second counts only runs of three and four whose pairs all are.

Nulls and extras: a null language is ``und``, a null text empty; ids are not
looked at, so rows with a null or repeated id count like any other; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillworks.llm.land import land, numbered
from rillworks.llm.text import Texts, mix, slices

#: Bytes of text of one language that become one block.
BLOCK_BYTES = 4 << 20
#: Runs of words per shelf, on average, before equal ones meet.
SHELF_RUNS = 1 << 19
MAX_WORDS = 4

_BREAK, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK[list(b" \t")] = True
_INSIDE = ~(_BREAK | _BLANK)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ROUNDS = [np.uint64(0x9E3779B97F4A7C15 * k % 2**64) for k in (1, 3, 5, 7)]

SEGMENT = "shelf long, block long, bits int, runs binary, remainders binary, counts binary"


# Blocks of local word numbers


def _tokens(texts: Texts) -> tuple[np.ndarray, pa.Array]:
    """Word numbers (from 1, 0 where a piece ends) of some texts, and their words."""
    inside = _INSIDE[texts.data]
    edge = np.zeros(len(texts.data) + 1, bool)
    edge[texts.at] = True
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    first = inside & (edge[:-1] | ~before)
    start = np.flatnonzero(first)
    # A word's bytes run from its start to the next start, separators left out.
    size = np.add.reduceat(inside, start, dtype=np.int32) if len(start) else np.zeros(0, np.int32)
    at = np.zeros(len(start) + 1, np.int32)
    np.cumsum(size, out=at[1:])
    body = _LOWER[texts.data[inside]]
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(body)])
    coded = words.dictionary_encode()
    ends = np.searchsorted(np.flatnonzero(_BREAK[texts.data] | edge[:-1]), start, "right")
    fresh = np.flatnonzero(np.diff(ends, prepend=ends[:1]))
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
    return np.insert(numbers, fresh, 0), coded.dictionary


def _blocks(docs: DataFrame) -> DataFrame:
    """``block, lang, tokens, words, counts`` of ``lang, text``."""

    def block(lang: str, held: list[Texts], name: int) -> pa.RecordBatch:
        at = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(t.at) for t in held]))])
        numbers, words = _tokens(Texts(0, at, np.concatenate([t.data for t in held])))
        counts = np.bincount(numbers, minlength=len(words) + 1)[1:]
        one = np.array([0, len(words)], np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name], pa.int64()),
                pa.array([lang], pa.string()),
                pa.array([numbers.astype("<i4").tobytes()], pa.binary()),
                pa.ListArray.from_arrays(one, words.cast(pa.string())),
                pa.ListArray.from_arrays(one, pa.array(counts, pa.int64())),
            ],
            ["block", "lang", "tokens", "words", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 32
        held: dict[str, list[Texts]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            index = codes.indices.to_numpy(zero_copy_only=False)
            for k, lang in enumerate(codes.dictionary.to_pylist()):
                for texts in slices(batch.column(1).take(pa.array(np.flatnonzero(index == k))), BLOCK_BYTES // 2):
                    held.setdefault(lang, []).append(texts)
                    size[lang] = size.get(lang, 0) + len(texts.data)
                    if size[lang] >= BLOCK_BYTES:
                        yield block(lang, held.pop(lang), name)
                        size.pop(lang)
                        name += 1
            if sum(size.values()) >= 4 * BLOCK_BYTES:
                for lang in list(held):
                    yield block(lang, held.pop(lang), name)
                    name += 1
                size.clear()
        for lang, texts in held.items():
            yield block(lang, texts, name)
            name += 1

    kinds = "block long, lang string, tokens binary, words array<string>, counts array<long>"
    return docs.mapInArrow(run, kinds)


# Filters


def _permute(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """A Feistel network over two halves of ``half`` bits."""
    mask = np.uint64((1 << half) - 1)
    for key in _ROUNDS:
        hi, lo = lo, hi ^ (mix(lo ^ key) & mask)
    return hi, lo


def _restore(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << half) - 1)
    for key in reversed(_ROUNDS):
        hi, lo = lo ^ (mix(hi ^ key) & mask), hi
    return hi, lo


def _order(hi: np.ndarray, lo: np.ndarray, half: int) -> np.ndarray:
    if 2 * half <= 64:
        return np.argsort((hi << np.uint64(half)) | lo, kind="stable")
    return np.lexsort((lo, hi))


def _distinct(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """``(order, first)``: the sorting order and where in it a new value begins."""
    order = _order(hi, lo, half)
    new = np.ones(len(order), bool)
    a, b = hi[order], lo[order]
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


def _write(hi, lo, counts, half: int, shelf_bits: int, block: int) -> Iterator[tuple]:
    """The segments of one filter, given sorted distinct values."""
    n = len(hi)
    bits = min(half, max(shelf_bits, int(n).bit_length()))
    quotient = hi >> np.uint64(half - bits)
    rest = hi & np.uint64((1 << (half - bits)) - 1)
    wide = np.zeros((n, 2), "<u8")
    wide[:, 0] = lo | (rest << np.uint64(half)) if half < 64 else lo
    wide[:, 1] = rest >> np.uint64(64 - half)
    remainders = wide.view(np.uint8).reshape(n, 16)[:, : (2 * half - bits + 7) // 8]
    shelf = (quotient >> np.uint64(bits - shelf_bits)).astype(np.int64)
    cut = np.flatnonzero(np.diff(shelf, prepend=-1))
    per = 1 << (bits - shelf_bits)
    for a, b in zip(cut, [*cut[1:], n]):
        runs = np.bincount((quotient[a:b] & np.uint64(per - 1)).astype(np.int64), minlength=per)
        runs = runs.astype(np.uint8 if runs.max() < 256 else "<u4")
        few, many = np.minimum(counts[a:b], 255).astype(np.uint8), counts[a:b][counts[a:b] >= 255]
        yield (
            int(shelf[a]), block, bits, runs.tobytes(), remainders[a:b].tobytes(),
            few.tobytes() + many.astype("<u8").tobytes(),
        )


def _read(shelf: int, bits: int, runs: bytes, remainders: bytes, counts: bytes, half: int, shelf_bits: int):
    """The sorted values and counts of one segment."""
    per = 1 << (bits - shelf_bits)
    run = np.frombuffer(runs, np.uint8 if len(runs) == per else "<u4")
    quotient = np.repeat(np.arange(per, dtype=np.uint64), run) + np.uint64(shelf * per)
    width = (2 * half - bits + 7) // 8
    n = len(quotient)
    wide = np.zeros((n, 16), np.uint8)
    wide[:, :width] = np.frombuffer(remainders, np.uint8).reshape(n, width)
    wide = wide.view("<u8")
    lo = wide[:, 0] & np.uint64((1 << half) - 1)
    rest = (wide[:, 0] >> np.uint64(half)) | (wide[:, 1] << np.uint64(64 - half))
    count = np.frombuffer(counts[:n], np.uint8).astype(np.int64)
    count[count == 255] = np.frombuffer(counts[n:], "<u8").astype(np.int64)
    return (quotient << np.uint64(half - bits)) | rest, lo, count


def _segments(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    names = ["shelf", "block", "bits", "runs", "remainders", "counts"]
    columns = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


class _Coding:
    """How runs of ids become permuted values; the same in every task."""

    def __init__(self, id_bits: int, shelf_bits: int, least: int) -> None:
        self.id_bits, self.least = id_bits, least
        # Pairs fill two halves of one id, longer runs two halves of two.
        self.shelf_bits = {2: min(shelf_bits, id_bits), 4: min(shelf_bits, 2 * id_bits)}

    def half(self, longest: int) -> int:
        return self.id_bits * longest // 2

    def pairs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(place, hi, lo)`` of pairs of neighbours, permuted."""
        place = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        wide = ids.astype(np.uint64)
        return (place, *_permute(wide[place], wide[place + 1], self.half(2)))

    def longer(self, ids: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of three and four ids whose pairs are all ``good``, permuted."""
        wide, shift = ids.astype(np.uint64), np.uint64(self.id_bits)
        three = np.flatnonzero(good[:-1] & good[1:])
        four = three[good[three + 2]]
        hi = [(wide[p] << shift) | wide[p + 1] for p in (three, four)]
        lo = [wide[three + 2] << shift, (wide[four + 2] << shift) | wide[four + 3]]
        return _permute(np.concatenate(hi), np.concatenate(lo), self.half(4))


def _count(hi, lo, coding: _Coding, longest: int, block: int) -> pa.RecordBatch:
    half = coding.half(longest)
    order, first = _distinct(hi, lo, half)
    counts = np.diff(first, append=len(order))
    rows = _write(hi[order[first]], lo[order[first]], counts, half, coding.shelf_bits[longest], block)
    return _segments(list(rows))


def _merge(segments: DataFrame, coding: _Coding, longest: int, answer: bool) -> DataFrame:
    """Frequent runs ``w1..w4, a`` of all blocks; with ``answer`` also a bit per entry and block."""

    def run(table: pa.Table) -> pa.Table:
        half, rows = coding.half(longest), table.to_pylist()
        parts = [
            _read(r["shelf"], r["bits"], r["runs"], r["remainders"], r["counts"], half, coding.shelf_bits[longest])
            for r in rows
        ]
        hi, lo, counts = (np.concatenate(c) for c in zip(*parts))
        order, first = _distinct(hi, lo, half)
        total = np.add.reduceat(counts[order], first)
        keep = total >= coding.least
        a, b = _restore(hi[order[first]][keep], lo[order[first]][keep], half)
        if longest == 2:
            ids = [a, b, np.zeros_like(a), np.zeros_like(a)]
        else:
            low, shift = np.uint64((1 << coding.id_bits) - 1), np.uint64(coding.id_bits)
            ids = [a >> shift, a & low, b >> shift, b & low]
        n, m = len(a), 0
        answers: list[tuple[int, int, bytes]] = []
        if answer:
            flags = np.empty(len(order), bool)
            flags[order] = np.repeat(keep, np.diff(first, append=len(order)))
            for row, part in zip(rows, parts):
                size = len(part[2])
                if flags[m : m + size].any():
                    answers.append((row["block"], size, np.packbits(flags[m : m + size]).tobytes()))
                else:
                    answers.append((row["block"], size, b""))
                m += size
        none = [None] * len(answers)
        columns = [pa.array([*x.astype(np.int64).tolist(), *none], pa.int64()) for x in (*ids, total[keep])]
        columns += [
            pa.array([*([None] * n), *(x[0] for x in answers)], pa.int64()),
            pa.array([rows[0]["shelf"]] * (n + len(answers)), pa.int64()),
            pa.array([*([None] * n), *(x[1] for x in answers)], pa.int64()),
            pa.array([*([None] * n), *(x[2] for x in answers)], pa.binary()),
        ]
        return pa.Table.from_arrays(columns, ["w1", "w2", "w3", "w4", "a", "block", "shelf", "size", "good"])

    kinds = "w1 long, w2 long, w3 long, w4 long, a long, block long, shelf long, size long, good binary"
    return segments.groupBy("shelf").applyInArrow(run, kinds)


def _coded(blocks: DataFrame, words: DataFrame, coding: _Coding) -> DataFrame:
    """Per block, a row with its tokens as ``ids`` of frequent words, 0 elsewhere, and its filter of pairs."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        local = np.frombuffer(left.column("tokens")[0].as_buffer(), "<i4")
        known = right.column("number").to_numpy()
        table = np.zeros(int(max(local.max(initial=0), known.max(initial=0))) + 1, "<u4")
        table[known] = right.column("id").to_numpy()
        ids = table[local]
        # Of a stretch of breaks one is enough.
        ids = ids[(ids > 0) | np.append(True, ids[:-1] > 0)]
        block = left.column("block")[0].as_py()
        _, hi, lo = coding.pairs(ids)
        counted = _count(hi, lo, coding, 2, block) if len(hi) else _segments([])
        none = pa.array([None] * counted.num_rows, pa.binary())
        whole = _segments([(None, block, None, None, None, None)])
        return pa.Table.from_batches(
            [whole.append_column("ids", pa.array([ids.tobytes()], pa.binary())), counted.append_column("ids", none)]
        )

    known = words.select(F.col("block").alias("of"), "number", "id").groupBy("of")
    sides = blocks.select("block", "tokens").groupBy("block").cogroup(known)
    return sides.applyInArrow(run, SEGMENT + ", ids binary")


def _count_longer(coded: DataFrame, answers: DataFrame, coding: _Coding) -> DataFrame:
    """Filters of runs of three and four, by the answers on pairs."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([_segments([])])
        ids = np.frombuffer(left.column("ids")[0].as_buffer(), "<u4")
        place, hi, lo = coding.pairs(ids)
        order, first = _distinct(hi, lo, coding.half(2))
        flags = []
        for row in right.sort_by("shelf").to_pylist():
            some = np.frombuffer(row["good"], np.uint8)
            flags.append(np.unpackbits(some, count=row["size"]).astype(bool) if len(some) else np.zeros(row["size"], bool))
        good = np.zeros(len(ids), bool)
        good[place[order]] = np.repeat(np.concatenate(flags), np.diff(first, append=len(order)))
        hi, lo = coding.longer(ids, good)
        if not len(hi):
            return pa.Table.from_batches([_segments([])])
        return pa.Table.from_batches([_count(hi, lo, coding, 4, left.column("block")[0].as_py())])

    answered = answers.withColumnRenamed("block", "of").groupBy("of")
    return coded.groupBy("block").cogroup(answered).applyInArrow(run, SEGMENT)


def count_phrases(docs: DataFrame, least: int, lang_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(phrases, words, totals)``.

    Phrases ``w1..w4, a`` of one to four ids (0: none) with at least ``least``
    occurrences, words ``id, lang, word``, and ``lang, n`` over all words.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")
    )
    blocks = land(_blocks(texts), "blocks")
    listed = blocks.select("block", "lang", F.posexplode("words").alias("at", "word"), "counts").select(
        "block", "lang", "word", (F.col("at") + 1).alias("number"), F.get("counts", F.col("at")).alias("a")
    )
    n_tokens = blocks.agg(F.sum(F.length("tokens"))).first()[0] or 0
    frequent = listed.groupBy("lang", "word").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    words = land(numbered(frequent, "id", "frequent"), "words")
    totals = blocks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("n"))
    totals = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    known = listed.select("block", "number", "lang", "word").join(words.select("lang", "word", "id"), ["lang", "word"])
    shelves = max(1, n_tokens // 4 // SHELF_RUNS)
    coding = _Coding(max(1, words.count().bit_length()), (shelves - 1).bit_length(), least)
    coded = land(_coded(blocks, known, coding), "coded")
    pairs = land(_merge(coded.where("ids is null").drop("ids"), coding, 2, True), "pairs")
    answers = pairs.where("good is not null").select("block", "shelf", "size", "good")
    ids = coded.where("ids is not null").select("block", "ids")
    longer = land(_merge(_count_longer(ids, answers, coding), coding, 4, False), "runs")
    columns = ["w1", "w2", "w3", "w4", "a"]
    none = F.lit(0).cast("long")
    single = words.select(F.col("id").alias("w1"), none.alias("w2"), none.alias("w3"), none.alias("w4"), "a")
    phrases = single.unionByName(pairs.where("good is null").select(*columns)).unionByName(longer.select(*columns))
    return land(phrases, "phrases"), words, totals


def _part(first: int, last: int) -> list[Column]:
    """Columns ``p1..p4`` of the words numbered ``first`` to ``last``."""
    ids = [F.col(f"w{k}") for k in range(first, last + 1)]
    return [*ids, *[F.lit(0).cast("long")] * (MAX_WORDS - len(ids))]


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def mine(
    docs: DataFrame,
    least: int = 30,
    top: int = 2000,
    absorbed_percent: int = 80,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases."""
    phrases, words, totals = count_phrases(docs, least, lang_col, text_col)
    size = sum(F.when(F.col(f"w{k}") > 0, 1).otherwise(0) for k in range(1, MAX_WORDS + 1))
    keys = ["p1", "p2", "p3", "p4"]

    def named(values: list) -> Column:
        return F.struct(*[v.alias(k) for v, k in zip(values, keys)])

    sized = phrases.where("w2 > 0").withColumn("size", size)
    # A phrase inside a longer one that is nearly as frequent is dropped.
    spans = [(m, a, b) for m in (3, 4) for a in range(1, m) for b in range(a + 1, m + 1) if b - a + 1 < m]
    inner = sized.where("size > 2").select(
        "a", F.explode(F.filter(F.array(*[
            F.when(F.col("size") == m, named(_part(a, b))) for m, a, b in spans
        ]), lambda x: x.isNotNull())).alias("part")
    ).groupBy(*[F.col(f"part.{k}").alias(f"w{k[1]}") for k in keys]).agg(F.max("a").alias("longer"))
    near = F.coalesce(100 * _exact("longer") >= absorbed_percent * _exact("a"), F.lit(False))
    kept = sized.join(inner, ["w1", "w2", "w3", "w4"], "left").where(~near).drop("longer")
    # Each way to cut a phrase in two.
    cuts = [(m, k) for m in (2, 3, 4) for k in range(1, m)]
    halves = kept.select("*", F.explode(F.filter(F.array(*[
        F.when(F.col("size") == m, F.struct(
            F.lit(k).alias("k"), named(_part(1, k)).alias("left"), named(_part(k + 1, m)).alias("right")
        )) for m, k in cuts
    ]), lambda x: x.isNotNull())).alias("cut"))
    counts = phrases.select(*[F.col(f"w{k[1]}").alias(k) for k in keys], F.col("a").alias("f"))

    def with_count(df: DataFrame, side: str, into: str) -> DataFrame:
        of = counts.select(F.struct(*keys).alias("_part"), F.col("f").alias(into))
        return df.join(of, F.col(f"cut.{side}") == F.col("_part")).drop("_part")

    cut = with_count(with_count(halves, "left", "l"), "right", "r")
    score = F.expr("cast((2000000 * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r) as bigint)")
    scored = (
        cut.withColumn("score", score)
        .groupBy("w1", "w2", "w3", "w4", "a")
        .agg(F.min(F.struct("score", F.col("cut.k").alias("k"), "l", "r")).alias("least"))
        .select("w1", "w2", "w3", "w4", "a", "least.l", "least.r", "least.score")
    )
    tongue = words.select(F.col("id").alias("w1"), "lang")
    scored = scored.join(tongue, "w1")
    # Ties in score and count all stay until their words are known.
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = land(scored.withColumn("_rank", F.rank().over(first)).where(F.col("_rank") <= top).drop("_rank"), "best")
    spelled = (
        best.select("w1", "w2", "w3", "w4", F.posexplode(F.array("w1", "w2", "w3", "w4")).alias("at", "id"))
        .join(words.select("id", "word"), "id")
        .groupBy("w1", "w2", "w3", "w4")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select("w1", "w2", "w3", "w4", F.array_join("words.word", " ").alias("phrase"))
    )
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        best.join(spelled, ["w1", "w2", "w3", "w4"])
        .withColumn("rank", F.row_number().over(last).cast("long"))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
