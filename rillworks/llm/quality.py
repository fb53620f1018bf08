"""Ordinal quality classifier: one hashed-text score, ordered thresholds.

``P(grade <= k) = sigmoid(threshold_k - w . x)`` with one weight vector for all
grades (a cumulative-link model). ``x`` holds the presence of hashed lower-cased
words and of their first bytes, the shares of hashed byte triples, and the shares of repeated words. The
expected grade and the probability of the top grade follow from the same score.

The fit takes at most ``PER_GRADE`` rated documents of each grade, those of the
smallest id hashes; scoring reads every whole text.

Nulls and extras: a null text is empty; a null id is scored like any other and
never used to fit; ratings with a null grade or id are ignored; repeated rows
are scored one by one; of several ratings of a document the lowest counts.
Other columns are ignored by ``score`` and kept by ``select_documents``. With
fewer than two grades rated, every document gets the one grade known (0 if
none) and is selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillworks.llm.land import broadcast_below, land
from rillworks.llm.text import _LOWER, Texts, Words, mix, prefix_hashes, slices, spans, words

#: Rated documents of each grade that the fit may use.
PER_GRADE = 3_000
#: Rows of the sample up to which their ids are broadcast.
MOST_BROADCAST = 1_000_000
TRIPLE_BITS = 12
N_TRIPLES, N_SHARES = 1 << TRIPLE_BITS, 2
#: Features of every text; those of known words come after them.
FIXED = N_TRIPLES + N_SHARES
#: Weight of the absolute values of word weights in the first fit. The slope of a
#: word is at most its share of the rated documents: a rarer one never starts.
SPARSE = 3e-3
#: Bytes of a word's start that are a feature of their own.
STEM = 4
#: Words of a smaller weight in the sparse fit are left out of the second.
LEAST_WEIGHT = 0.3
#: Rated documents whose features are widened at once in a fit.
_ROWS = 512
#: Triple shares are small numbers; this brings them near the presence of words.
TRIPLE_SCALE = 8.0


class Model(NamedTuple):
    grades: list[int]
    known: np.ndarray  # hashes of the words and word starts that have a weight, sorted
    weights: np.ndarray
    thresholds: np.ndarray


class Features(NamedTuple):
    """Rows of a sparse matrix, row after row."""

    at: np.ndarray
    index: np.ndarray
    value: np.ndarray


def word_marks(texts: Texts) -> tuple[np.ndarray, np.ndarray, Words]:
    """``(hash, row)`` of all words and word starts, in 64 bits, and the words."""
    found = words(texts)
    long = np.flatnonzero(found.end - found.start > STEM)
    start = found.start[long]
    stem = mix(spans(prefix_hashes(_LOWER[texts.data]), start, start + STEM))
    return np.concatenate([found.hash, stem]), np.concatenate([found.text, found.text[long]]), found


def features(texts: Texts, known: np.ndarray, marks: tuple | None = None) -> Features:
    """Features of every whole text."""
    n = len(texts.at) - 1
    hashes, of_hash, found = marks or word_marks(texts)
    at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
    hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
    present = np.unique(of_hash[hit] * max(len(known), 1) + at[hit])
    data = texts.data.astype(np.int64)
    triple = data[:-2] << 16 | data[1:-1] << 8 | data[2:] if len(data) > 2 else np.zeros(0, np.int64)
    row = np.repeat(np.arange(n), np.diff(texts.at))[: len(triple)]
    whole = np.arange(len(triple)) + 3 <= texts.at[row + 1]
    place = (mix(triple[whole].astype(np.uint64)) >> np.uint64(64 - TRIPLE_BITS)).astype(np.int64)
    triples, count = np.unique(row[whole] * N_TRIPLES + place, return_counts=True)
    of = triples // N_TRIPLES
    total = np.maximum(np.bincount(row[whole], minlength=n), 1)
    again = np.zeros(len(found.hash), bool)
    again[1:] = (found.hash[1:] == found.hash[:-1]) & (found.text[1:] == found.text[:-1])
    n_words = np.maximum(np.bincount(found.text, minlength=n), 1)
    repeats = np.bincount(found.text, weights=again, minlength=n) / n_words
    first_of_each = np.unique(mix(found.hash + mix(found.text.astype(np.uint64))), return_index=True)[1]
    distinct = np.bincount(found.text[first_of_each], minlength=n) / n_words
    rows = np.concatenate([of, np.arange(n), np.arange(n), present // max(len(known), 1)])
    index = np.concatenate(
        [triples % N_TRIPLES, np.full(n, FIXED - 2), np.full(n, FIXED - 1), FIXED + present % max(len(known), 1)]
    )
    value = np.concatenate([TRIPLE_SCALE * count / total[of], repeats, distinct, np.ones(len(present))])
    order = np.argsort(rows, kind="stable")
    at = np.searchsorted(rows[order], np.arange(n + 1))
    return Features(at, index[order].astype(np.int32), value[order].astype(np.float32))


def scores(x: Features, weights: np.ndarray) -> np.ndarray:
    return np.add.reduceat(weights.astype(np.float32)[x.index] * x.value, x.at[:-1], dtype=np.float64) if len(x.at) > 1 else np.zeros(0)


def _blocks(x: Features) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Some rows of a sparse matrix at a time: first and last row, index, value."""
    for first in range(0, len(x.at) - 1, _ROWS):
        last = min(first + _ROWS, len(x.at) - 1)
        cut = slice(x.at[first], x.at[last])
        yield first, last, x.index[cut], x.value[cut].astype(np.float32)


def _row_scores(x: Features, weights: np.ndarray) -> np.ndarray:
    """:func:`scores`, some rows at a time."""
    weights = weights.astype(np.float32)
    out = np.zeros(len(x.at) - 1)
    for first, last, index, value in _blocks(x):
        out[first:last] = np.add.reduceat(weights[index] * value, x.at[first:last] - x.at[first], dtype=np.float64)
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _shrunk(slope: np.ndarray, w: np.ndarray, sparse: float) -> np.ndarray:
    """Slope with the penalty on absolute values; at nothing only what exceeds it counts."""
    at_rest = np.sign(slope) * np.maximum(np.abs(slope) - sparse, 0)
    return np.where(w == 0, at_rest, slope + sparse * np.sign(w))


def fit_selected(x: Features, n_known: int, grade: np.ndarray, n_grades: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A sparse fit names the known words that matter; a second one fits those freely.

    ``(words kept, weights, thresholds)``.
    """
    first, _ = fit_ordinal(x, FIXED + n_known, grade, n_grades, steps=80, sparse=SPARSE)
    kept = np.abs(first) > LEAST_WEIGHT
    kept[:FIXED] = True
    new = np.cumsum(kept) - 1
    row = np.repeat(np.arange(len(grade)), np.diff(x.at))
    good = kept[x.index]
    at = np.searchsorted(row[good], np.arange(len(grade) + 1))
    chosen = Features(at, new[x.index[good]].astype(np.int32), x.value[good])
    weights, cuts = fit_ordinal(chosen, int(kept.sum()), grade, n_grades, steps=150, sparse=1e-4, speed=0.25)
    return kept[FIXED:], weights, cuts


def fit_ordinal(
    x: Features, size: int, grade: np.ndarray, n_grades: int, steps: int, sparse: float, speed: float = 0.05
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the likelihood of the grades.

    ``sparse`` is the weight of the absolute values of word weights: words that
    few rated documents hold, or that say nothing of the grade, get none.
    """
    n = len(grade)
    gaps = np.zeros(n_grades - 1)
    gaps[0] = -1.0
    part = np.zeros(size + n_grades - 1)
    part[size:] = gaps
    first, second = np.zeros_like(part), np.zeros_like(part)
    for step in range(1, steps + 1):
        w, g = part[:size], part[size:]
        cuts = g[0] + np.concatenate([[0.0], np.cumsum(np.exp(g[1:]))])
        s = _row_scores(x, w)
        padded = np.concatenate([[-np.inf], cuts, [np.inf]])
        low, high = padded[grade], padded[grade + 1]
        below, above = _sigmoid(low - s), _sigmoid(high - s)
        p = np.maximum(above - below, 1e-12)
        dl, dh = below * (1 - below), above * (1 - above)
        pull = (dl - dh) / p / n  # of the log likelihood, by the score
        slope = np.zeros_like(part)
        for a, b, index, value in _blocks(x):
            push = np.repeat(pull[a:b].astype(np.float32), np.diff(x.at[a : b + 1]))
            slope[:size] -= np.bincount(index, weights=value * push, minlength=size)
        slope[FIXED:size] = _shrunk(slope[FIXED:size], w[FIXED:], sparse)
        by_cut = np.zeros(n_grades + 1)
        np.add.at(by_cut, grade + 1, dh / p / n)
        np.add.at(by_cut, grade, -dl / p / n)
        by_cut = by_cut[1:-1]
        slope[size] = -by_cut.sum()
        for k in range(1, n_grades - 1):
            slope[size + k] = -by_cut[k:].sum() * np.exp(g[k])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        rate = speed * min(1.0, 2 * (1 - step / (steps + 1)))
        moved = part - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        crossed = moved[FIXED:size] * part[FIXED:size] < 0  # a word weight stops at nothing
        moved[FIXED:size][crossed] = 0
        part = moved
    g = part[size:]
    return part[:size].astype(np.float32), g[0] + np.concatenate([[0.0], np.cumsum(np.exp(g[1:]))])


def _sample(docs: DataFrame, ratings: DataFrame, id_col: str, text_col: str, per_grade: int):
    lowest = (
        ratings.select(F.col(id_col).cast("long").alias("id"), F.col("grade").cast("int").alias("grade"))
        .where("id is not null and grade is not null")
        .groupBy("id")
        .agg(F.min("grade").alias("grade"))
    )
    rated = dict(map(tuple, lowest.groupBy("grade").count().collect()))
    grades = sorted(rated)
    if len(grades) < 2:
        return grades, None
    # The lowest hashes of a grade; those of twice as many are ranked, whatever its size.
    most = {g: min(2**63 - 1, int(2**64 * min(1.0, 2 * per_grade / n)) - 2**63) for g, n in rated.items()}
    below = F.create_map(*[F.lit(x) for g in grades for x in (g, most[g])])[F.col("grade")]
    draw = Window.partitionBy("grade").orderBy(F.xxhash64("id"), "id")
    near = lowest.where(F.xxhash64("id") <= below)
    chosen = near.withColumn("_n", F.row_number().over(draw)).where(F.col("_n") <= per_grade).drop("_n")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # At most so many rows of two numbers each.
    return grades, texts.join(broadcast_below(chosen, len(grades) * per_grade, MOST_BROADCAST), "id")


def _marks_of(rated: DataFrame) -> DataFrame:
    """``id, grade, hashes, index, value``: words and other features of the rated texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for batch in batches:
            for texts in slices(batch.column(1)):
                marks, n = word_marks(texts), len(texts.at) - 1
                x = features(texts, none, marks)
                order = np.lexsort((marks[0], marks[1]))
                hashes, of = marks[0][order], marks[1][order]
                new = np.append(True, (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])) if len(of) else np.zeros(0, bool)
                hashes, cut = hashes[new], np.searchsorted(of[new], np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, n),
                        batch.column(2).slice(texts.first, n),
                        pa.ListArray.from_arrays(cut, pa.array(hashes.view(np.int64))),
                        pa.array([x.index[a:b].tobytes() for a, b in zip(x.at, x.at[1:])], pa.binary()),
                        pa.array([x.value[a:b].astype(np.float16).tobytes() for a, b in zip(x.at, x.at[1:])], pa.binary()),
                    ],
                    ["id", "grade", "hashes", "index", "value"],
                )

    kinds = "id long, grade int, hashes array<long>, index binary, value binary"
    return rated.select("id", "text", "grade").mapInArrow(run, kinds)


def _with_known(marks: DataFrame, known: np.ndarray) -> DataFrame:
    """``id, grade, index, value``: only the words that a fit may use are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, value = [], []
            for mine, i, v in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                mine = mine.values.to_numpy().view(np.uint64)
                at = np.minimum(np.searchsorted(known, mine), max(len(known) - 1, 0))
                at = at[known[at] == mine] if len(known) else at[:0]
                index.append(np.append(np.frombuffer(i, np.int32), FIXED + at).astype(np.int32).tobytes())
                value.append(np.append(np.frombuffer(v, np.float16), np.ones(len(at), np.float16)).tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(index, pa.binary()), pa.array(value, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "grade", "index", "value"])

    return marks.mapInArrow(run, "id long, grade int, index binary, value binary")


def _fitted(rows: DataFrame, grades: list[int], known: np.ndarray) -> DataFrame:
    """One row, the model, fitted in one task on the bounded sample."""

    def run(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table.column("id")))
        small = np.uint16 if FIXED + len(known) < 1 << 16 else np.int32
        index = [np.frombuffer(b.as_buffer(), np.int32).astype(small) for b in table.column("index")]
        value = [np.frombuffer(b.as_buffer(), np.float16) for b in table.column("value")]
        at = np.cumsum([0, *map(len, index)])
        x = Features(at, np.concatenate(index), np.concatenate(value))
        grade = np.searchsorted(grades, table.column("grade").to_numpy())
        del table, index, value
        kept, weights, cuts = fit_selected(x, len(known), grade, len(grades))
        parts = [known[kept].tobytes(), weights.astype(np.float32).tobytes(), cuts.astype(np.float64).tobytes()]
        return pa.table({k: pa.array([p], pa.binary()) for k, p in zip(("known", "weights", "cuts"), parts)})

    return rows.groupBy().applyInArrow(run, "known binary, weights binary, cuts binary")


def fit(
    docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_grade: int = PER_GRADE
) -> Model:
    """Fit on ``ratings(<id_col>, grade)``; grades are integers, higher is better.

    The sample's words are counted by Spark; those in too few of its texts to get a
    weight are left out before the fit, which runs in a task. The driver gets the model.
    """
    grades, rated = _sample(docs, ratings, id_col, text_col, per_grade)
    empty = Model(grades or [0], np.zeros(0, np.uint64), np.zeros(FIXED, np.float32), np.zeros(0))
    if rated is None:
        return empty
    marks = land(_marks_of(rated), "rated")
    n = marks.count()
    if not n:
        return empty
    words_of = marks.select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("n"))
    frequent = words_of.where(F.col("n") > SPARSE * n).select("hash").toArrow()
    known = np.sort(frequent.column("hash").to_numpy().view(np.uint64))
    model = _fitted(_with_known(marks, known), grades, known).first()
    return Model(
        grades,
        np.frombuffer(bytes(model["known"]), np.uint64),
        np.frombuffer(bytes(model["weights"]), np.float32),
        np.frombuffer(bytes(model["cuts"]), np.float64),
    )


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, score, expected_grade, top_probability`` per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(1)):
                s = scores(features(texts, model.known), model.weights).astype(np.float64)
                tails = [_sigmoid(s - cut) for cut in model.thresholds]
                expected = model.grades[0] + sum(
                    (b - a) * t for a, b, t in zip(model.grades, model.grades[1:], tails)
                ) + np.zeros(len(s))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(s)),
                        pa.array(s),
                        pa.array(expected),
                        pa.array(tails[-1] if tails else np.ones(len(s))),
                    ],
                    [id_col, "score", "expected_grade", "top_probability"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, score double, expected_grade double, top_probability double"
    )


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """Grade 0: poor; 1: toxic but else good; 2: good. A null flag counts as good."""
    poor = F.coalesce("quality", F.lit(1)) == 0
    return labels.select(
        "doc_id",
        F.when(poor, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2).alias("grade"),
    )


def select_documents(
    docs: DataFrame, model: Model, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows whose top grade has probability ``least`` or more; columns stay."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for batch in batches:
            keep = [
                _sigmoid(scores(features(texts, model.known), model.weights) - model.thresholds[-1]) >= least
                if len(model.thresholds)
                else np.ones(len(texts.at) - 1, bool)
                for texts in slices(batch.column(at))
            ]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
