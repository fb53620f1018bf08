"""Benchmark decontamination by the q-gram lemma and banded alignment.

Every stretch of ``WINDOW`` bytes of an item, wherever it starts, is a window with an
edit budget in proportion to its length (shorter items are one window). A window of
``m`` bytes within ``k`` edits of a stretch of text shares at least
``m - q + 1 - k * q`` q-grams with it, all near one diagonal. Hits of every whole text
are counted per item in overlapping diagonal bands; in bands that reach the least bound
of the item, the windows that share enough are aligned within the band, best first. An
alignment that needs ``d`` edits too many rules out the windows less than ``d / 2`` away.

Items below ``SHORT`` bytes must occur whole and without an edit, between word borders;
those below ``Q`` bytes say too little, so only a text that is nothing else matches.

Bytes are compared after A-Z are lowered and white space bytes made blanks. Hits are
counted in parts of bounded size, however often a gram repeats.

Nulls and extras: null or empty texts and items never match; rows with a null
or repeated id are judged one by one; items with a null id are left out; other columns
stay (``clean_documents``) or are ignored (``leaks``). An empty benchmark leaves all
documents. The benchmark passes through the driver and to the tasks in blocks of
``BLOCK_BYTES``, with one scan of the documents for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillworks.llm.text import _LOWER, _SPACE, Texts, mix, slices

Q = 8
WINDOW = 96
#: Edits per 100 bytes of a window.
BUDGET = 10
#: Items of fewer bytes must occur as they are.
SHORT = 64
#: A band is this many diagonals; neighbours are counted together, so bands overlap.
BAND = 16
#: Bytes of benchmark text that go to the tasks at once; more is scanned in blocks.
BLOCK_BYTES = 8 << 20
#: Pairs of a text's and an item's place that are counted at once.
PAIRS = 1 << 20
_FILTER_BITS = 22
_FOLD = np.where(_SPACE, np.uint8(32), _LOWER)
_WORDLY = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


class Index(NamedTuple):
    ids: np.ndarray
    items: list[np.ndarray]
    filter: np.ndarray
    grams: np.ndarray
    at: np.ndarray
    item: np.ndarray
    place: np.ndarray
    least: np.ndarray
    short_grams: np.ndarray  # first grams of the short items, sorted, and the items of each
    short: list[list[tuple[int, bytes]]]
    tiny: dict[bytes, list[int]]


def _grams(data: np.ndarray) -> np.ndarray:
    """The q-gram at every byte, as a number."""
    n = len(data) - Q + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(Q):
        if n > 0:
            out = out << np.uint64(8) | data[k : k + n].astype(np.uint64)
    return out


def _slot(grams: np.ndarray) -> np.ndarray:
    return mix(grams) >> np.uint64(64 - _FILTER_BITS)


def budget(size: int) -> int:
    return size * BUDGET // 100


def least_shared(size: int) -> int:
    return size - Q + 1 - budget(size) * Q


def build_index(ids: list[int], texts: list[str]) -> Index:
    folded = [_FOLD[np.frombuffer(t.encode(), np.uint8)] for t in texts]
    items = [x for x in folded if len(x) >= SHORT]
    short: dict[int, list[tuple[int, bytes]]] = {}
    tiny: dict[bytes, list[int]] = {}
    for i, x in zip(ids, folded):
        x = x.tobytes().strip() if len(x) < SHORT else b""
        if len(x) >= Q:
            short.setdefault(int.from_bytes(x[:Q], "big"), []).append((i, x))
        elif x:
            tiny.setdefault(x, []).append(i)
    grams = [_grams(x) for x in items]
    flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
    place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    unique, first = np.unique(flat[order], return_index=True)
    short_grams = np.array(sorted(short), np.uint64)
    bits = np.zeros(1 << _FILTER_BITS, bool)
    bits[_slot(np.append(unique, short_grams))] = True
    return Index(
        np.array([i for i, x in zip(ids, folded) if len(x) >= SHORT], np.int64),
        items, bits, unique, np.append(first, len(flat)), item[order], place[order],
        np.array([least_shared(min(len(x), WINDOW)) for x in items], np.int64),
        short_grams, [short[g] for g in short_grams.tolist()], tiny,
    )


def banded_distance(pattern: np.ndarray, text: np.ndarray, most: int | None = None) -> int:
    """Fewest edits from ``pattern`` to any stretch of ``text``; ``most + 1`` if above ``most``.

    ``text`` is the window's place with some bytes to spare on both sides, so
    the alignment stays within the band that it spans.
    """
    n = len(text)
    step = np.arange(n + 1)
    row = np.zeros(n + 1, np.int64)
    for i, byte in enumerate(pattern, 1):
        new = np.empty(n + 1, np.int64)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (text != byte), row[1:] + 1)
        row = np.minimum.accumulate(new - step) + step
        if most is not None and row.min() > most:
            return most + 1
    return int(row.min())


def _bands(
    at: np.ndarray, slot: np.ndarray, row: np.ndarray, index: Index
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``row, item, band`` and their number of pairs, counted some pairs at a time."""
    size = index.at[slot + 1] - index.at[slot]
    upto = np.cumsum(size)
    total = int(upto[-1]) if len(upto) else 0
    # Diagonals from the longest item's length below nought, as one number with row and item.
    above = -(-int(index.place.max(initial=0)) // BAND) * BAND
    n_bands = (int(at.max(initial=0)) + above) // BAND + 1
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for begin in range(0, total, PAIRS):
        end = min(begin + PAIRS, total)
        a, b = np.searchsorted(upto, begin, "right"), np.searchsorted(upto, end - 1, "right") + 1
        hit = np.repeat(np.arange(a, b), size[a:b])[begin - (upto[a] - size[a]) :][: end - begin]
        post = np.arange(begin, end) - (upto[hit] - size[hit]) + index.at[slot[hit]]
        band = (at[hit] - index.place[post] + above) // BAND
        key, count = np.unique((row[hit] * len(index.items) + index.item[post]) * n_bands + band, return_counts=True)
        if not len(keys):
            keys, counts = key, count
            continue
        both = np.concatenate([keys, key])
        order = np.argsort(both, kind="stable")
        first = np.flatnonzero(np.diff(both[order], prepend=-1))
        keys, counts = both[order[first]], np.add.reduceat(np.concatenate([counts, count])[order], first)
    of = keys // n_bands
    return of // max(len(index.items), 1), of % max(len(index.items), 1), keys % n_bands * BAND - above, counts


def text_leaks(texts: Texts, index: Index, every: bool) -> list[tuple[int, int, int, int, int]]:
    """``(row, item, start, length, edits)`` of verified windows; one per row and item id,
    or one per row unless ``every``."""
    data = _FOLD[texts.data]
    grams = _grams(data)
    at = np.flatnonzero(index.filter[_slot(grams)])
    out, done = [], set()
    for found in _short_leaks(texts, data, at, grams[at], index):
        name = (found[0], found[1] if every else -1)
        if name not in done:
            done.add(name)
            out.append(found)
    if not len(at) or not len(index.grams):
        return out
    grams = grams[at]
    slot = np.minimum(np.searchsorted(index.grams, grams), len(index.grams) - 1)
    row = np.searchsorted(texts.at, at, "right") - 1
    good = (index.grams[slot] == grams) & (at + Q <= texts.at[row + 1])
    at, slot, row = at[good], slot[good], row[good]
    rows, item, low, count = _bands(at, slot, row, index)
    if not len(count):
        return out
    # Neighbours on a band and the one above it; texts and items are kept apart.
    near = (rows[1:] == rows[:-1]) & (item[1:] == item[:-1]) & (low[1:] == low[:-1] + BAND)
    both = count + np.append(np.where(near, count[1:], 0), 0)
    for c in np.flatnonzero(both >= index.least[item]):
        r, i = int(rows[c]), int(item[c])
        name = (r, int(index.ids[i]) if every else -1)
        if name in done:
            continue
        begin, end = int(texts.at[r]), int(texts.at[r + 1])
        found = _verify(data, begin, end, index.items[i], int(low[c]))
        if found:
            done.add(name)
            out.append((r, int(index.ids[i]), found[0] - begin, found[1], found[2]))
    return out


def _verify(data: np.ndarray, begin: int, end: int, item: np.ndarray, low: int) -> tuple[int, int, int] | None:
    """A window of the item that aligns within the two bands from diagonal ``low``."""
    size = min(len(item), WINDOW)
    most, starts = budget(size), len(item) - size + 1
    # Grams of the item that the text has within the bands: place by place, both sides sorted.
    mine = _grams(item)
    a, b = max(begin, low), min(end, low + len(item) + 2 * BAND + most)
    theirs = _grams(data[a:b])
    shared = np.zeros(len(mine) + 1, np.int64)
    order = np.argsort(theirs, kind="stable")
    theirs, places = theirs[order], order + a
    left, right = np.searchsorted(theirs, mine), np.searchsorted(theirs, mine, "right")
    for k in np.flatnonzero(right > left):
        spots = places[left[k] : right[k]] - k
        first = np.searchsorted(spots, low)
        shared[k + 1] = first < len(spots) and spots[first] < low + 2 * BAND
    upto = np.cumsum(shared)
    score = upto[np.arange(starts) + size - Q + 1] - upto[:starts]
    tried = np.zeros(starts, bool)
    for start in np.argsort(-score, kind="stable"):
        if score[start] < least_shared(size):
            return None
        if tried[start]:
            continue
        first, last = max(begin, low + start - most), min(end, low + start + size + 2 * BAND + most)
        edits = banded_distance(item[start : start + size], data[first:last]) if last - first >= size - most else size
        if edits <= most:
            return first, size, edits
        # One byte further a window needs two edits less at best.
        reach = (edits - most - 1) // 2
        tried[max(0, start - reach) : start + reach + 1] = True
    return None


def _short_leaks(
    texts: Texts, data: np.ndarray, at: np.ndarray, grams: np.ndarray, index: Index
) -> list[tuple[int, int, int, int, int]]:
    """Short items that occur as they are, between word borders; tiny ones as whole texts."""
    out: list[tuple[int, int, int, int, int]] = []
    if index.tiny:
        filled = np.append(0, np.cumsum(data != 32))
        for r in np.flatnonzero((np.diff(filled[texts.at]) > 0) & (np.diff(filled[texts.at]) < Q)):
            text = data[texts.at[r] : texts.at[r + 1]].tobytes()
            for item in index.tiny.get(text.strip(), ()):
                out.append((int(r), item, len(text) - len(text.lstrip()), len(text.strip()), 0))
    if not len(index.short_grams) or not len(at):
        return out
    place = np.minimum(np.searchsorted(index.short_grams, grams), len(index.short_grams) - 1)
    for a, k in zip(*((x[index.short_grams[place] == grams]).tolist() for x in (at, place))):
        r = int(np.searchsorted(texts.at, a, "right")) - 1
        begin, end = int(texts.at[r]), int(texts.at[r + 1])
        for item, wanted in index.short[k]:
            b = a + len(wanted)
            if b > end or data[a:b].tobytes() != wanted:
                continue
            if (a == begin or not _within(data[a - 1], data[a])) and (b == end or not _within(data[b - 1], data[b])):
                out.append((r, item, a - begin, len(wanted), 0))
    return out


def _within(left: int, right: int) -> bool:
    """Whether two neighbouring bytes may lie in one word."""
    return bool(_WORDLY[left] and _WORDLY[right])


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Index]:
    """Indexes over bounded parts of the benchmark."""
    items = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where(
        F.col("i").isNotNull() & (F.octet_length("t") > 0)
    )
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = -(-total // BLOCK_BYTES)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).orderBy("i", "t").collect()
        if rows:
            yield build_index([r[0] for r in rows], [r[1] for r in rows])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``<id_col>, item_id, start, length, edits``: a verified window per document and item.

    ``start`` is the first byte of the stretch that was aligned, ``length`` the
    bytes of the item's window.
    """
    out = None
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, item_id long, start long, length long, edits long"
    for index in _blocks(benchmark, item_col, "text"):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for texts in slices(batch.column(1)):
                    found = text_leaks(texts, shared.value, True)
                    if found:
                        row, item, start, size, edits = (np.array(x) for x in zip(*found))
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array(row + texts.first)),
                                *(pa.array(x.astype(np.int64)) for x in (item, start, size, edits)),
                            ],
                            [id_col, "item_id", "start", "length", "edits"],
                        )

        part = docs.select(id_col, text_col).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``docs`` without the rows that hold a verified window of any item."""
    names = docs.columns
    for index in _blocks(benchmark, item_col, "text"):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            at = names.index(text_col)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for texts in slices(batch.column(at)):
                    for found in text_leaks(texts, shared.value, False):
                        keep[texts.first + found[0]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
