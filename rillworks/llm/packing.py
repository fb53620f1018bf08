"""Best-fit packing with certified bin counts.

Documents become pieces of at most ``capacity`` ids. Partitions of pieces are
packed best-fit decreasing, and lower bounds from dual feasible functions say
how few sequences each partition could need. Sequences with room in partitions
above their bound, and the emptiest one of every partition, are opened again;
their pieces meet in fewer partitions and are packed anew, until one is left.

Nulls and extras: a null text is empty, so it is the end id alone; rows with a
null or repeated id are packed as rows of their own; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillworks.llm.land import land
from rillworks.llm.text import slices
from rillworks.llm.tokens import word_ids

END_ID = 1
#: Pieces that one task packs.
PART_PIECES = 100_000
#: Partitions that give their open sequences to one of the next round.
MEET = 8

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, bound long"


def token_pieces(docs: DataFrame, capacity: int, vocabulary: str) -> DataFrame:
    """Pieces of ``id, text``, each with the checksum of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            for texts in slices(batch.column(1), 4 << 20):
                at, ids = word_ids(texts, vocabulary)
                n = len(at) - 1
                # The end id follows the ids of each text.
                ids, at = np.insert(ids, at[1:], END_ID), at + np.arange(n + 1)
                pieces = -(-np.diff(at) // capacity)
                row = np.repeat(np.arange(n), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, np.diff(at)[row] - start)
                raw, begin = memoryview(ids.astype("<u4").tobytes()), 4 * (at[row] + start)
                sums = [zlib.crc32(raw[a : a + 4 * m]) for a, m in zip(begin.tolist(), length.tolist())]
                doc_id = batch.column(0).take(pa.array(texts.first + row))
                columns = [doc_id, pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, sums))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing uses fewer bins: the best of several dual feasible functions."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    # Sizes above capacity - a count as full, those below a as nothing.
    n_above = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])
    s_above = np.concatenate([np.cumsum((count * size)[::-1])[::-1], [0]])
    a = np.arange(capacity // 2 + 1)
    full = n_above[capacity - a + 1]
    middle = s_above[a] - s_above[capacity - a + 1]
    best = max(best, int((full - (-middle // capacity)).max()))
    # Rounding to multiples of 1 / k where (k + 1) * size is not whole.
    for k in range(1, 64):
        up = (k + 1) * size
        whole = up % capacity == 0
        value = np.where(whole, k * size, (up // capacity) * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bin, offset)`` of each length, given in decreasing order, and the room left per bin."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, left = 0, []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            chosen = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, chosen = capacity, len(left)
            left.append(capacity)
        bins[i], offsets[i] = chosen, capacity - room
        room -= n
        left[chosen] = room
        if not rooms[room]:
            mask |= 1 << room
        rooms[room].append(chosen)
    return bins, offsets, np.array(left, np.int64)


def _pack(pieces: DataFrame, parts: int, capacity: int, round_no: int, last: bool) -> DataFrame:
    """One round; ``sequence_id`` is null for pieces of opened sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=None) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = table.column("length").to_numpy()
        bins, offsets, left = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        opened = np.zeros(len(left), bool)
        if not last:
            if len(left) > bound:
                opened |= left >= capacity // 64
            opened[np.argmax(left)] = True
        place = TaskContext.get().partitionId()
        name = (round_no << 56) + (place << 24) + bins
        out = table.append_column("sequence_id", pa.array(name, pa.int64(), mask=opened[bins]))
        out = out.append_column("offset", pa.array(offsets, pa.int64()))
        out = out.append_column("bound", pa.array(np.full(len(bins), bound), pa.int64()))
        yield from out.to_batches(max_chunksize=10_000)

    # By place in the written table, so that equal rows are dealt like any others.
    placed = pieces.withColumn("row", F.monotonically_increasing_id())
    return placed.repartition(parts, F.xxhash64("row")).drop("row").mapInArrow(run, PACKED)


def pack_documents(
    docs: DataFrame,
    capacity: int = 4096,
    vocabulary: str = "word_bpe_49k.json",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    waiting = land(token_pieces(texts, capacity, vocabulary), "pieces")
    closed, parts, round_no = None, None, 0
    while True:
        n = waiting.count()
        wanted = max(1, -(-n // PART_PIECES))
        parts = wanted if parts is None else min(wanted, -(-parts // MEET))
        # The last task may hold more than a part only if nothing else shrinks it.
        parts = max(parts, -(-n // (4 * PART_PIECES)), 1)
        last = parts == 1 or round_no > 60
        done = land(_pack(waiting, parts, capacity, round_no, last), "packed")
        settled = done.where("sequence_id is not null").drop("bound")
        closed = settled if closed is None else closed.unionByName(settled)
        if last:
            return closed
        waiting = done.where("sequence_id is null").select(*waiting.columns)
        round_no += 1
