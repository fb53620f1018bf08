"""Repeated byte strings found with suffix arrays over shards.

Every byte covered by a string of ``LENGTH`` bytes that also starts somewhere
else, in the same or another text, is removed; all strings are judged on the
input.

1. Each text marks anchors: the smallest hash of ``ANCHOR`` bytes in every
   window of ``LENGTH`` bytes. Equal windows have equal anchors, so only windows
   of anchors that occur twice can be repeats.
2. The windows of such an anchor, one stretch of text, go to a shard by the
   anchor. Equal stretches are one there, all of whose windows are repeats. Of
   the different ones a shard builds the suffix array by Larsson-Sadakane
   refinement (only groups that are not settled are sorted again, by the rank
   half a length on), common prefixes by Kasai's rule, and takes from them the
   strings that start at two places.
3. An anchor at very many places is spread over several shards. Those also send
   one row per distinct string, and the sorted rows of all shards are merged by
   binary search.

Equal texts are one text with a number of copies; where they are long enough,
all of their bytes are repeats. Nulls and extras: a null text is empty; rows
with null or repeated ids are documents of their own; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillworks.llm.land import land
from rillworks.llm.text import prefix_hashes, slices, spans

LENGTH = 200
ANCHOR = 32
#: Places of an anchor that one shard takes; more are spread.
HOT_PLACES = 2_000
#: Bytes of stretches per shard, about.
SHARD_BYTES = 384 << 10
#: Starts of windows hashed at once.
_SEGMENT = 128 << 10
#: Positions up to 2^21 let a sort carry two ranks and a position in one number.
_PACK = 21
_FIRST_BITS = 42
#: Strings of spread anchors that meet in one task, about.
RANGE_STRINGS = 1 << 14


def anchors(
    data: np.ndarray, at: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all texts ``data[at[i]:at[i + 1]]``, in order.

    ``(place, hash, first, last)``: the first and last start of the windows,
    which follow each other, that the anchor stands for.
    """
    span = length - anchor + 1
    found: list[list[np.ndarray]] = [[], [], [], []]
    for seg in range(0, max(len(data) - length + 1, 0), _SEGMENT):
        part = data[seg : seg + _SEGMENT + length - 1]
        n = len(part) - length + 1
        start = np.arange(len(part) - anchor + 1)
        value = spans(prefix_hashes(part), start, start + anchor)
        low = (value >> np.uint64(_PACK) << np.uint64(_PACK)) | start.astype(np.uint64)
        width = 1
        while width * 2 <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[:n], low[span - width : span - width + n])
        where = np.arange(seg, seg + n)
        end = at[np.searchsorted(at, where, "right")]
        inside = np.flatnonzero(where + length <= end)
        if not len(inside):
            continue
        picked = (low[inside] & np.uint64((1 << _PACK) - 1)).astype(np.int64)
        head = np.flatnonzero(np.append(True, picked[1:] != picked[:-1]))
        tail = np.append(head[1:], len(picked)) - 1
        for column, x in zip(found, (picked[head] + seg, value[picked[head]], inside[head] + seg, inside[tail] + seg)):
            column.append(x)
    if not found[0]:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none
    place, value, first, last = (np.concatenate(x) for x in found)
    # An anchor that two segments have found is one.
    head = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    tail = np.append(head[1:], len(place)) - 1
    return place[head], value[head], first[head], last[tail]


def suffix_array(data: np.ndarray, end: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``(order, group)``: suffixes of the stretches, sorted by their first ``depth`` bytes.

    ``end[i]`` is where the stretch of byte ``i`` ends; no suffix goes past it.
    ``group`` numbers the suffixes that agree so far by their first place.
    """
    n = len(data)
    bits = np.uint64(_PACK)
    packed = n < 1 << _PACK
    each = np.arange(n, dtype=np.uint64)
    # A byte counts by its rank among those that occur, from 1; an end counts as 0.
    used = np.bincount(data, minlength=256) > 0
    symbol = (np.cumsum(used) * used).astype(np.uint64)[data]
    kinds = int(used.sum()) + 1
    half = int(_FIRST_BITS / np.log2(max(kinds, 2)))
    key = np.zeros(n, np.uint64)
    for k in range(half):
        byte = np.zeros(n, np.uint64)
        byte[: max(n - k, 0)] = symbol[k:]
        byte[np.arange(n) + k >= end] = 0
        key = key * np.uint64(kinds) + byte
    if packed:
        both = np.sort(key << bits | each)
        order = (both & np.uint64((1 << _PACK) - 1)).astype(np.int64)
    else:
        order = np.argsort(key, kind="stable")
    ordered = key[order]
    head = np.append(True, ordered[1:] != ordered[:-1]) if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    first = np.flatnonzero(head)
    group = first[np.cumsum(head) - 1] if n else first
    rank[order] = group
    half = min(half, depth)
    while half < depth:
        step = min(half, depth - half)
        # Groups of one are settled; only the others are sorted again.
        size = np.diff(np.append(np.flatnonzero(head), n))
        open_ = np.repeat(size > 1, size)
        slots = np.flatnonzero(open_)
        if not len(slots):
            break
        suffix = order[slots]
        ahead = suffix + step
        inside = ahead < end[suffix]
        second = np.zeros(len(suffix), np.int64)
        second[inside] = rank[ahead[inside]] + 1
        if packed:
            both = rank[suffix].astype(np.uint64) << np.uint64(2 * _PACK) | second.astype(np.uint64) << bits | suffix.astype(np.uint64)
            both = np.sort(both)
            suffix = (both & np.uint64((1 << _PACK) - 1)).astype(np.int64)
            pair = both >> bits
        else:
            resort = np.lexsort((suffix, second, rank[suffix]))
            suffix, second = suffix[resort], second[resort]
            pair = rank[suffix].astype(np.uint64) << np.uint64(32) | second.astype(np.uint64)
        order[slots] = suffix
        head[slots] = np.append(True, pair[1:] != pair[:-1])
        first = np.flatnonzero(head)
        group = first[np.cumsum(head) - 1]
        rank[order[slots]] = group[slots]
        half += step
    return order, group


def common_prefixes(data: np.ndarray, end: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in ``order``, up to ``most``.

    Kasai's rule: where a suffix and its neighbour follow equal bytes, the pair
    one byte earlier shares one byte more. Only pairs without that are compared.
    """
    n = len(order)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    prior = np.maximum(place - 1, 0)
    # The pair one byte earlier is this pair moved back, so its value settles this one.
    carried = (
        (place > 0)
        & (before > 0)
        & (end[prior] == end)
        & (before[prior] == before - 1)
        & (before[prior] >= 0)
    )
    carried[carried] = end[before[carried] - 1] == end[before[carried]]
    carried[carried] = data[place[carried] - 1] == data[before[carried] - 1]
    fresh = np.flatnonzero(~carried & (before >= 0))
    other = before[fresh]
    room = np.minimum(end[fresh] - fresh, end[other] - other)
    shared = np.zeros(len(fresh), np.int64)
    going = np.arange(len(fresh))
    k = 0
    while len(going := going[room[going] > k]):
        going = going[data[fresh[going] + k] == data[other[going] + k]]
        k += 1
        shared[going] = k
    value = np.zeros(n, np.int64)
    value[fresh] = shared
    start = np.maximum.accumulate(np.where(carried, 0, place))
    value[carried] = np.maximum(value[start[carried]] - (place - start)[carried], 0)
    return np.minimum(value[order], most)


def _repeats(data: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, one_of_each, is_repeat)``: starts of strings at two places; distinct strings."""
    order, _ = suffix_array(data, end, length)
    shared = common_prefixes(data, end, order, length)
    usable = end[order] - order >= length
    order, shared = order[usable], shared[usable]
    # Between usable suffixes lie only shorter ones; a shared prefix of ``length``
    # with the direct neighbour is one with the usable neighbour.
    head = np.append(True, shared[1:] < length) if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(head)
    size = np.diff(np.append(first, len(order)))
    return np.sort(order[np.repeat(size > 1, size)]), order[first], size > 1


_FOUND = "of long, start long, stop long, w1 long, w2 long"


def _search_shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        anchor = table.column("anchor").to_pylist()
        of, start = table.column("of").to_numpy(), table.column("start").to_numpy()
        spread = table.column("spread")[0].as_py()
        # Equal stretches of an anchor are one; several places make all its windows repeats.
        number: dict[tuple[int, bytes], int] = {}
        which = np.array([number.setdefault(x, len(number)) for x in zip(anchor, table.column("body").to_pylist())], np.int64)
        members = np.bincount(which)
        kinds = np.unique([a for a, _ in number], return_inverse=True, return_counts=True)
        several = kinds[2][kinds[1]] > 1
        bodies = [body for _, body in number]
        whole = members > 1
        # Anchors with one stretch have nothing left to compare, unless other shards do.
        compared = np.flatnonzero(several | spread)
        data = np.frombuffer(b"".join(bodies[i] for i in compared), np.uint8)
        size = np.array([len(bodies[i]) for i in compared], np.int64)
        begin = np.cumsum(size) - size
        end = np.repeat(begin + size, size)
        own = np.repeat(compared, size)
        starts, one, repeat = _repeats(data, end, length)
        repeat = repeat | whole[own[one]]
        at = {}
        for i, a, b in zip(compared.tolist(), np.searchsorted(starts, begin), np.searchsorted(starts, begin + size)):
            at[i] = starts[a:b] - begin[np.searchsorted(compared, i)]
        out: tuple[list, list, list] = ([], [], [])
        for row, (i, o, s) in enumerate(zip(which.tolist(), of.tolist(), start.tolist())):
            if whole[i]:
                runs = [(0, len(bodies[i]))]
            else:
                mine = at.get(i, ())
                if not len(mine):
                    continue
                cut = np.flatnonzero(np.diff(mine) != 1)
                runs = zip(mine[np.append(0, cut + 1)].tolist(), (mine[np.append(cut, len(mine) - 1)] + length).tolist())
            for a, b in runs:
                for column, x in zip(out, (o, s + a, s + b)):
                    column.append(x)
        kind = pa.int64()
        none = pa.nulls(len(out[0]), kind)
        found = pa.table([*(pa.array(c, kind) for c in out), none, none], ["of", "start", "stop", "w1", "w2"])
        if spread:
            holder = np.full(len(bodies), -1)
            holder[which[::-1]] = np.arange(len(which))[::-1]
            row = holder[own[one]]
            place = start[row] + one - begin[np.searchsorted(compared, own[one])] if len(one) else one
            prefix, other = prefix_hashes(data), prefix_hashes(data ^ np.uint8(0x5B))
            more = pa.table(
                {
                    "of": pa.array(of[row], kind, mask=repeat),
                    "start": pa.array(place, kind, mask=repeat),
                    "stop": pa.array(place + length, kind, mask=repeat),
                    "w1": pa.array(spans(prefix, one, one + length).view(np.int64)),
                    "w2": pa.array(spans(other, one, one + length).view(np.int64)),
                }
            )
            found = pa.concat_tables([found, more])
        return found

    return run


def _merge_shards(table: pa.Table) -> pa.Table:
    """Strings that several shards hold; each shard sent a distinct string once."""
    keys = np.array(list(zip(table.column("w1").to_pylist(), table.column("w2").to_pylist())), np.dtype([("a", "i8"), ("b", "i8")]))
    order = np.argsort(keys, order=("a", "b"))
    table, keys = table.take(pa.array(order)), keys[order]
    edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    distinct = keys[edge]
    left = np.searchsorted(distinct, keys)  # binary search in the merged run
    known = table.column("of").is_valid().to_numpy()
    # A string of two shards is a repeat; one that a shard saw twice it has settled.
    held = np.bincount(left, minlength=len(edge))[left] > 1
    table = table.filter(pa.array(held & known))
    return table.select(["of", "start", "stop"])


def _short_name(text: Column) -> Column:
    """The number that names a text unless another text has it too."""
    return F.xxhash64(text)


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def text_names(docs: DataFrame, text_col: str) -> Callable[[Column], Column]:
    """How to name each text of a table by a number that no other text of it has.

    Texts whose hash belongs to two of them get one of their digest, in turns until all
    differ. Of ``n`` texts about ``n * n / 2**65`` hashes are met twice; these alone go
    to the driver.
    """
    seen = land(
        docs.select(_short_name(F.col(text_col)).alias("of"), _digest(F.col(text_col)).alias("same")).distinct(), "names"
    )
    taken: list[list[int]] = []

    def name(text: Column) -> Column:
        of = _short_name(text)
        for turn, twice in enumerate(taken):
            of = F.when(of.isin(twice), F.xxhash64(_digest(text), F.lit(turn))).otherwise(of)
        return of

    of = F.col("of")
    while True:
        named = seen.withColumn("of", of)
        twice = [r["of"] for r in named.groupBy("of").agg(F.count("*").alias("n")).where("n > 1").select("of").collect()]
        if not twice:
            return name
        of = F.when(of.isin(twice), F.xxhash64("same", F.lit(len(taken)))).otherwise(of)
        taken.append(twice)


def removed_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    name: Callable[[Column], Column] = _short_name,
) -> tuple[DataFrame, DataFrame]:
    """``texts(of, text)`` that may hold repeats, and their covered ``runs(of, start, stop)``.

    ``name``: from :func:`text_names`, so that no two texts share their ``of``.
    """
    rows = docs.where(F.octet_length(text_col) >= length).select(
        name(F.col(text_col)).alias("of"),
        F.col(text_col).alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("row"),
    )

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(1)):
                n = len(texts.at) - 1
                place, value, first, last = anchors(texts.data, texts.at, length)
                row = np.searchsorted(texts.at, place, "right") - 1
                cut = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                # First start, and how many more follow, as one number.
                span = (first - texts.at[row] << 8) | (last - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, n),
                        pa.ListArray.from_arrays(cut, value.view(np.int64)),
                        pa.ListArray.from_arrays(cut, span),
                    ],
                    ["of", "anchor", "span"],
                )

    marked = land(rows.select("of", "text").mapInArrow(mark, "of long, anchor array<long>, span array<long>"), "anchors")
    flat = marked.select("of", F.explode(F.arrays_zip("anchor", "span")).alias("x")).select("of", "x.anchor", "x.span")
    # Written first, so that the join below can split the places of a hot anchor.
    met = land(flat.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "shared-anchors")
    # Copies of a text count as places here; among candidates below a text is once.
    kept = flat.join(met, "anchor").groupBy("of").agg(
        F.collect_set(F.struct("span", "anchor", "n")).alias("found")
    )
    first = rows.groupBy("of").agg(F.min("row").alias("row"))
    texts = land(
        kept.join(first, "of").join(rows, ["of", "row"]).dropDuplicates(["of", "row"]).select("of", "text", "found"),
        "surroundings",
    )
    total = texts.agg(F.coalesce(F.sum(F.size("found")), F.lit(0))).first()[0] * (2 * length - ANCHOR)
    shards = max(1, -(-total // SHARD_BYTES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, text, found in zip(*(column.to_pylist() for column in batch.columns)):
                data = text.encode()
                rows: list[tuple] = []
                for x in found:
                    start, more = x["span"] >> 8, x["span"] & 255
                    spread = x["n"] > HOT_PLACES
                    if spread:
                        salt = (of ^ start * 0x9E3779B1) % -(-x["n"] // HOT_PLACES)
                        shard = f"{x['anchor']}:{salt}"
                    else:
                        shard = str(x["anchor"] % shards)
                    rows.append((shard, spread, x["anchor"], of, start, data[start : start + more + length]))
                if rows:
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(sent_schema.names, r)) for r in rows], schema=sent_schema
                    )

    sent_schema = pa.schema(
        [("shard", pa.string()), ("spread", pa.bool_()), ("anchor", pa.int64()), ("of", pa.int64()), ("start", pa.int64()), ("body", pa.binary())]
    )
    sent = texts.mapInArrow(send, "shard string, spread boolean, anchor long, of long, start long, body binary")
    found = land(sent.groupBy("shard").applyInArrow(_search_shard(length), _FOUND), "repeats")
    # Strings of spread anchors meet by hash, in so many parts that each stays small.
    ranges = max(1, found.where("w1 is not null").count() // RANGE_STRINGS)
    crossed = (
        found.where("w1 is not null")
        .withColumn("range", F.pmod(F.col("w1"), F.lit(ranges)))
        .groupBy("range")
        .applyInArrow(_merge_shards, "of long, start long, stop long")
    )
    runs = found.where("w1 is null").select("of", "start", "stop").unionByName(crossed)
    return texts.select("of", "text"), runs


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``<id_col>, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``."""
    name = text_names(docs, text_col)
    base = land(
        docs.select(
            F.col(id_col),
            name(F.col(text_col)).alias("of"),
            _digest(F.col(text_col)).alias("same"),
            F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
            F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("whole_sha256"),
        ),
        "texts",
    )
    texts, runs = removed_runs(docs, id_col, text_col, length, name)
    gone = runs.groupBy("of").agg(F.collect_set(F.struct("start", "stop")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, found in zip((t.as_py() for t in batch.column(1)), (r.as_py() for r in batch.column(2))):
                data = text.encode()
                kept, stop, n_spans, removed = hashlib.sha256(), 0, 0, 0
                for run in sorted((r["start"], r["stop"]) for r in found):
                    if run[0] > stop or not n_spans:
                        kept.update(data[stop : run[0]])
                        n_spans += 1
                        removed += run[1] - run[0]
                        stop = run[1]
                    elif run[1] > stop:
                        removed += run[1] - stop
                        stop = run[1]
                kept.update(data[stop:])
                rows.append((removed, n_spans, kept.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.string()),
                ],
                ["of", "removed", "spans", "sha"],
            )

    changed = texts.join(gone, "of").select("of", "text", "runs").mapInArrow(
        cut, "of long, removed long, spans long, sha string"
    )
    # Written first, so that the join below can split a text of very many copies.
    copies = land(base.groupBy("same").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")
    rows = base.join(copies, "same", "left").join(changed, "of", "left")
    whole = F.col("copies").isNotNull() & (F.col("n_bytes") >= length)
    zero = F.lit(0).cast("long")
    return rows.select(
        id_col,
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", zero)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("spans", zero)).alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "whole_sha256")).alias("kept_sha256"),
    )
