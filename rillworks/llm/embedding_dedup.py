"""Embedding near-duplicates by cross-polytope hashing.

Vectors are turned by pseudo-random rotations (three rounds of sign flips and a
fast Hadamard transform); the largest coordinate and its sign name the nearest
vertex of the cross-polytope. A table's bucket joins the vertices of several
rotations; every vector also enters the buckets with one vertex exchanged for
the runner-up. Pairs that share a bucket are verified by their cosine in double
precision, and each pair counts in its first common bucket only. Buckets above
a size are cut into blocks that meet in pairs, so a task stays bounded.

Equal vectors are one class with a number of copies. Nulls and extras: a vector
that is null, empty or zero or holds a null or a component that is not finite
links with nothing; vectors of different lengths do not link; a null id links
with nothing, has no component and is not kept. Repeated ids are vectors of
their own that share a component. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillworks.llm.land import components, land, release

#: Vectors of one bucket that one task compares with each other or with as many.
BLOCK = 1024
#: Bucket entries that one task holds, about.
TASK_ENTRIES = 20_000
#: And their bytes.
TASK_BYTES = 16 << 20
#: Vectors in a bucket, about, from which a further rotation parts them: comparing some
#: hundred costs less than the tables that a rotation adds.
BUCKET = 256
#: Chance to miss a pair at the least cosine, by which tables are counted.
MISS = 1e-4
_SEED = 20240301
#: Components up to which a product is faster than the transform.
_SHORT = 256


def tables_for(n: int, size: int, least: float) -> tuple[int, int]:
    """``(tables, rotations per table)``: buckets grow with ``n``, tables with them."""
    vertices = 2 * _padded(size)
    turns = max(2, math.ceil(math.log(max(n, 2) / BUCKET, vertices)))
    apart = 2 - 2 * least
    # Known collision rate of cross-polytope hashing, with its lower-order loss.
    same = 0.75 * math.exp(-apart / (4 - apart) * math.log(_padded(size)))
    hit = same**turns * (1 + 0.25 * turns)
    return max(4, math.ceil(math.log(MISS) / math.log(1 - min(hit, 0.99)))), turns


def _padded(size: int) -> int:
    return 1 << max(1, (size - 1).bit_length())


def _turned(x: np.ndarray, table: int, turn: int) -> np.ndarray:
    """Sign flips and a Hadamard transform, three times, over padded rows."""
    width = _padded(x.shape[1])
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x
    signs = np.random.default_rng([_SEED, table, turn, width]).integers(0, 2, (3, width)) * 2 - 1
    for flips in signs:
        y *= flips
        h = 1
        while h < width:
            y = y.reshape(len(x), -1, 2, h)
            y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2)
            h *= 2
        y = y.reshape(len(x), width)
    return y


@lru_cache(maxsize=256)
def _matrix(size: int, table: int, turn: int) -> np.ndarray:
    return _turned(np.eye(size), table, turn)


def rotate(x: np.ndarray, table: int, turn: int) -> np.ndarray:
    """Rows turned; short ones by one product with what the turn makes of the unit vectors."""
    return x @ _matrix(x.shape[1], table, turn) if x.shape[1] <= _SHORT else _turned(x, table, turn)


def vertices(x: np.ndarray, tables: int, turns: int) -> np.ndarray:
    """By row, table and rotation the nearest vertex and the runner-up."""
    out = np.empty((len(x), tables, turns, 2), _number_kind(x.shape[1]))
    each = np.arange(len(x))
    for t in range(tables):
        for k in range(turns):
            y = rotate(x, t, k)
            size = np.abs(y)
            for place in range(2):
                top = size.argmax(1)
                out[:, t, k, place] = 2 * top + (y[each, top] > 0)
                size[each, top] = -1
    return out


def _number_kind(size: int) -> str:
    """The least kind of number that tells all vertices apart."""
    return next(kind for kind, bits in (("u1", 8), ("<u2", 16), ("<u4", 32)) if 2 * _padded(size) <= 1 << bits)


def numbers(found: np.ndarray, size: int) -> np.ndarray:
    """Bucket numbers by row and table: its own, and those with one runner-up."""
    _, tables, turns, _ = found.shape
    out = np.empty((len(found), tables, 1 + turns), np.int64)
    for probe in range(1 + turns):
        number = np.broadcast_to(np.arange(tables), out.shape[:2])
        for k in range(turns):
            number = number * (2 * _padded(size)) + found[:, :, k, int(probe == k + 1)]
        out[:, :, probe] = number
    return out


def buckets(x: np.ndarray, tables: int, turns: int) -> np.ndarray:
    """Bucket numbers of each row: per table its own and those with one runner-up."""
    return numbers(vertices(x, tables, turns), x.shape[1]).reshape(len(x), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows, none of them zero, scaled to length one in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _classes(vectors: DataFrame, kind: str) -> DataFrame:
    """``id, key, size, raw``: key names equal vectors; nulls where a vector does not count.

    ``raw``: the components as they came, as bytes of ``kind``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            length = np.asarray(pc.list_value_length(column).fill_null(0)).astype(np.int64)
            values = pc.list_flatten(column).cast(pa.float64())
            stop = np.cumsum(length)
            fine = np.append(0, np.cumsum(np.isfinite(x := values.fill_null(np.nan).to_numpy(zero_copy_only=False))))
            some = np.append(0, np.cumsum(np.nan_to_num(x) != 0))
            good = (fine[stop] - fine[stop - length] == length) & (some[stop] > some[stop - length])
            raw = [x[b - n : b].astype(kind).tobytes() if ok else None for ok, b, n in zip(good, stop, length)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([b and hashlib.blake2b(b, digest_size=16).digest() for b in raw], pa.binary()),
                    pa.array(length, pa.int32(), mask=~good),
                    pa.array(raw, pa.binary()),
                ],
                ["id", "key", "size", "raw"],
            )

    return vectors.mapInArrow(run, "id long, key binary, size int, raw binary")


def _body(kind: str, size: int, tables: int, turns: int) -> np.dtype:
    """What travels of a class to each of its buckets."""
    return np.dtype(
        [
            ("node", "<i8"), ("copies", "<i8"), ("key", "V16"),
            ("vertices", _number_kind(size), (tables, turns, 2)), ("raw", kind, (size,)),
        ]
    )


def _fixed(column: pa.Array | pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    """Values of ``kind`` of a column of bytes without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset]
    return np.frombuffer(column.buffers()[2], kind, len(column), at)


def _hashed(classes: DataFrame, kind: str, size: int, tables: int, turns: int) -> DataFrame:
    """``buckets, body`` of each class; its vertices are found here only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            body = np.empty(batch.num_rows, _body(kind, size, tables, turns))
            body["node"], body["copies"] = batch.column("node"), batch.column("copies")
            body["key"] = _fixed(batch.column("key"), np.dtype("V16"))
            body["raw"] = _fixed(batch.column("raw"), np.dtype((kind, (size,))))
            body["vertices"] = vertices(_unit(body["raw"]), tables, turns)
            number = numbers(body["vertices"], size).reshape(len(body), -1)
            listed = pa.ListArray.from_arrays(np.arange(len(body) + 1, dtype=np.int32) * number.shape[1], number.ravel())
            raw = body.tobytes()
            whole = np.arange(len(body) + 1, dtype=np.int64) * body.itemsize
            bodies = pa.Array.from_buffers(pa.large_binary(), len(body), [None, pa.py_buffer(whole), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([listed, bodies.cast(pa.binary())], ["buckets", "body"])

    rows = classes.select("node", "key", "copies", "raw").mapInArrow(run, "buckets array<long>, body binary")
    return land(rows, "hashed")


def _near(x: np.ndarray, y: np.ndarray, least: float, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``left`` and ``right`` with a cosine of at least ``least``.

    ``x`` has the units in double, ``y`` in single precision: single precision settles
    what it can, double precision the pairs at the threshold.
    """
    close = (x.shape[1] + 8) * 2.0**-23
    dots = y[left] @ y[right].T
    i, j = np.nonzero(dots >= least - close)
    edge = np.flatnonzero(dots[i, j] < least + close)
    i, j = left[i], right[j]
    keep = np.ones(len(i), bool)
    keep[edge] = (x[i[edge]] * x[j[edge]]).sum(1) >= least
    return i[keep], j[keep]


def _verified(parts: DataFrame, kind: str, size: int, tables: int, turns: int, least: float) -> DataFrame:
    """``node, key, links, low`` of classes with links inside one task's buckets."""

    def is_first(bucket: int, found: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether a pair has no common bucket before this one, so that it counts here."""
        out = np.zeros(len(i), bool)
        table = bucket // (2 * _padded(size)) ** turns
        for a in range(0, len(i), 4096):
            p, q = found[i[a : a + 4096]], found[j[a : a + 4096]]
            # Most pairs are told by their own buckets of the tables before.
            left = np.flatnonzero(~(p[:, :table, :, 0] == q[:, :table, :, 0]).all(2).any(1))
            p, q = (numbers(v[left, : table + 1], size) for v in (p, q))
            common = (p[:, :, :, None] == q[:, :, None, :]).any(3)
            out[a + left] = np.where(common, p, np.iinfo(np.int64).max).min((1, 2)) == bucket
        return out

    def run(table: pa.Table) -> pa.Table:
        b, p, q, own = (table.column(c).to_numpy() for c in ("bucket", "p", "q", "own"))
        order = np.lexsort((own, q, p, b))
        b, p, q, own = b[order], p[order], q[order], own[order]
        body = _fixed(table.column("body"), _body(kind, size, tables, turns))[order]
        node, copies, found = body["node"], body["copies"], body["vertices"]
        x = _unit(body["raw"])
        y = x.astype(np.float32)
        new = np.flatnonzero(np.append(True, (b[1:] != b[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])))
        stop = np.append(new[1:], len(b))
        links, low = np.zeros(len(b), np.int64), node.copy()
        for s, e in zip(new[stop - new > 1], stop[stop - new > 1]):
            rows = np.arange(s, e)
            cross = p[s] != q[s]
            left = rows[own[s:e] == p[s]] if cross else rows
            right = rows[own[s:e] == q[s]] if cross else rows
            i, j = _near(x, y, least, left, right)
            if not cross:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            first = is_first(int(b[s]), found, i, j)
            np.add.at(links, i[first], copies[j[first]])
            np.add.at(links, j[first], copies[i[first]])
            while True:  # smallest node reachable within the bucket
                least_of = np.minimum(low[i], low[j])
                if (low[i] == least_of).all() and (low[j] == least_of).all():
                    break
                np.minimum.at(low, i, least_of)
                np.minimum.at(low, j, least_of)
        kept = np.flatnonzero((links > 0) | (low != node))
        keys = body["key"][kept].tobytes()
        return pa.table(
            {
                "node": node[kept],
                "key": pa.array([keys[k : k + 16] for k in range(0, len(keys), 16)], pa.binary()),
                "links": links[kept],
                "low": low[kept],
            }
        )

    return parts.groupBy("task").applyInArrow(run, "node long, key binary, links long, low long")


def link_vectors(
    vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``<id_col>, n_links, component_id, kept`` per row of ``vectors``."""
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    kind = "<f4" if dict(vectors.dtypes)[vector_col] == "array<float>" else "<f8"
    rows = land(_classes(source, kind), "vectors")
    counted = rows.where("id is not null and key is not null")
    classes = land(
        counted.groupBy("key", "size").agg(
            F.min("id").alias("node"), F.count("*").alias("copies"), F.first("raw").alias("raw")
        ),
        "classes",
    )
    spark, found = vectors.sparkSession, None
    # Lengths of vectors are a few; each has tables of its own.
    for size, n in classes.groupBy("size").count().orderBy("size").collect():
        tables, turns = tables_for(n, size, least)
        hashed = _hashed(classes.where(F.col("size") == size), kind, size, tables, turns)
        entries = hashed.select(F.explode("buckets").alias("bucket"), "body")
        filled = entries.groupBy("bucket").agg(F.count("*").alias("n"))
        crowded = land(filled.where(F.col("n") > BLOCK).select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "crowded")
        per = tables * (1 + turns)
        tasks = max(1, n * per // TASK_ENTRIES, n * per * _body(kind, size, tables, turns).itemsize // TASK_BYTES)
        cut = (
            # Bodies travel once; of crowded buckets once for each block they meet.
            entries.join(crowded, "bucket", "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .withColumn("own", F.pmod(F.xxhash64("body"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("p", F.least("own", "other"))
            .withColumn("q", F.greatest("own", "other"))
            .withColumn("task", F.pmod(F.xxhash64("bucket", "p", "q"), F.lit(tasks)))
            .select("task", "bucket", "p", "q", "own", "body")
            .repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tasks // 4)), "task")
        )
        part = land(_verified(cut, kind, size, tables, turns, least), "verified")
        release(hashed)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(
            F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
            F.col("id").isNotNull().alias("kept"),
        )
    linked = components(found.select(F.col("node").alias("a"), F.col("low").alias("b")), "vector-links")
    degree = found.groupBy("key").agg(F.sum("links").alias("links"))
    known = (
        classes.join(degree, "key", "left")
        .join(linked, "node", "left")
        .select(
            "key",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    named = rows.select("id", F.when(F.col("id").isNotNull(), F.col("key")).alias("key")).join(known, "key", "left")
    component = F.coalesce("component_id", "id")
    return named.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
