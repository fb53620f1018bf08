"""N-gram Jaccard join with a prefix tree: documents of almost the same word runs.

A document's set holds the hashes of its distinct runs of ``width`` words (a
shorter document is one run; one without words has an empty set and links with
nothing). Two documents link when ``100 * |A & B| >= percent * |A | B|``.

1. Sets are put in one global order, that of their hashes, and equal sets
   become one class.
2. A link needs a number of shared runs among the first ones of both sets, so
   only a prefix of each set is shuffled; documents with too few shared runs
   there are done.
3. Partners have sizes within ``percent``, so what is left is taken apart by
   classes of size, and of the runs in a prefix the most frequent ones that a
   link can do without are set aside. Documents are grouped by the other shared
   runs. Each group's sets become a prefix
   tree; a set walks it level by level, nodes share the overlap counted above
   them, and subtrees that cannot reach the needed overlap by their lengths, or
   whose sets are linked already, are cut off. Groups above a size are cut into
   blocks that meet in pairs, so a task stays bounded.

Nulls and extras: a null text is empty; a null id is kept with a null component.
Rows of one id count as one document with several texts: all get its component.
Other columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillworks.llm.land import broadcast_below, components, land, release
from rillworks.llm.text import shingles, slices, words

#: Prefixes must share one run more for so many runs of the set.
SHARED_PER = 12
#: Documents up to which their ids go to all tasks; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Runs in one block of a group; a task holds two blocks at most.
BLOCK_RUNS = 500_000

SETS = "id long, n_shingles long, set_key binary, head array<long>"


def _least(n: int | np.ndarray, percent: int):
    """Smallest overlap that a set of ``n`` runs has with any partner."""
    return -(-n * percent // 100)


def _shared(n: int | np.ndarray):
    """Runs that two prefixes must share; longer prefixes share more."""
    return 1 + n // SHARED_PER


def _text_sets(texts, width: int) -> Iterator[np.ndarray]:
    n = len(texts.at) - 1
    hashes, row = shingles(words(texts), n, width)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[new], row[new]
    cut = np.searchsorted(row, np.arange(n + 1))
    for i in range(n):
        yield hashes[cut[i] : cut[i + 1]]


def text_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``id, n_shingles, set_key, head`` of ``id, text``: head is the sorted prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for texts in slices(batch.column(1)):
                sizes, keys, heads = [], [], []
                for found in _text_sets(texts, width):
                    n = len(found)
                    sizes.append(n)
                    keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if n else None)
                    heads.append(found[: n - _least(n, percent) + _shared(n)].view(np.int64) if n else found.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(texts.first, len(sizes)),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.ListArray.from_arrays(
                            np.cumsum([0, *map(len, heads)]).astype(np.int32),
                            np.concatenate(heads) if heads else np.zeros(0, np.int64),
                        ),
                    ],
                    ["id", "n_shingles", "set_key", "head"],
                )

    return docs.mapInArrow(run, SETS)


def _whole_sets(docs: DataFrame, width: int) -> DataFrame:
    """``node, part, runs`` of ``node, part, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(2)):
                sets = [s.view(np.int64) for s in _text_sets(texts, width)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(sets)),
                        batch.column(1).slice(texts.first, len(sets)),
                        pa.ListArray.from_arrays(
                            np.cumsum([0, *map(len, sets)]).astype(np.int32), np.concatenate(sets)
                        ),
                    ],
                    ["node", "part", "runs"],
                )

    return docs.mapInArrow(run, "node long, part string, runs array<long>")


class PrefixTree:
    """Sets as paths; a node is a run of tokens and spans a range of sorted sets."""

    def __init__(self, flat: np.ndarray, at: np.ndarray):
        tokens, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(tokens), np.int64)
        rank[np.lexsort((tokens, -count))] = np.arange(len(tokens))
        flat = rank[inverse]
        sets = [np.sort(flat[at[i] : at[i + 1]]).astype(">u4") for i in range(len(at) - 1)]
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].tobytes())
        self.sets = [sets[i] for i in self.order]
        self.size = np.array([len(s) for s in self.sets])
        self.vocabulary = len(tokens)
        self._build()

    def _build(self) -> None:
        starts, ends, parents, lows, highs, leaves = [], [], [], [], [], []
        edges: list[np.ndarray] = []
        open_nodes: list[int] = []

        def add(parent: int, tokens: np.ndarray, depth: int, low: int) -> int:
            edges.append(tokens)
            starts.append(depth)
            ends.append(depth + len(tokens))
            parents.append(parent)
            lows.append(low)
            highs.append(low)
            leaves.append(-1)
            return len(edges) - 1

        root = add(-1, np.zeros(0, np.int64), 0, 0)
        open_nodes.append(root)
        before = np.zeros(0, np.int64)
        for i, current in enumerate(self.sets):
            m = min(len(before), len(current))
            differ = np.flatnonzero(before[:m] != current[:m])
            common = int(differ[0]) if len(differ) else m
            last = -1
            while ends[open_nodes[-1]] > common:
                last = open_nodes.pop()
                highs[last] = i
            top = open_nodes[-1]
            if ends[top] < common:  # the last closed node is split at ``common``
                cut = common - starts[last]
                middle = add(top, edges[last][:cut], starts[last], lows[last])
                edges[last] = edges[last][cut:]
                starts[last] = common
                parents[last] = middle
                open_nodes.append(middle)
                top = middle
            node = add(top, current[common:], common, i)
            leaves[node] = i
            open_nodes.append(node)
            before = current
        for node in open_nodes:
            highs[node] = len(self.sets)
        level = np.zeros(len(edges), np.int64)
        # A split node comes after its child, so levels are settled by waves.
        parents = np.array(parents)
        children: dict[int, list[int]] = {}
        for node, parent in enumerate(parents):
            children.setdefault(int(parent), []).append(node)
        order, wave = [], [root]
        while wave:
            order += wave
            wave = [c for node in wave for c in children.get(node, ())]
            level[wave] = level[order[-1]] + 1 if wave else 0
        new = np.empty(len(order), np.int64)
        new[order] = np.arange(len(order))
        self.level = level[order]
        self.parent = np.where(parents[order] >= 0, new[parents[order]], 0)
        self.end = np.array(ends)[order]
        self.low, self.high = np.array(lows)[order], np.array(highs)[order]
        self.leaf = np.array(leaves)[order]
        self.tokens = np.concatenate([edges[k] for k in order]).astype(np.int64)
        self.at = np.cumsum([0, *(len(edges[k]) for k in order)])
        self.levels = [np.flatnonzero(self.level == k) for k in range(int(self.level.max()) + 1)]
        self.longest = np.maximum.reduceat(self.size, self.low)  # bounds, refined below
        self.shortest = self.longest.copy()
        for k in range(len(order)):
            within = self.size[self.low[k] : self.high[k]]
            self.longest[k], self.shortest[k] = within.max(), within.min()

    def partners(self, i: int, percent: int, alive: np.ndarray, flags: np.ndarray) -> np.ndarray:
        """Sets that link with set ``i``, among the subtrees left in ``alive``."""
        own = self.sets[i].astype(np.int64)
        n = len(own)
        flags[own] = 1
        overlap = np.zeros(len(self.leaf), np.int64)
        keep = np.zeros(len(self.leaf), bool)
        keep[0] = True
        found = []
        for k, nodes in enumerate(self.levels):
            if k:
                nodes = nodes[keep[self.parent[nodes]] & alive[nodes]]
                if not len(nodes):
                    break
                length = self.at[nodes + 1] - self.at[nodes]
                filled = nodes[length > 0]
                overlap[nodes] = overlap[self.parent[nodes]]
                if len(filled):
                    size = self.at[filled + 1] - self.at[filled]
                    first = np.cumsum(size) - size
                    place = np.arange(int(size.sum())) + np.repeat(self.at[filled] - first, size)
                    overlap[filled] += np.add.reduceat(flags[self.tokens[place]], first)
            most = overlap[nodes] + np.minimum(
                self.longest[nodes] - self.end[nodes], n - overlap[nodes]
            )
            # |A & B| >= percent * (|A| + |B|) / (100 + percent), for the shortest set below
            bound = percent * (n + np.maximum(self.shortest[nodes], self.end[nodes]))
            good = most * (100 + percent) >= bound
            nodes = nodes[good]
            keep[nodes] = True
            ends = nodes[self.leaf[nodes] >= 0]
            other = self.leaf[ends]
            met = overlap[ends] * (100 + percent) >= percent * (n + self.size[other])
            found.append(other[met])
        flags[own] = 0
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def close_groups(flat: np.ndarray, at: np.ndarray, percent: int) -> list[np.ndarray]:
    """Sets that share one of their rarest runs, the fewest that a link must share one of."""
    _, run, count = np.unique(flat, return_inverse=True, return_counts=True)
    size = np.diff(at)
    of = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((run, count[run], of))
    place = np.arange(len(flat)) - np.repeat(at[:-1], size)
    head = (place < (size - _least(size, percent) + 1)[of]) & (count[run[order]] > 1)
    of, run = of[head], run[order][head]
    label = np.arange(len(size))
    while True:
        low = np.full(len(count), len(size))
        np.minimum.at(low, run, label[of])
        new = label.copy()
        np.minimum.at(new, of, low[run])
        new = new[new]
        if (new == label).all():
            break
        label = new
    order = np.argsort(label, kind="stable")
    cuts = np.flatnonzero(np.diff(label[order])) + 1
    return [group for group in np.split(order, cuts) if len(group) > 1]


def all_links(flat: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """Label of each set: the first set that it is linked to, itself included."""
    label = np.arange(len(at) - 1)
    for group in close_groups(flat, at, percent):
        size = np.diff(at)[group]
        own = np.concatenate([flat[at[i] : at[i + 1]] for i in group])
        label[group] = group[tree_links(own, np.cumsum([0, *size]), percent)]
    return label


def tree_links(flat: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """Label of each set: the smallest position among the sets it is linked to."""
    tree = PrefixTree(flat, at)
    m = len(tree.sets)
    label = np.arange(m)
    flags = np.zeros(tree.vocabulary, np.int64)
    settled = tree.high - tree.low == 1
    for i in range(m):
        # Only a subtree whose sets all have the label of set i is left out.
        alive = (~settled | (label[tree.low] != label[i])) & (tree.high > i)
        mine = tree.partners(i, percent, alive, flags)
        if len(mine):
            joined = np.unique(label[np.append(mine, i)])
            if len(joined) > 1:
                label[np.isin(label, joined)] = joined[0]
                changes = np.append(0, np.cumsum(label[1:] != label[:-1]))
                settled = changes[tree.low] == changes[tree.high - 1]
    out = np.empty(m, np.int64)
    order = np.array(tree.order)
    smallest = np.full(m, m)
    np.minimum.at(smallest, label, order)
    out[order] = smallest[label]
    return out


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Star links ``(a, b)`` within each part."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        nodes = table.column("node").to_numpy()
        runs = table.column("runs").combine_chunks()
        runs = runs.chunk(0) if isinstance(runs, pa.ChunkedArray) else runs
        at = runs.offsets.to_numpy().astype(np.int64)
        flat = runs.values.to_numpy()[at[0] : at[-1]]
        label = all_links(flat, at - at[0], percent)
        apart = np.flatnonzero(nodes != nodes[label])
        return pa.table({"a": nodes[apart], "b": nodes[label][apart]})

    return sets.groupBy("part").applyInArrow(run, "a long, b long")


def link_documents(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``<id_col>, n_shingles, component_id`` per row of ``docs``."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    headed = land(text_sets(texts, width, percent), "sets")
    sets = land(headed.drop("head"), "keys")
    classes = sets.where("set_key is not null and id is not null").groupBy("set_key").agg(F.min("id").alias("node"))
    first = headed.where("id is not null").join(classes, "set_key").where("id = node")
    runs = first.select("node", "n_shingles", F.explode("head").alias("run"))
    needed = F.expr(f"1 + div(div(n_shingles * {percent} + 99, 100), {SHARED_PER})").cast("long")

    def sharing(rows: DataFrame, *who: str) -> DataFrame:
        """Rows of documents with as many shared runs as a link needs."""
        met = rows.groupBy("run").agg(F.count("*").alias("n")).where("n > 1")
        kept = rows.join(met, "run")
        enough = kept.groupBy(*who, "n_shingles").agg(F.count("*").alias("m")).where(F.col("m") >= needed)
        return kept.join(enough.select(*who), [*who], "left_semi")

    shared = land(sharing(runs, "node").drop("n"), "runs")
    release(headed)
    # Sizes of partners lie in one class or in neighbours: both documents enter the upper one.
    size_class = F.floor(F.log(F.col("n_shingles")) / F.lit(float(np.log(100 / percent)) * (1 + 1e-9)))
    left = shared.withColumn("class", F.explode(F.array(size_class, size_class + 1)))
    near = left.withColumn("run", F.xxhash64("run", "class"))
    near = land(sharing(near, "node", "class"), "runs")
    release(shared)
    # Of the runs that prefixes share, a link can miss the most frequent ones but for one.
    by_count = Window.partitionBy("node", "class").orderBy(F.desc("n"), "run")
    rare = near.withColumn("place", F.row_number().over(by_count)).where(F.col("place") >= needed)
    rare = land(rare.select("node", "n_shingles", "run"), "rare")
    release(near)
    hub = rare.groupBy("run").agg(F.min("node").alias("b"))
    coarse = components(rare.join(hub, "run").select(F.col("node").alias("a"), "b").where("a <> b"), "groups")
    members = land(
        rare.select("node", "n_shingles").distinct().join(coarse, "node"), "members"
    )
    blocks = F.ceil(F.col("runs") / BLOCK_RUNS).cast("int")
    sizes = members.groupBy("component").agg(F.sum("n_shingles").alias("runs"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    parts = (
        members.join(sizes, "component")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node",
            F.concat_ws(
                ":", "component", F.least("own", "other"), F.greatest("own", "other")
            ).alias("part"),
        )
    )
    parts = land(parts.distinct(), "parts")
    wanted = broadcast_below(parts.withColumnRenamed("node", "id"), parts.count(), BROADCAST_IDS)
    bodies = texts.where("id is not null").join(wanted, "id").select("id", "part", "text")
    # One text per class: copies have the same set, other texts of the same id too are kept.
    whole = _whole_sets(bodies, width)
    linked = components(_links(whole, percent), "linked")
    named = classes.join(linked, classes.node == linked.node, "left").select(
        "set_key", F.coalesce("component", classes.node).alias("component_id")
    )
    return (
        sets.join(named, "set_key", "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        )
    )


def keep_first_of_each(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """The documents whose id is the smallest of their component; all columns stay.

    Of repeated rows with that id one stays; rows with a null id stay.
    """
    found = link_documents(docs, width, percent, id_col)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    kept = docs.join(gone, id_col, "left_anti").select(*docs.columns)
    named = kept.where(F.col(id_col).isNotNull()).dropDuplicates([id_col])
    return named.unionByName(kept.where(F.col(id_col).isNull()))
