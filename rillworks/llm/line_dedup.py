"""Line de-duplication by winnowing.

A window starts at every line and takes as many lines as make ``min_bytes``
bytes. Its fingerprint is the smallest line hash in it, so two equal windows,
and with them any repeated run of lines of that many bytes, have a fingerprint
in common. Positions join on fingerprints; only windows whose fingerprint lies
at two places are compared as a whole. A window equal to one at an earlier
place (by id, then line) is a match. To the left, matched windows reach the first
line of a repeated run by themselves; to the right, with ``extend``, each window is
also compared with one line more, two more and so on until the next window is full,
so that short lines at the end of a run belong to it. Any earlier place counts, not
only the first. Runs from all windows cover every maximal common run, which is deleted.

Nulls and extras: rows with a null id, a null or an empty text stay as they
are. Repeated rows (same id and text) are one document: none is a repeat of the
other, and both lose the same lines. Rows of one id with other texts are ordered
by their text's hash. A document left without any line that is not blank is
empty afterwards (``drop_emptied`` drops it). Extra columns stay, whatever their names. Runs that are
shorter in bytes than ``min_bytes`` stay, whatever their number of lines.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillworks.llm.land import land
from rillworks.llm.text import prefix_hashes, slices, spans

MIN_BYTES = 48

WINDOWS = "id long, of long, line int, n_lines int, whole long, print long, at int, longer array<long>"


def line_windows(docs: DataFrame, min_bytes: int) -> DataFrame:
    """Windows of ``id, of, text``: hash of all their bytes, fingerprint and its line.

    ``longer`` has the hashes of the window with one line more, two more and so on,
    up to the last line before the next window is full, or the last of the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(2)):
                n = len(texts.at) - 1
                breaks = np.flatnonzero(texts.data == 10)
                start = np.unique(np.concatenate([texts.at[:-1], breaks + 1]))
                start = start[start < len(texts.data)]
                if not len(start):
                    continue
                row = np.searchsorted(texts.at, start, "right") - 1
                # A line ends before its break, or where its text ends.
                end = np.append(start[1:], len(texts.data))
                end = np.minimum(end, texts.at[row + 1])
                broken = texts.data[end - 1] == 10
                prefix = prefix_hashes(texts.data)
                line_end = end - broken
                hashes = spans(prefix, start, line_end)
                filled = np.cumsum(line_end - start)
                before = filled - (line_end - start)
                last = np.searchsorted(filled, before + min_bytes, "left")
                # Lines that only runs from here cover: up to the next window's last line.
                stop = np.searchsorted(start, texts.at[row + 1])
                until = np.minimum(np.append(last[1:], len(start)), stop)
                inside = last < len(start)
                first = np.flatnonzero(inside)
                last = last[inside]
                whole_row = row[last] == row[first]
                first, last = first[whole_row], last[whole_row]
                if not len(first):
                    continue
                # Ranks by hash, the later of equal lines first, name the minimum's line.
                order = np.lexsort((-np.arange(len(start)), hashes))
                rank = np.empty(len(start) + 1, np.int64)
                rank[order], rank[-1] = np.arange(len(start)), len(start)
                pairs = np.stack([first, last + 1], 1).ravel()
                at = order[np.minimum.reduceat(rank, pairs)[::2]]
                low = hashes[at]
                head = np.searchsorted(start, texts.at[:-1])
                more = np.maximum(until[first] - 1 - last, 0)
                grown = np.append(0, np.cumsum(more))
                step = np.arange(grown[-1]) - np.repeat(grown[:-1], more)
                longer = spans(prefix, np.repeat(start[first], more), line_end[np.repeat(last, more) + step + 1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, n).take(pa.array(row[first])),
                        batch.column(1).slice(texts.first, n).take(pa.array(row[first])),
                        pa.array((first - head[row[first]]).astype(np.int32)),
                        pa.array((last - first + 1).astype(np.int32)),
                        pa.array(spans(prefix, start[first], line_end[last]).view(np.int64)),
                        pa.array(low.view(np.int64)),
                        pa.array((at - head[row[first]]).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(grown.astype(np.int32)), pa.array(longer.view(np.int64))),
                    ],
                    ["id", "of", "line", "n_lines", "whole", "print", "at", "longer"],
                )

    return docs.mapInArrow(run, WINDOWS)


def repeated_lines(
    docs: DataFrame,
    min_bytes: int = MIN_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    extend: bool = False,
) -> DataFrame:
    """``id, of, runs``: the lines that belong to later repeated runs, as intervals."""
    texts = (
        docs.where(F.col(id_col).isNotNull() & (F.length(text_col) > 0))
        .select(
            F.col(id_col).cast("long").alias("id"),
            F.xxhash64(text_col).alias("of"),
            F.col(text_col).alias("text"),
        )
    )
    windows = line_windows(texts, min_bytes)
    windows = land(windows if extend else windows.drop("longer"), "windows")
    place = F.struct("id", "of", "at")
    shared = (
        windows.groupBy("print")
        .agg(F.min(place).alias("a"), F.max(place).alias("b"))
        .where("a <> b")
        .select("print")
    )
    # Written first, so that the join below can split the places of a hot fingerprint.
    shared = land(shared, "prints")
    met = windows.join(shared, "print")
    if extend:
        runs = F.concat(F.array("whole"), "longer")
        met = met.select("id", "of", "line", "n_lines", F.posexplode(runs).alias("more", "whole"))
    else:
        met = met.select("id", "of", "line", "n_lines", F.lit(0).alias("more"), "whole")
    first = met.groupBy("whole").agg(F.min(F.struct("id", "of", "line")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = land(first.select("whole", "first"), "first")
    later = met.join(first, "whole").where(F.struct("id", "of", "line") > F.col("first"))
    # A longer run adds its last line: the shorter ones from there are repeated too.
    last = F.col("line") + F.col("n_lines") - 1 + F.col("more")
    runs = later.select("id", "of", F.when(F.col("more") > 0, last).otherwise(F.col("line")).alias("a"), last.alias("b"))
    return _merged(runs)


def _merged(runs: DataFrame) -> DataFrame:
    """``id, of, runs``: lines ``a`` to ``b`` of a text, those that meet or overlap made one."""
    earlier = Window.partitionBy("id", "of").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("id", "of").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, 0)
    apart = F.coalesce(F.col("a") > F.max("b").over(earlier) + 1, F.lit(True))
    # Windows of one start are one interval, so a text has one row per line at most.
    longest = runs.groupBy("id", "of", "a").agg(F.max("b").alias("b"))
    islands = longest.withColumn("new", apart.cast("int")).withColumn("island", F.sum("new").over(upto))
    whole = islands.groupBy("id", "of", "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return whole.groupBy("id", "of").agg(F.collect_list(F.struct("a", "b")).alias("runs"))


def count_columns(columns: Sequence[str]) -> tuple[str, str]:
    """The names of the two columns with counts: ``_lines`` and ``_removed``, with more
    underscores before them where a table has columns of that name."""
    taken, out = {c.lower() for c in columns}, []
    for name in ("_lines", "_removed"):
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out[0], out[1]


def drop_repeated_lines(
    docs: DataFrame,
    min_bytes: int = MIN_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    drop_emptied: bool = False,
    extend: bool = False,
) -> DataFrame:
    """``docs`` without later repeated runs, and two columns of :func:`count_columns`:
    the lines of each text and how many of them went.

    ``extend``: runs go to their last equal line, also after their last full window.
    """
    found = repeated_lines(docs, min_bytes, id_col, text_col, extend)
    # The input is one column while it is joined, so that none of its names can clash.
    text, given = F.col(f"row.`{text_col}`"), F.col(f"row.`{id_col}`").cast("long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # Rows without an id match nothing; their number spreads them.
    key = F.when(given.isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64(text))
    rows = rows.withColumn("asked", given).withColumn("key", key)
    joined = rows.join(found, (F.col("asked") == F.col("id")) & (F.col("key") == F.col("of")), "left")
    # A column of its own: named in the functions below, the split would run for each line.
    joined = joined.select("row", "runs", F.split(text, "\n", -1).alias("parts"))
    parts = F.col("parts")
    gone = F.flatten(F.transform("runs", lambda run: F.sequence(run["a"], run["b"])))
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    kept = F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n")
    cut = F.col("runs").isNotNull()
    removed = F.aggregate("runs", F.lit(0), lambda n, run: n + run["b"] - run["a"] + 1)
    lines, gone_lines = count_columns(docs.columns)
    counted = joined.select(
        "row",
        F.when(cut, kept).otherwise(text).alias("text"),
        F.coalesce(F.size(F.when(F.length(text) > 0, parts)), F.lit(0)).alias("lines"),
        F.coalesce(F.when(cut, removed), F.lit(0)).alias("removed"),
    )
    if drop_emptied:
        counted = counted.where((F.col("removed") == 0) | F.coalesce("text", F.lit("")).rlike(r"\S"))
    return counted.select(
        *[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns],
        F.col("lines").alias(lines),
        F.col("removed").alias(gone_lines),
    )
