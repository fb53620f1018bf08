"""Running results per key that hold up when one key has most of the rows.

Rows are numbered by a position: any leading columns and, last, a whole number
that is unique beneath them, such as ``(partition, offset)``. The last column
is cut into stretches of ``stretch`` positions. A window then never sees more
than ``stretch`` rows of a key; what came before a stretch is one row per key
and stretch, summed up on its own and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRETCH = 1 << 20


def _in_stretches(
    df: DataFrame, keys: Sequence[str], position: Sequence[str], stretch: int
) -> tuple[DataFrame, list[str]]:
    """Rows brought together by key and stretch, in the one exchange they need.

    The windows and the totals below both start from it, so the input is read
    and parsed once.
    """
    parts = [*position[:-1], "_stretch"]
    # Never NULL, so that the join adds no filter to one side of it only.
    stretch_of = F.expr(f"coalesce(`{position[-1]}` div {stretch}, 0)")
    cut = df.withColumn("_stretch", stretch_of)
    return cut.repartition(*[F.col(c) for c in (*keys, *parts)]), parts


def _before_stretch(
    cut: DataFrame, keys: Sequence[str], parts: Sequence[str], total: Column, over: str
) -> DataFrame:
    """Per key and stretch, ``over`` of ``total`` across earlier stretches."""
    totals = cut.groupBy(*keys, *parts).agg(total.alias("_total"))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(*parts)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = F.expr(f"{over}(_total)").over(earlier)
    return totals.select(*keys, *parts, carried.alias("_carried"))


def running_count(
    df: DataFrame,
    keys: Sequence[str],
    position: Sequence[str],
    into: str,
    stretch: int = STRETCH,
) -> DataFrame:
    """Number the rows of each key from 1 in position order. No NULL keys.

    Totals count the position, so that both uses of the exchange need the same
    columns and share it.
    """
    cut, parts = _in_stretches(df, keys, position, stretch)
    within = Window.partitionBy(*keys, *parts).orderBy(position[-1])
    numbered = cut.withColumn("_n", F.row_number().over(within).cast("bigint"))
    before = _before_stretch(cut, keys, parts, F.count(position[-1]), "sum")
    n = F.col("_n") + F.coalesce(F.col("_carried"), F.lit(0))
    return numbered.join(before, [*keys, *parts]).select(*df.columns, n.alias(into))


def running_max(
    df: DataFrame,
    keys: Sequence[str],
    position: Sequence[str],
    of: Column,
    into: str,
    stretch: int = STRETCH,
) -> DataFrame:
    """Largest ``of`` on the strictly earlier rows of each key. No NULL keys."""
    cut, parts = _in_stretches(df.withColumn("_of", of), keys, position, stretch)
    within = (
        Window.partitionBy(*keys, *parts)
        .orderBy(position[-1])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = cut.withColumn("_local", F.max("_of").over(within))
    before = _before_stretch(cut, keys, parts, F.max("_of"), "max")
    return local.join(before, [*keys, *parts]).select(
        *df.columns, F.greatest("_local", "_carried").alias(into)
    )
