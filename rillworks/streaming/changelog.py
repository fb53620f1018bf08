"""Running totals with one output row per message, as a stream.

Messages are first counted per user within each task's slice of the batch, so
state sees a few partial counts and never the messages of a busy user. State
turns them into ranges of new totals, and the ranges are spread out again
before they become one row per message.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Executors get these functions with the query and need not install the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_ROWS = 100_000
_HELD_KEYS = 50_000


def _partial_counts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter[str] = Counter()
    for batch in batches:
        held.update(batch["username"].value_counts().to_dict())
        if len(held) >= _HELD_KEYS:
            yield pd.DataFrame({"username": list(held), "n": list(held.values())})
            held.clear()
    yield pd.DataFrame(
        {"username": pd.Series(list(held), dtype="object"), "n": pd.Series(list(held.values()), dtype="int64")}
    )


class RunningTotal(StatefulProcessor):
    """Keeps one number per user; gives the range of totals a batch adds."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._total = handle.getValueState("total", "n bigint")

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        before = int(self._total.get()[0]) if self._total.exists() else 0
        after = before + sum(int(part["n"].sum()) for part in rows)
        self._total.update((after,))
        firsts = range(before + 1, after + 1, RANGE_ROWS)
        yield pd.DataFrame(
            {
                "username": [key[0]] * len(firsts),
                "first": list(firsts),
                "last": [min(f + RANGE_ROWS - 1, after) for f in firsts],
            }
        )

    def close(self) -> None:
        pass


def changelog_stream(keyed: DataFrame) -> DataFrame:
    """``username, message_count`` for every message of a keyed stream.

    The query that writes it uses append mode and the RocksDB state store.
    """
    ranges = (
        keyed.select("username")
        .mapInPandas(_partial_counts, "username string, n bigint")
        .groupBy("username")
        .transformWithStateInPandas(
            RunningTotal(), "username string, first bigint, last bigint", "Append", "None"
        )
    )
    spread = ranges.repartition(F.col("username"), F.col("first"))
    return spread.select(
        "username", F.explode(F.sequence("first", "last")).alias("message_count")
    )
