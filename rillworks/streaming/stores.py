"""The last value of every key as a named store that jobs can read."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillworks.streaming.runs import rocksdb_state

# Executors get these classes with the query and need not install the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HELD_KEYS = 50_000


def _latest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last value of each key among the rows of a task."""
    held: dict[str, tuple[int, str | None]] = {}

    def out() -> pa.RecordBatch:
        rows = list(held.items())
        held.clear()
        columns = [
            pa.array([k for k, _ in rows], pa.string()),
            pa.array([v for _, (_, v) in rows], pa.string()),
            pa.array([o for _, (o, _) in rows], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["key", "value", "offset"])

    for batch in batches:
        for key, value, offset in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if key not in held or held[key][0] <= offset:
                held[key] = (offset, value)
        if len(held) >= _HELD_KEYS:
            yield out()
    if held:
        yield out()


class LastValue(StatefulProcessor):
    """Keeps the last value of a key under a name; gives what changed."""

    def __init__(self, store: str) -> None:
        self.store = store

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState(self.store, "offset bigint, value string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        before = tuple(self._last.get()) if self._last.exists() else None
        now = before
        for part in rows:
            for offset, value in zip(part["offset"], part["value"]):
                if now is None or now[0] <= int(offset):
                    now = (int(offset), value)
        if now != before:
            self._last.update(now)
            yield pd.DataFrame({"key": [key[0]], "value": [now[1]], "offset": [now[0]]})

    def close(self) -> None:
        pass


def last_store_stream(records: DataFrame, store: str) -> DataFrame:
    """Changed last values ``key, value, offset``; the state keeps all of them as ``store``.

    Records without a key or offset are not stored. Tasks keep one record per key
    before the exchange, so a busy key sends one row per task and batch.
    """
    keyed = records.where("key is not null and offset is not null").select("key", "value", "offset")
    return keyed.mapInArrow(_latest, "key string, value string, offset bigint").groupBy("key").transformWithStateInPandas(
        LastValue(store), "key string, value string, offset bigint", "Append", "None"
    )


def read_store(spark: SparkSession, checkpoint: str, store: str, batch_id: int | None = None) -> DataFrame:
    """``key, value, offset`` of a named store, as of its last or a given batch.

    The state under a checkpoint is read as a table, by all tasks; the stream need not run.
    """
    with rocksdb_state(spark):
        reader = spark.read.format("statestore").option("stateVarName", store)
        if batch_id is not None:
            reader = reader.option("batchId", batch_id)
        state = reader.load(checkpoint)
    return state.select("key.key", F.col("value.value").alias("value"), F.col("value.offset").alias("offset"))
