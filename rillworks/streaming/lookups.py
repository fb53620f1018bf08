"""Retries and the choice of a provider, decided while records flow.

Both hold rows until the watermark says that nothing earlier can come, so rows may
arrive in any order within the allowed delay and the result is that of the batch
operators on the finished log.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from rillworks.operators.attempts import ERROR, SUCCESS
from rillworks.schemas import MAX_TRIES, PROVIDER_WINDOW_SECONDS

# Executors get these classes with the query and need not install the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HELD_ROWS = 50_000
#: Deadlines of so many milliseconds share keys of the state.
_SLOT_MS = 3_600_000
#: Position of a timeout that has gone out, before all others.
_CARRIED = -(1 << 63)


def _matter(rows: pd.DataFrame, request: list[str], max_tries: int, success: str, error: str) -> pd.DataFrame:
    """Of each request the first success, the first errors, and one row in any case."""
    rows = rows.sort_values("at", kind="stable")
    good = rows[rows["kind"] == success].groupby(request, dropna=False).head(1)
    bad = rows[rows["kind"] == error].groupby(request, dropna=False).head(max_tries)
    any_one = rows.groupby(request, dropna=False).head(1)
    return pd.concat([good, bad, any_one]).drop_duplicates([*request, "kind", "at"])


def _as_text(field: StructField) -> Column:
    """A part of a key as text, which pandas hands on unchanged next to nulls."""
    if isinstance(field.dataType, TimestampType):
        return F.unix_micros(field.name).cast("string").alias(field.name)
    if isinstance(field.dataType, BinaryType):
        return F.hex(field.name).alias(field.name)
    return F.col(field.name).cast("string").alias(field.name)


def _from_text(field: StructField) -> Column:
    if isinstance(field.dataType, TimestampType):
        return F.timestamp_micros(F.col(field.name).cast("long")).alias(field.name)
    if isinstance(field.dataType, BinaryType):
        return F.unhex(field.name).alias(field.name)
    return F.col(field.name).cast(field.dataType).alias(field.name)


def _pack(rows: pd.DataFrame, schema: pa.Schema) -> tuple[bytes]:
    """Rows as one value of the state."""
    table = pa.Table.from_pandas(rows, schema=schema, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def _unpack(packed: tuple) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(packed[0])).read_all().to_pandas()


class AttemptResolver(StatefulProcessor):
    """Keeps the few attempts of each request that can matter; settles them at their deadlines.

    A key holds the requests of one pack whose deadlines lie in the same stretch of time,
    so that the cost of a call is shared by many of them.
    """

    def __init__(self, request: list[str], max_tries: int, success: str, error: str) -> None:
        self.request, self.max_tries, self.success, self.error = request, max_tries, success, error
        text = [(name, pa.string()) for name in (*request, "kind")]
        self.schema = pa.schema([*text, ("at", pa.int64()), ("due", pa.int64())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._kept = handle.getValueState("kept", "attempts binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        parts = [_unpack(self._kept.get())] if self._kept.exists() else []
        fresh = 0
        for part in rows:
            parts.append(part[self.schema.names])
            fresh += len(part)
            if fresh >= _HELD_ROWS:
                parts, fresh = [self._first(pd.concat(parts))], 0
        if parts:
            kept = self._first(pd.concat(parts))
            self._kept.update(_pack(kept, self.schema))
            self._handle.registerTimer(int(kept["due"].min()))
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if not self._kept.exists():
            return
        kept = _unpack(self._kept.get())
        now = max(timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs())
        over = kept["due"] <= now
        left = kept[~over]
        if len(left):
            self._kept.update(_pack(left, self.schema))
            self._handle.registerTimer(int(left["due"].min()))
        else:
            self._kept.clear()
        if over.any():
            yield self._settled(kept[over])

    def _settled(self, rows: pd.DataFrame) -> pd.DataFrame:
        number = rows.groupby(self.request, dropna=False, sort=False).ngroup()
        requests = rows.assign(number=number).drop_duplicates("number").set_index("number")
        good = rows[rows["kind"] == self.success].groupby(number)["at"].min()
        errors = rows[rows["kind"] == self.error].groupby(number)["at"].agg(["size", "max"])
        # At most max_tries errors are kept, so the last of so many is the last try.
        last_try = errors.loc[errors["size"] >= self.max_tries, "max"].reindex(good.index)
        in_time = good[last_try.isna() | (good < last_try)]
        out = requests[self.request].assign(resolved_at=in_time.astype("Int64").reindex(requests.index))
        return out.reset_index(drop=True)

    def _first(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Of each request the first success and the first errors, or else one row."""
        rows = rows.drop_duplicates([*self.request, "kind", "at"]).sort_values("at", kind="stable")
        number = rows.groupby(self.request, dropna=False, sort=False).ngroup()
        good, bad = rows["kind"] == self.success, rows["kind"] == self.error
        place = rows.groupby([number, rows["kind"]], dropna=False, sort=False).cumcount()
        keep = (good & (place < 1)) | (bad & (place < self.max_tries))
        alone = ~number.isin(number[keep]) & ~number.duplicated()
        return rows[keep | alone]

    def close(self) -> None:
        pass


def resolve_attempts_stream(
    attempts: DataFrame,
    request: Sequence[str],
    kind: Column,
    position: str,
    deadline: Column,
    delay: str,
    max_tries: int = MAX_TRIES,
    packs: int = 64,
) -> DataFrame:
    """A stream of ``request, resolved_at``, one row per request once its time is over.

    ``deadline``, the same for all attempts of a request, is the event time: a request
    is settled, and later attempts of it are left out, when deadlines of more than
    ``delay`` after its own have been seen. State holds at most one success and
    ``max_tries`` errors per request, and tasks cut their rows to these before the
    exchange, so a request with very many attempts sends only a few. Requests whose
    deadlines lie in one hour share ``packs`` keys of the state. A request whose
    parts are all null is the sign of a topic to move time on, and settles nothing.
    Attempts without a deadline are left out.
    """
    names = list(request)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Arrow types: whole numbers next to nulls stay whole numbers.
        held: list[pd.DataFrame] = []
        schema = None

        def out(rows: pd.DataFrame) -> list[pa.RecordBatch]:
            return pa.Table.from_pandas(rows, schema=schema, preserve_index=False).to_batches()

        for batch in batches:
            schema = batch.schema
            rows = pa.Table.from_batches([batch]).to_pandas(types_mapper=pd.ArrowDtype)
            held.append(_matter(rows, names, max_tries, SUCCESS, ERROR))
            if sum(map(len, held)) >= _HELD_ROWS:
                held = [_matter(pd.concat(held), names, max_tries, SUCCESS, ERROR)]
                if len(held[0]) >= _HELD_ROWS // 2:
                    yield from out(held.pop())
        if held:
            yield from out(_matter(pd.concat(held), names, max_tries, SUCCESS, ERROR))

    rows = attempts.select(
        *names, kind.alias("kind"), F.coalesce(F.col(position).cast("long"), F.lit(-1)).alias("at"), deadline.cast("timestamp").alias("deadline")
    )
    fields = [rows.schema[n] for n in names]
    settled = StructType([*(StructField(n, StringType()) for n in names), StructField("resolved_at", LongType())])
    some = F.lit(False)
    for name in names:
        some = some | F.col(name).isNotNull()
    due = F.unix_millis("deadline")
    return (
        rows.mapInArrow(cut, rows.schema)
        .where("deadline is not null")
        .withWatermark("deadline", delay)
        .select(
            F.pmod(F.xxhash64(*names), F.lit(packs)).alias("_pack"), F.floor(due / _SLOT_MS).alias("_slot"),
            *map(_as_text, fields), "kind", "at", due.alias("due"), "deadline",
        )
        .groupBy("_pack", "_slot")
        .transformWithStateInPandas(
            AttemptResolver(names, max_tries, SUCCESS, ERROR), settled, "Append", "EventTime"
        )
        .where(some)
        .select(*map(_from_text, fields), "resolved_at")
    )


class ProviderChoice(StatefulProcessor):
    """Calls wait until their time has come, then go out in order of their instance.

    A key holds the calls of many instances, as lists of rows, and of each instance the
    latest timeout that has gone out, while it is young enough to matter, as a row at ``_CARRIED``.
    """

    def __init__(self, instance: list[str], window_us: int) -> None:
        self.instance, self.window_us = instance, window_us
        text = [(name, pa.string()) for name in instance]
        self.schema = pa.schema([*text, ("at", pa.int64()), ("us", pa.int64()), ("timed_out", pa.bool_()), ("mine", pa.bool_())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", "calls binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            # A call without a time follows no timeout, and none of its own counts.
            placed = part["us"].notna()
            yield from self._out(part[~placed & part["mine"]].assign(provider="primary"))
            part = part[placed]
            if len(part):
                self._waiting.appendValue(_pack(part[self.schema.names].astype({"us": "int64"}), self.schema))
                at = int(part["us"].min())
                first = at if first is None else min(first, at)
        if first is not None:
            self._handle.registerTimer(first // 1000 + 1)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if not self._waiting.exists():
            return
        now = timerValues.getCurrentWatermarkInMs() * 1000
        calls = pd.concat(list(map(_unpack, self._waiting.get())), ignore_index=True)
        # A position that came again counts as it came last.
        calls = calls.drop_duplicates([*self.instance, "at"], keep="last")
        due = (calls["us"] < now) | (calls["at"] == _CARRIED)
        left, calls = calls[~due], calls[due]
        number = calls.groupby(self.instance, dropna=False, sort=False).ngroup().to_numpy()
        order = np.lexsort((calls["at"].to_numpy(), number))
        calls, number = calls.iloc[order], number[order]
        us = calls["us"].to_numpy()
        latest = pd.Series(np.where(calls["timed_out"], us, _CARRIED)).groupby(number).cummax().to_numpy()
        ends = np.append(number[1:] != number[:-1], True) if len(number) else np.zeros(0, bool)
        before = np.full(len(us), _CARRIED)
        before[1:] = np.where(ends[:-1], _CARRIED, latest[:-1])
        young = (before != _CARRIED) & (us - np.where(before == _CARRIED, 0, before) < self.window_us)
        # Calls to come are at now or later, so an older timeout is young for none of them.
        carried = calls[ends].assign(at=_CARRIED, us=latest[ends], timed_out=True, mine=False)
        carried = carried[(latest[ends] != _CARRIED) & (latest[ends] > now - self.window_us)]
        self._waiting.clear()
        if len(left) or len(carried):
            self._waiting.put([_pack(rows, self.schema) for rows in (carried, left) if len(rows)])
        if len(left):
            self._handle.registerTimer(int(left["us"].min()) // 1000 + 1)
        calls = calls.assign(provider=np.where(young, "fallback", "primary"))
        yield from self._out(calls[calls["mine"].to_numpy()])

    def _out(self, calls: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for start in range(0, len(calls), _HELD_ROWS):
            yield calls[[*self.instance, "at", "provider"]].iloc[start : start + _HELD_ROWS].reset_index(drop=True)

    def close(self) -> None:
        pass


def choose_provider_stream(
    calls: DataFrame,
    instance: Sequence[str],
    position: str,
    timed_out: Column,
    delay: str,
    window_seconds: int = PROVIDER_WINDOW_SECONDS,
    shares: int = 8,
    packs: int = 64,
) -> DataFrame:
    """A stream of ``instance, at, provider``: a row per call once nothing earlier can come.

    ``ts`` holds the time of a call, and positions of an instance grow with it. Calls and
    timeouts may arrive out of order by ``delay``; later ones are left out. State holds
    the calls of that delay and one number per instance that had a timeout within the
    window. Instances share ``packs`` keys of the state, each of which is dealt out to
    ``shares`` keys that all get its timeouts, so a busy instance is spread.
    A call without a time is one to the primary.
    """
    names = list(instance)
    rows = calls.select(
        *names, F.coalesce(F.col(position).cast("long"), F.lit(-1)).alias("at"), F.col("ts").cast("timestamp").alias("ts"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.coalesce(timed_out, F.lit(False)).alias("timed_out"),
    )
    own = F.pmod(F.xxhash64("at"), F.lit(shares)).cast("int")
    dealt = rows.withColumn("own", own).withColumn(
        "share", F.explode(F.when(F.col("timed_out"), F.sequence(F.lit(0), F.lit(shares - 1))).otherwise(F.array("own")))
    ).withColumn("mine", F.col("share") == F.col("own")).drop("own")
    fields = [dealt.schema[n] for n in names]
    chosen = StructType(
        [*(StructField(n, StringType()) for n in names), StructField("at", LongType()), StructField("provider", StringType())]
    )
    some = F.lit(False)
    for name in names:
        some = some | F.col(name).isNotNull()
    pack = F.pmod(F.xxhash64(*names), F.lit(packs)) * F.lit(shares) + F.col("share")
    return (
        dealt.withWatermark("ts", delay)
        .select(pack.alias("_pack"), *map(_as_text, fields), "at", "ts", "us", "timed_out", "mine")
        .groupBy("_pack")
        .transformWithStateInPandas(ProviderChoice(names, window_seconds * 1_000_000), chosen, "Append", "EventTime")
        .where(some)
        .select(*map(_from_text, fields), "at", "provider")
    )
