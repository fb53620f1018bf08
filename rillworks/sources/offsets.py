"""A topic read by offset ranges, as a source of its own.

The stream's position is the next offset of every topic partition, not a list of files,
so a batch may end, and the next one or a restarted query may begin, in the middle of a
file. Beside the topic lie notes of which offsets of which partition each file holds;
the driver sees these notes only, one row per file and partition. Later files of a
partition hold later offsets, as :func:`rillworks.sinks.publish` writes them.

Options of the format ``topic_offsets``: ``path``; for batches ``from`` and ``to``, JSON
objects of partition to offset; for streams ``max_offsets`` per batch, which needs
``positions``, a folder for the position planned last, as a restarted source is not told
where it stands before it says how far to go.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from rillworks.schemas import ENVELOPE

# Executors get these classes with the query and need not install the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "topic_offsets"
NOTES = "_positions"

Positions = dict[str, int]


def note_positions(spark: SparkSession, path: str, batch: int | None = None) -> None:
    """Note the offsets that each file of a topic, or of one batch folder of it, holds."""
    home = path if batch is None else f"{path}/batch={batch}"
    files = spark.read.schema(ENVELOPE).parquet(home).groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("partition").cast("string").alias("partition")
    ).agg(F.min("offset").alias("low"), F.max("offset").alias("high"), F.count(F.lit(1)).alias("records"))
    files.coalesce(1).write.mode("overwrite").json(f"{path}/{NOTES}/batch={'all' if batch is None else batch}")


@dataclass(frozen=True)
class Note:
    """Records of one partition in one file: offsets ``low`` to ``high``."""

    file: str
    partition: str
    low: int
    high: int
    records: int

    def below(self, offset: int) -> float:
        """About how many of the records lie below an offset."""
        inside = min(max(offset - self.low, 0), self.high - self.low + 1)
        return self.records * inside / (self.high - self.low + 1)


@dataclass
class FileRange(InputPartition):
    """Offsets ``[low, high)`` by partition, in one file."""

    file: str
    ranges: dict[str, tuple[int, int]]


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def read_notes(path: str, known: dict[str, list[Note]]) -> list[Note]:
    """All notes of a topic; ``known`` keeps those of files that were read before."""
    from pyarrow import fs

    system, root = _open(f"{path.rstrip('/')}/{NOTES}")
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    for info in found:
        if info.base_name.endswith(".json") and info.path not in known:
            with system.open_input_stream(info.path) as lines:
                known[info.path] = [Note(**json.loads(line)) for line in lines.read().decode().splitlines()]
    now = {info.path for info in found}
    return [note for name, notes in sorted(known.items()) if name in now for note in notes]


def _by_partition(notes: Sequence[Note]) -> dict[str, list[Note]]:
    out: dict[str, list[Note]] = {}
    for note in notes:
        out.setdefault(note.partition, []).append(note)
    return out


def reach(notes: Sequence[Note], start: Positions, limit: int | None) -> Positions:
    """The position after at most about ``limit`` records beyond ``start``.

    Every partition goes on by the same share of what it holds. A partition that has
    anything to read goes on by one offset at least.
    """
    parts = _by_partition(notes)
    ends = {p: max(n.high for n in ns) + 1 for p, ns in parts.items()}
    begins = {p: start.get(p, min(n.low for n in ns)) for p, ns in parts.items()}
    waiting = {p: sum(n.records - n.below(begins[p]) for n in ns) for p, ns in parts.items()}
    total = sum(waiting.values())
    if limit is not None and total > limit:
        for p, ns in parts.items():
            if ends[p] <= begins[p]:
                continue
            done = sum(n.below(begins[p]) for n in ns)
            least, most = begins[p], ends[p]
            while least < most:
                middle = (least + most + 1) // 2
                if sum(n.below(middle) for n in ns) - done <= limit * waiting[p] / total:
                    least = middle
                else:
                    most = middle - 1
            ends[p] = max(least, begins[p] + 1)
    return {p: max(ends.get(p, 0), start.get(p, ends.get(p, 0))) for p in sorted({*ends, *start}, key=int)}


def file_ranges(notes: Sequence[Note], start: Positions, end: Positions) -> list[FileRange]:
    """The files that hold offsets between two positions, with the ranges to read of each."""
    out: dict[str, dict[str, tuple[int, int]]] = {}
    for note in notes:
        low = max(note.low, start.get(note.partition, note.low))
        high = min(note.high + 1, end.get(note.partition, note.low))
        if low < high:
            out.setdefault(note.file, {})[note.partition] = (low, high)
    return [FileRange(file, ranges) for file, ranges in sorted(out.items())]


def read_range(wanted: FileRange) -> Iterator:
    """The records of one file within its ranges, in Arrow batches; row groups are pruned."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    system, path = _open(wanted.file)
    keep = None
    for partition, (low, high) in wanted.ranges.items():
        at = (ds.field("partition") == int(partition)) & (ds.field("offset") >= low) & (ds.field("offset") < high)
        keep = at if keep is None else keep | at
    kinds = {
        "key": pa.string(), "value": pa.string(), "topic": pa.string(), "partition": pa.int32(),
        "offset": pa.int64(), "timestamp": pa.timestamp("us", "UTC"),
    }
    source = ds.dataset(path, format="parquet", filesystem=system)
    for batch in source.to_batches(columns=list(kinds), filter=keep, batch_size=10_000):
        if batch.num_rows:
            columns = [pc.cast(batch.column(k), kind, safe=False) for k, kind in enumerate(kinds.values())]
            yield pa.RecordBatch.from_arrays(columns, list(kinds))


class _Ranges(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.start, self.end = (json.loads(options[k]) if k in options else None for k in ("from", "to"))

    def partitions(self) -> list[FileRange]:
        notes = read_notes(self.path, {})
        return file_ranges(notes, self.start or {}, self.end or reach(notes, {}, None)) or [FileRange("", {})]

    def read(self, partition: FileRange) -> Iterator:
        return read_range(partition) if partition.ranges else iter(())


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.positions = options["path"], options.get("positions")
        self.limit = int(options["max_offsets"]) if options.get("max_offsets") else None
        if self.limit is not None and not self.positions:
            raise ValueError("max_offsets needs a folder for positions")
        self.known: dict[str, list[Note]] = {}
        self.at: Positions | None = None

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._planned()
        return reach(read_notes(self.path, self.known), self.at, self.limit)

    def partitions(self, start: dict, end: dict) -> list[FileRange]:
        # The batch is in the offset log by now, so a restart begins here or plans it again.
        self.at = dict(end)
        self._plan(end)
        return file_ranges(read_notes(self.path, self.known), start, end) or [FileRange("", {})]

    def read(self, partition: FileRange) -> Iterator:
        return read_range(partition) if partition.ranges else iter(())

    def _planned(self) -> Positions:
        if self.limit is None:
            return {}
        system, path = _open(f"{self.positions}/planned.json")
        try:
            with system.open_input_stream(path) as text:
                return json.loads(text.read())
        except FileNotFoundError:
            return {}

    def _plan(self, end: dict) -> None:
        if self.limit is None:
            return
        system, home = _open(self.positions)
        system.create_dir(home, recursive=True)
        with system.open_output_stream(f"{home}/planned.tmp") as text:
            text.write(json.dumps(end).encode())
        system.move(f"{home}/planned.tmp", f"{home}/planned.json")


class TopicOffsets(DataSource):
    """Records of a topic by offset, for batches and streams."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return ENVELOPE

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Ranges(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(dict(self.options))


def read_offsets(
    spark: SparkSession, path: str, start: Positions | None = None, end: Positions | None = None
) -> DataFrame:
    """The records of a topic from one position up to, not including, another."""
    spark.dataSource.register(TopicOffsets)
    reader = spark.read.format(FORMAT).option("path", path)
    for name, position in (("from", start), ("to", end)):
        if position is not None:
            reader = reader.option(name, json.dumps(position))
    return reader.load()


def stream_offsets(
    spark: SparkSession, path: str, positions: str | None = None, max_offsets: int | None = None
) -> DataFrame:
    """A topic as a stream from its earliest record, about ``max_offsets`` records a batch."""
    spark.dataSource.register(TopicOffsets)
    reader = spark.readStream.format(FORMAT).option("path", path)
    if positions is not None:
        reader = reader.option("positions", positions)
    if max_offsets is not None:
        reader = reader.option("max_offsets", str(max_offsets))
    return reader.load()
