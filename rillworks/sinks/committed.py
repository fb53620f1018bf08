"""Units of rows that become visible all at once or not at all.

Every row names its unit, such as the file it came from, and says whether it is sound.
Tasks write the rows of a unit to staged files and tell how many sound and broken rows
of each unit they saw; the driver, which sees these counts only, then writes one marker
that lists the units without a broken row and the staged files they lie in. Readers go
by the markers. A failed task, a lost job or a broken row leaves its unit invisible, and
the rows are read once, moved nowhere and joined with nothing.

A run writes under a name of its own; written again, it replaces its marker and thereby
what it published.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from rillworks.session import path_exists

# Executors get these classes with the query and need not install the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "committed_units"
STAGED, MARKERS = "staged", "committed"
MARKER = "run string, unit string, records bigint, files array<string>"
#: Rows that a task holds per unit before they go to its file.
_HELD_ROWS = 50_000


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class TaskUnits(WriterCommitMessage):
    """What one task saw of each unit: sound rows, broken rows, the file with the sound ones."""

    sound: dict[str, int] = field(default_factory=dict)
    broken: dict[str, int] = field(default_factory=dict)
    files: dict[str, str] = field(default_factory=dict)


class _Staging:
    """Files of one task, one per unit it meets; a unit with a broken row keeps none."""

    def __init__(self, home: str, unit: str, ok: str) -> None:
        self.home, self.unit, self.ok = home, unit, ok
        self.system, self.root = _open(home)
        self.writers: dict = {}
        self.sound: Counter[str] = Counter()
        self.broken: Counter[str] = Counter()
        self.files: dict[str, str] = {}

    def add(self, batch) -> None:
        import pyarrow as pa
        import pyarrow.compute as pc

        units = batch.column(batch.schema.get_field_index(self.unit)).dictionary_encode()
        good = pc.fill_null(batch.column(batch.schema.get_field_index(self.ok)), False)
        for k, unit in enumerate(units.dictionary.to_pylist()):
            mine = pc.equal(units.indices, k)
            some = batch.filter(pc.and_(mine, good))
            self.sound[unit] += some.num_rows
            self.broken[unit] += pc.sum(mine).as_py() - some.num_rows
            if self.broken[unit]:
                self._drop(unit)
            elif some.num_rows:
                self._write(unit, pa.Table.from_batches([some.drop_columns([self.ok])]))

    def _write(self, unit: str, rows) -> None:
        import pyarrow.parquet as pq

        if unit not in self.writers:
            name = f"{uuid.uuid4().hex}.parquet"
            self.system.create_dir(self.root, recursive=True)
            self.files[unit] = f"{self.home}/{name}"
            self.writers[unit] = pq.ParquetWriter(f"{self.root}/{name}", rows.schema, filesystem=self.system)
        self.writers[unit].write_table(rows)

    def _drop(self, unit: str) -> None:
        if unit in self.writers:
            self.writers.pop(unit).close()
            self.system.delete_file(_open(self.files.pop(unit))[1])

    def close(self) -> TaskUnits:
        for writer in self.writers.values():
            writer.close()
        return TaskUnits(dict(self.sound), {u: n for u, n in self.broken.items() if n}, dict(self.files))

    def discard(self) -> None:
        for unit in list(self.writers):
            self._drop(unit)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.run = options["path"].rstrip("/"), options["run"]
        self.unit, self.ok = options.get("unit", "unit"), options.get("ok", "ok")

    def write(self, iterator: Iterator) -> TaskUnits:
        staging = _Staging(f"{self.path}/{STAGED}/{self.run}", self.unit, self.ok)
        try:
            for batch in iterator:
                staging.add(batch)
        except BaseException:
            staging.discard()
            raise
        return staging.close()

    def commit(self, messages: list) -> None:
        sound: Counter[str] = Counter()
        broken: Counter[str] = Counter()
        files: dict[str, list[str]] = {}
        for task in filter(None, messages):
            sound.update(task.sound)
            broken.update(task.broken)
            for unit, file in task.files.items():
                files.setdefault(unit, []).append(file)
        lines = [
            json.dumps({"run": self.run, "unit": unit, "records": n, "files": sorted(files.get(unit, []))})
            for unit, n in sorted(sound.items())
            if not broken[unit]
        ]
        system, home = _open(f"{self.path}/{MARKERS}")
        system.create_dir(home, recursive=True)
        hidden = f"{home}/_{self.run}-{uuid.uuid4().hex}"
        with system.open_output_stream(hidden) as marker:
            marker.write("\n".join(lines).encode())
        system.move(hidden, f"{home}/{self.run}.json")
        self._delete([f for unit, some in files.items() if broken[unit] for f in some])

    def abort(self, messages: list) -> None:
        self._delete([file for task in filter(None, messages) for file in task.files.values()])

    @staticmethod
    def _delete(files: list[str]) -> None:
        for file in files:
            system, path = _open(file)
            system.delete_file(path)


class CommittedUnits(DataSource):
    """A sink for rows with a unit and a flag; options ``path``, ``run``, ``unit``, ``ok``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options))


def publish_units(rows: DataFrame, path: str, run: str, unit: str = "unit", ok: str = "ok") -> None:
    """Publish the units of ``rows`` that have no row whose ``ok`` is not true.

    A null unit is a unit of its own, named by the empty text.
    """
    rows.sparkSession.dataSource.register(CommittedUnits)
    named = rows.withColumn(unit, F.coalesce(F.col(unit).cast("string"), F.lit("")))
    named.write.format(FORMAT).mode("append").options(path=path, run=run, unit=unit, ok=ok).save()


def committed_units(spark: SparkSession, path: str) -> DataFrame:
    """``run, unit, records, files`` of everything published."""
    if not path_exists(spark, f"{path}/{MARKERS}"):
        return spark.createDataFrame([], MARKER)
    return spark.read.schema(MARKER).json(f"{path}/{MARKERS}")


def read_units(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The rows of all published units; staged files that no marker lists are not read."""
    found = committed_units(spark, path).select(F.explode("files").alias("file")).distinct()
    files = [row["file"] for row in found.collect()]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files)
