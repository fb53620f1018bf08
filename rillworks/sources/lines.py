"""Comma-separated files read as whole lines."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

# Executors get these functions with the query and need not install the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def raw_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Every line exactly as it is, with its file and where its block starts."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.text(path)
    return lines.select(
        F.col("value").alias("line"),
        *[c for c in lines.columns if c != "value"],
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def drop_headers(lines: DataFrame) -> DataFrame:
    """Raw lines without the first one of each file, whatever it holds.

    A file may be split between tasks; its header is the first row of the block that
    starts at 0. The lines must come straight from their scan, block by block: they are
    passed on in one go, with nothing joined or exchanged. ``at`` is a line's block plus
    its number there, so it grows along the file, and it is the same whenever the file is
    cut into the same blocks.
    """
    places = [lines.columns.index(c) for c in ("file", "block")]
    kept = [k for k, c in enumerate(lines.columns) if c != "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        held, row = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            files = batch.column(places[0]).dictionary_encode()
            code = files.indices.to_numpy(zero_copy_only=False)
            block = batch.column(places[1]).to_numpy(zero_copy_only=False)
            # Stretches of rows that one block gave.
            new = np.ones(n, bool)
            new[1:] = (code[1:] != code[:-1]) | (block[1:] != block[:-1])
            first = (files.dictionary[int(code[0])].as_py(), int(block[0]))
            new[0] = first != held
            starts = np.flatnonzero(new)
            index = np.arange(n)
            since = np.maximum.accumulate(np.where(new, index, -1))
            number = np.where(since < 0, row + index, index - since)
            held = (files.dictionary[int(code[-1])].as_py(), int(block[-1]))
            row = int(number[-1]) + 1
            keep = np.ones(n, bool)
            keep[starts[block[starts] == 0]] = False
            columns = [batch.column(k) for k in kept] + [pa.array(block + number, pa.int64())]
            names = [batch.schema.names[k] for k in kept] + ["at"]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    schema = lines.drop("block").schema.add("at", LongType())
    return lines.mapInArrow(run, schema)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines after the header of each file, with the file they come from.

    Nothing is trimmed, cut or left out: blank lines are lines.
    """
    return drop_headers(raw_lines(spark, path))
