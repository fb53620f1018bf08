"""Run every query on a plain session and compare with SQL: names, counts, values.

Usage: python -m tests.check_default_session [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import SparkSession

import __spark_entry__ as registered
from tests.compare import spark_result, sql_result


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(registered.oracle_sql())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = []
    for name in wanted:
        start = time.perf_counter()
        got_names, got = spark_result(registered.queries()[name](spark, sf))
        took = time.perf_counter() - start
        want_names, want = sql_result(sf, registered.oracle_sql()[name])
        ok = got_names == want_names and got == want
        failed += [] if ok else [name]
        print(f"{'ok  ' if ok else 'DIFF'} {name} rows={sum(got.values())} {took:.1f}s", flush=True)
        if not ok:
            print(got_names, want_names, list((got - want).items())[:3], list((want - got).items())[:3])
    spark.stop()
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
