"""Side-by-side results of a Spark query and its SQL."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def sql_result(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    return _sorted(names, result.fetchall())


def spark_result(df) -> tuple[list[str], Counter]:
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


def _sorted(names: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)
