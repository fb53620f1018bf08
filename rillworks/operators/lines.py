"""Lines to keyed JSON records, singly or all-or-nothing per file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillworks.functions import strict_int
from rillworks.schemas import ID_FIELD, TITLE_FIELD


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``key``, the id, the title, ``value`` as JSON and ``ok``.

    Commas always split, quotes mean nothing, trailing empty fields do not
    count. The key keeps the raw text of the first field.
    """
    fields = F.split(F.regexp_replace("line", ",+$", ""), ",", -1)
    return (
        lines.withColumn("_fields", fields)
        .withColumn("key", F.get("_fields", F.lit(0)))
        .withColumn(ID_FIELD, strict_int(F.col("key")))
        .withColumn(TITLE_FIELD, F.get("_fields", F.lit(1)))
        .withColumn("ok", F.col(ID_FIELD).isNotNull() & F.col(TITLE_FIELD).isNotNull())
        .withColumn("value", F.to_json(F.struct(ID_FIELD, TITLE_FIELD)))
        .drop("_fields")
    )


def keep_whole_units(parsed: DataFrame, unit: str = "file") -> DataFrame:
    """Only lines of units without any bad line; a blank line is a bad one.

    The bad units shrink to one row each before the exchange. Where that list
    is small the anti join leaves the lines in place; where it is not, a unit
    with most of the lines is split, for which the join has a key of its own.
    """
    key = F.concat(F.lit("unit "), unit).alias("_unit")
    bad = parsed.where("not ok").select(unit).distinct().select(key)
    return parsed.select("*", key).join(bad, "_unit", "left_anti").drop("_unit")
