"""Messages: normalizing, one-field extraction, and what to do with bad input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillworks.functions import malformed_sql, read_fields

POLICIES = ("skip", "empty", "fail_job")


def reject_flagged(df: DataFrame, bad: Column) -> DataFrame:
    """The rows a policy would not let through, unchanged."""
    return df.where(bad)


def apply_policy(df: DataFrame, bad: Column, policy: str, value: str) -> DataFrame:
    """Drop bad rows, empty their ``value``, or end the job at the first one."""
    if policy == "skip":
        return df.where(~bad)
    if policy == "empty":
        return df.withColumn(value, F.when(bad, F.lit("")).otherwise(F.col(value)))
    if policy == "fail_job":
        stop = F.raise_error(F.lit("a record is not valid JSON")).cast("string")
        return df.withColumn(value, F.when(bad, stop).otherwise(F.col(value)))
    raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")


def normalize_payload(messages: DataFrame, policy: str = "fail_job") -> DataFrame:
    """``{id, username, message}`` with defaults, as columns beside the input.

    ``policy='empty'`` keeps a bad row with all three defaults.
    """
    read = read_fields(
        messages, "value", {"id": "id"}, {"username": "username", "message": "message"}
    )
    bad = F.col("malformed")
    clean = apply_policy(read, bad, policy, "value")
    if policy == "empty":
        clean = clean.withColumns(
            {
                "id": F.when(bad, 0).otherwise(F.col("id")),
                "username": F.when(bad, "").otherwise(F.col("username")),
                "message": F.when(bad, "").otherwise(F.col("message")),
            }
        )
    return clean.drop("malformed")


def rejected_payloads(messages: DataFrame) -> DataFrame:
    """The messages whose value is not JSON: those that ``skip`` drops."""
    return reject_flagged(messages, ~is_json("value"))


def payload_json() -> Column:
    """The normalized message as the JSON text that goes to a topic."""
    return F.to_json(F.struct("id", "username", "message"))


def with_username(messages: DataFrame) -> DataFrame:
    """Add ``username`` and key the record by it; no username, no record."""
    read = read_fields(messages, "value", texts={"username": "username"})
    return (
        read.where("not malformed and username <> ''")
        .withColumn("key", F.col("username"))
        .drop("malformed")
    )


def is_json(text: str) -> Column:
    """Guard before a write: the text of a column parses; empty text does."""
    return ~F.expr(malformed_sql(f"`{text}`"))


def guarded(records: DataFrame, text: str = "value") -> DataFrame:
    """Foreign records that may go on to a topic as they are."""
    return records.where(is_json(text))
