"""What the physical plans must look like, at any size of table."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rillworks.operators.attempts import resolve_attempts
from rillworks.operators.catalogue import catalogue
from rillworks.operators.counts import count_changelog, count_messages
from rillworks.operators.enrich import enrich_or_pass
from rillworks.operators.payloads import with_username
from rillworks.plans import derived
from rillworks.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
STREAMS = {"topic_scan", "payload_index", "count_index", "ranked_index", "strict_index"}
BATCH = [n for n in QUERIES if not n.endswith("_stream") and n not in STREAMS]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join_in_batch_plans(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not re.search(r"Python|InPandas|ArrowEval|CartesianProduct|NestedLoopJoin", plan)


def test_messages_are_parsed_once_below_the_filter(spark):
    plan = plan_of(count_messages(with_username(derived.messages(spark, SF))))
    filters = [line for line in plan.splitlines() if re.search(r"\bFilter\b", line)]
    assert filters and not any("from_json" in line for line in filters)
    assert "partial_count" in plan


def test_only_needed_columns_are_scanned(spark):
    plan = plan_of(QUERIES["enrich_drop"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


def test_attempts_are_cut_before_the_exchange(spark):
    log = derived.table(spark, SF, "events")
    kind = F.when(F.col("event_type") == "error", "error").otherwise("success")
    plan = plan_of(resolve_attempts(log, ["user_id"], kind, "event_id"))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange hash") < plan.rindex("WindowGroupLimit")


def test_changelog_windows_run_per_stretch_on_one_exchange(spark):
    df = count_changelog(with_username(derived.messages(spark, SF)), ("offset",))
    df.collect()
    plan = plan_of(df).split("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1
    assert re.search(r"row_number\(\) windowspecdefinition\(username#\d+, _stretch#\d+L", plan)


def test_a_hot_key_is_split_in_the_enrichment_join(spark, tmp_path):
    """A third of the requests ask for one id: adaptive execution splits it."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 997).cast("int"))
    requests = spark.range(60_000, numPartitions=8).select(
        F.col("id").cast("string").alias("key"),
        F.concat(F.lit('{"anime_id":'), hot, F.lit(',"title":"'), F.sha2(F.col("id").cast("string"), 512), F.lit('"}')).alias("value"),
    )
    schema = "id int, seq long, body string"
    answers = spark.range(997).select(
        F.col("id").cast("int"),
        F.lit(0).cast("bigint").alias("seq"),
        F.concat(F.lit('{"id":'), "id", F.lit(',"genres":[],"studios":[]}')).alias("body"),
    )
    path = str(tmp_path / "requests")
    requests.write.parquet(path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        documents = catalogue(answers, spark.createDataFrame([], schema))
        joined = enrich_or_pass(spark.read.parquet(path), documents)
        placed = joined.withColumn("task", F.spark_partition_id())
        tasks = Counter(r.task for r in placed.collect())
        plan = plan_of(placed)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert "skew=true" in plan
    assert sum(tasks.values()) == 60_000
    assert max(tasks.values()) < 20_000


def test_documents_are_judged_once_per_id(spark):
    plan = plan_of(QUERIES["enriched_feed_strict"](spark, SF))
    above = plan[: plan.index("Join")]
    assert "from_json" not in above and "genre" not in above


def test_counting_joins_no_documents(spark):
    plan = plan_of(QUERIES["delivery_metrics"](spark, SF))
    joins = [line for line in plan.splitlines() if "document#" in line]
    assert not joins
