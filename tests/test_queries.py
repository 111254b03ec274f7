"""Every named query against its SQL counterpart, on the given tables and on skewed ones, and its plan."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from telemaque.plans import catalog, oracle
from tests.compare import compare, connect

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.QUERIES, oracle.ORACLE_SQL

# Bytecode size up to which the JVM compiles a method.
JIT_LIMIT = 8000


@pytest.fixture(scope="module")
def small():
    return connect(SMALL)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The small tables with a third of all events on one user, half of them within a single hour."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    hot = F.col("event_id") % 3 == 0
    crowded = hot & (F.col("event_id") % 2 == 0)
    hour = F.to_timestamp_ntz(F.lit("2024-01-10 12:00:00")) + F.make_dt_interval(secs=F.col("event_id") % 3600)
    events.withColumns(
        {"user_id": F.when(hot, F.lit(3)).otherwise(F.col("user_id")), "ts": F.when(crowded, hour).otherwise(F.col("ts"))}
    ).write.parquet(f"{folder}/events.parquet")
    con = connect(SMALL)
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    return folder, con


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(entry.queries())
    assert not [name for name in QUERIES if "pipeline" in name]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql_by_a_sound_plan(spark, small, name):
    df = QUERIES[name](spark, SMALL)
    assert compare(df, small, SQL[name]) == ""
    # As it ran: the stages after a shuffle are planned while running.
    plan = df._jdf.queryExecution()
    text = plan.executedPlan().toString().split("== Initial Plan ==")[0]
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|ArrowEval|MapInPandas|Scan ExistingRDD", text)
    # Each topic read is one branch with one parse.
    assert text.count("from_json(") <= text.count("FileScan")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan.explainString(mode))]
    assert all(size < JIT_LIMIT for size in sizes)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql_under_skew(spark, skewed, name):
    folder, con = skewed
    assert compare(QUERIES[name](spark, folder), con, SQL[name]) == ""


@pytest.mark.parametrize(
    "name, columns",
    [
        ("trip_distance", {"event_id", "user_id", "value"}),
        ("trip_status", {"event_id", "ts", "user_id", "event_type"}),
        ("emergency_normalize", {"event_id", "ts", "user_id", "event_type"}),
        ("trip_typed", {"event_id", "ts", "user_id", "event_type", "value"}),
    ],
)
def test_scans_read_only_what_is_needed(spark, name, columns):
    text = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {field.split(":")[0] for field in schema.split(",")} == columns


def test_filters_reach_the_scan(spark):
    text = QUERIES["emergency_normalize"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in text


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


def test_busy_trips_are_split_at_run_time(spark, skewed):
    """A join partition with most of the rows is read by several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "8KB",
        "spark.sql.files.openCostInBytes": "1KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        many = spark.read.parquet(f"{skewed[0]}/events.parquet").repartition(8)
        folder = skewed[0] + "-parts"
        many.write.mode("overwrite").parquet(f"{folder}/events.parquet")
        for name in ("trip_vehicle", "trip_emergency", "trip_weather", "dedupe_columns"):
            df = QUERIES[name](spark, folder)
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString(), name
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
