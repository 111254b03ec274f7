from __future__ import annotations

import random
from datetime import timedelta

from telemaque.operators import upserts
from telemaque.operators.dedupe import dedupe_events
from tests.samples import T0, flat_trips


def ping(offset, trip="T1", seconds=0.0, lat=46.0, flag=False, partition=0, time=T0):
    when = None if time is None else time + timedelta(seconds=seconds)
    return (partition, offset, trip, "A", lat, -71.0, "B", 46.5, -71.5, when, flag)


def test_pings_of_one_second_collapse_to_the_last(spark):
    rows = [ping(0, seconds=0.1, lat=1.0), ping(1, seconds=0.8, lat=2.0), ping(2, seconds=1.2, lat=3.0),
            ping(3, trip="T2", seconds=0.1, lat=4.0), ping(4, time=None)]
    points = flat_trips(spark, rows).transform(upserts.point_upsert()).collect()
    assert sorted((p["tripId"], p["epoch_s"], p["departure_latitude"]) for p in points) == [
        ("T1", 1735725605, 2.0), ("T1", 1735725606, 3.0), ("T2", 1735725605, 4.0),
    ]


def test_an_arrival_at_the_time_of_another_ping_is_the_last(spark):
    rows = [ping(10), (*ping(3, flag=True, partition=1), T0), (*ping(11), T0 + timedelta(seconds=1))]
    status = flat_trips(spark, rows).transform(upserts.trip_status()).collect()
    assert [(r["arrived"], r["open"]) for r in status] == [(True, False)]


def test_equal_times_and_flags_are_settled_by_the_brokers_time_then_the_place(spark):
    rows = [(*ping(2, lat=1.0), T0 - timedelta(seconds=1)), ping(9, lat=5.0), ping(6, lat=6.0), ping(7, lat=8.0, partition=1)]
    for _ in range(3):
        random.shuffle(rows)
        flat = flat_trips(spark, rows).repartition(3)
        assert [r["departure_latitude"] for r in flat.transform(upserts.trip_latest()).collect()] == [8.0]
        assert [r["departure_latitude"] for r in flat.transform(upserts.point_upsert()).collect()] == [8.0]


def test_latest_document_keeps_all_columns_and_drops_missing_keys(spark):
    rows = [ping(0), ping(1, seconds=5, flag=True), ping(2, trip=None, seconds=9), ping(3, time=None, lat=9.0)]
    latest = flat_trips(spark, rows).transform(upserts.trip_latest())
    assert sorted(latest.columns) == sorted(flat_trips(spark, rows).columns)
    assert [(r["tripId"], r["offset"]) for r in latest.collect()] == [("T1", 1)]


def test_status(spark):
    rows = [
        ping(0, "open"), ping(1, "open", 1), ping(2, "closed"), ping(3, "closed", 1, flag=True),
        ping(4, "reopened", flag=True), ping(5, "reopened", 1), ping(6, "unknown", flag=None),
    ]
    status = {r["tripId"]: (r["arrived"], r["open"]) for r in flat_trips(spark, rows).transform(upserts.trip_status()).collect()}
    assert status == {
        "open": (False, True), "closed": (True, False), "reopened": (False, True), "unknown": (None, True),
    }


def test_a_busy_key_is_reduced_before_the_shuffle(spark):
    flat = spark.range(0, 20000, numPartitions=8).selectExpr(
        "0 as partition", "id as offset", "'T' as tripId", "timestamp_micros(id) as heure_depart", "true as flag_arrivee", "timestamp_micros(id) as timestamp"
    )
    status = flat.transform(upserts.trip_status())
    status.collect()
    exchange = _find(status._jdf.queryExecution().executedPlan(), "Exchange")
    assert exchange.metrics().apply("shuffleRecordsWritten").value() == 8


def _find(plan, name):
    """The first node of that name below adaptive wrappers."""
    for step in ("executedPlan", "plan"):
        if plan.nodeName() in ("AdaptiveSparkPlan", "ShuffleQueryStage", "ResultQueryStage") and hasattr(plan, step):
            try:
                return _find(getattr(plan, step)(), name)
            except Exception:  # noqa: BLE001 - the wrapper has the other method
                continue
    if plan.nodeName() == name:
        return plan
    children = plan.children()
    for i in range(children.size()):
        found = _find(children.apply(i), name)
        if found is not None:
            return found
    return None


def test_copies_are_dropped(spark):
    rows = [ping(0), ping(1), ping(2, seconds=1), ping(3, lat=47.0)]
    flat = flat_trips(spark, rows).drop("partition", "offset", "timestamp")
    assert flat.transform(dedupe_events(flat.columns)).count() == 3
