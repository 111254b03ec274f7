from __future__ import annotations

import random
from datetime import timedelta, timezone

from pyspark.sql import functions as F

from telemaque.functions.text import epoch_seconds, float_text, short_exponents
from telemaque.operators import trips
from telemaque.operators.payloads import payload_chunks
from tests.samples import T0, flat_trips


def shown(row) -> str:
    """The line by string formatting."""
    _, _, trip, dep, lat1, lon1, arr, lat2, lon2, time, flag = row
    seconds = int(time.replace(tzinfo=timezone.utc).timestamp())
    flag = "none" if flag is None else "true" if flag else "false"
    return (
        f"trajets,tripId={trip},departure={dep},arrival={arr} departure_latitude={lat1},departure_longitude={lon1},"
        f"arrival_latitude={lat2},arrival_longitude={lon2},flag_arrivee={flag} {seconds}"
    )


def test_lines_are_those_of_string_formatting(spark):
    rnd = random.Random(5)
    small = [5e-05, -0.00012345, 0.0009, 0.001, 0.0, -0.0, 12345678.5, 1e-9, 180.0]
    rows = []
    for i in range(400):
        number = [rnd.choice(small) if rnd.random() < 0.2 else rnd.uniform(-180, 180) for _ in range(4)]
        number = [None if rnd.random() < 0.1 else n for n in number]
        time = T0 + timedelta(microseconds=rnd.randrange(10**13))
        rows.append(
            (0, i, rnd.choice(["T1", None, "T 2"]), rnd.choice(["Depot", None]), number[0], number[1], "B, C",
             number[2], number[3], time, rnd.choice([True, False, None]))
        )
    lines = flat_trips(spark, rows).transform(trips.line_protocol(("offset",))).collect()
    assert {r["offset"]: r["line"] for r in lines} == {row[1]: shown(row) for row in rows}


def test_number_texts(spark):
    rnd = random.Random(11)
    numbers = [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-9, 15) for _ in range(3000)]
    numbers += [0.0, -0.0, 1e-4, 9.9e-5, 1e-3, 1e7, 9999999.9, 1e15, 1e16, 1e22, 5e-05]
    numbers += [float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, x double")
    got = df.select("i", short_exponents(float_text(F.col("x"))).alias("t")).collect()
    assert {r["i"]: r["t"] for r in got} == {i: repr(n) for i, n in enumerate(numbers)}


def test_epoch_seconds_cut_towards_zero(spark):
    times = ["1970-01-01 00:00:01.9", "1969-12-31 23:59:58.1", "1969-12-31 23:59:59.9", "2025-01-01 10:00:05.999999"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert [r[0] for r in df.select(epoch_seconds(F.col("t"))).collect()] == [1, -1, 0, 1735725605]


def test_a_row_without_time_has_no_line(spark):
    rows = [(0, 0, "T", "A", 1.0, 2.0, "B", 3.0, 4.0, None, True), (0, 1, "T", "A", 1.0, 2.0, "B", 3.0, 4.0, T0, True)]
    flat = flat_trips(spark, rows)
    assert [r["offset"] for r in flat.transform(trips.line_protocol(("offset",))).collect()] == [1]
    assert [r["offset"] for r in flat.transform(trips.line_protocol(("offset",), strict=True)).collect()] == [1]


def test_strict_lines(spark):
    rows = [
        (0, 0, "T 1,a=b", "Saint Jean", 5e-05, None, "", 3.0, float("nan"), T0, None),
        (0, 1, None, "A", 1.0, 2.0, "B", 3.0, 4.0, T0, True),
        (0, 2, "", "A", 1.0, 2.0, "B", 3.0, 4.0, T0, True),
        (0, 3, "T", "A", None, None, "B", None, float("inf"), T0, None),
        (0, 4, "T\nx\\", None, None, None, None, None, None, T0, False),
        (0, 5, "a\\b", "\\", None, None, None, None, None, T0, False),
        (0, 6, "\\\\", None, None, None, None, None, None, T0, False),
    ]
    lines = flat_trips(spark, rows).transform(trips.line_protocol(("offset",), strict=True)).collect()
    assert {r["offset"]: r["line"] for r in lines} == {
        0: "trajets,tripId=T\\ 1\\,a\\=b,departure=Saint\\ Jean departure_latitude=5e-05,arrival_latitude=3.0 1735725605",
        4: "trajets,tripId=T\\ x flag_arrivee=false 1735725605",
        5: "trajets,tripId=a\\b flag_arrivee=false 1735725605",
    }


def test_bodies_are_bounded_ordered_and_whole(spark):
    rows = [(p, o, f"line {p}/{o}") for p in range(3) for o in range(p * 7, p * 7 + 25)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "partition int, offset bigint, line string").repartition(5)
    bodies = df.transform(payload_chunks(10)).collect()
    assert max(b["n_lines"] for b in bodies) <= 10
    assert all(b["body"].count("\n") == b["n_lines"] - 1 for b in bodies)
    for p in range(3):
        ordered = sorted((b for b in bodies if b["partition"] == p), key=lambda b: b["chunk"])
        lines = "\n".join(b["body"] for b in ordered).split("\n")
        assert lines == [f"line {p}/{o}" for o in range(p * 7, p * 7 + 25)]


def test_no_lines_no_bodies(spark):
    empty = spark.createDataFrame([], "partition int, offset bigint, line string")
    assert empty.transform(payload_chunks()).isEmpty()
