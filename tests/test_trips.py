from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from telemaque.functions import geo
from telemaque.operators import codec, trips
from telemaque.schemas import TRIP
from telemaque.sources.files import read_json
from tests.samples import SAMPLE_TIME, T0, TRIP_TEXT, envelope, flat_trips, trip_text

FLAT = [
    "tripId", "departure_name", "departure_latitude", "departure_longitude", "arrival_name", "arrival_latitude",
    "arrival_longitude", "heure_depart", "flag_arrivee",
]


def great_circle(lat1, lon1, lat2, lon2):
    """The distance by the angle between unit vectors: another formula than the one under test."""
    def unit(lat, lon):
        la, lo = math.radians(lat), math.radians(lon)
        return math.cos(la) * math.cos(lo), math.cos(la) * math.sin(lo), math.sin(la)

    a, b = unit(lat1, lon1), unit(lat2, lon2)
    cross = math.dist((a[1] * b[2], a[2] * b[0], a[0] * b[1]), (a[2] * b[1], a[0] * b[2], a[1] * b[0]))
    return 6371.0 * math.atan2(cross, sum(x * y for x, y in zip(a, b)))


def test_the_trip_chain(spark):
    typed = envelope(spark, [TRIP_TEXT]).transform(trips.typed_trips())
    assert typed.columns == FLAT
    assert [t for _, t in typed.dtypes] == [
        "string", "string", "double", "double", "string", "double", "double", "timestamp", "boolean",
    ]
    assert tuple(typed.collect()[0]) == (
        "T-0042", "Depot", 45.125, -72.5, "Harbour", 45.875, -73.25, SAMPLE_TIME, None,
    )


def test_inferred_rows_flatten_too(spark, tmp_path):
    (tmp_path / "trip.json").write_text(TRIP_TEXT)
    inferred = read_json(spark, str(tmp_path / "trip.json"))
    assert inferred.transform(trips.flatten_trip()).columns == FLAT


def test_coordinates_that_are_no_numbers_become_null(spark):
    texts = [trip_text(lat=t) for t in ("north", "", "46,5", " 46.5 ", "1e2", None)]
    typed = envelope(spark, texts).transform(trips.typed_trips(("offset",))).orderBy("offset").collect()
    assert [r["departure_latitude"] for r in typed] == [None, None, None, 46.5, 100.0, None]
    assert all(r["departure_longitude"] == -71.0 for r in typed)


def test_distance(spark):
    rnd = random.Random(3)
    rows = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180), rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(500)]
    rows += [(0.0, 0.0, 0.0, 0.0), (10.0, 20.0, 10.0, 20.0), (90.0, 0.0, -90.0, 0.0), (0.0, 0.0, 0.0, 180.0), (7.0, -30.0, -7.0, 150.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    there, back = geo.distance_km(*map(F.col, "abcd")), geo.distance_km(*map(F.col, "cdab"))
    for row in df.select("*", there.alias("there"), back.alias("back")).collect():
        assert row["there"] == pytest.approx(great_circle(*row[:4]), abs=1e-3)
        assert row["there"] == row["back"] or math.isclose(row["there"], row["back"], rel_tol=1e-12)
        if row[0] == row[2] and row[1] == row[3]:
            assert row["there"] == 0.0


def test_distance_of_an_unknown_position_is_null(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert df.select(geo.distance_km(F.col("a"), F.col("b"), F.col("b"), F.col("b"))).collect()[0][0] is None


def test_arrival_threshold(spark):
    a_metre = 1 / 111_194.9
    rows = [
        (0, i, "T", "A", 46.0 + metres * a_metre, -71.0, "B", 46.0, -71.0, T0, False)
        for i, metres in enumerate([0.0, 0.4, 0.6, 100.0])
    ]
    rows.append((0, 9, "T", "A", None, -71.0, "B", 46.0, -71.0, T0, False))
    arrived = flat_trips(spark, rows).transform(trips.arrived_trips()).collect()
    assert sorted(r["offset"] for r in arrived) == [0, 1]
    assert "distance_km" in arrived[0].asDict()


def test_geo_points_from_nested_and_flat_rows(spark):
    nested = envelope(spark, [TRIP_TEXT]).transform(codec.decode_topic(TRIP)).transform(trips.geo_points)
    flat = envelope(spark, [TRIP_TEXT]).transform(trips.typed_trips()).transform(trips.geo_points)
    assert nested.collect()[0]["departure_location"].asDict() == {"lat": "45.125", "lon": "-72.5"}
    assert flat.collect()[0]["arrival_location"].asDict() == {"lat": 45.875, "lon": -73.25}


def test_duplicate_columns(spark):
    a = spark.createDataFrame([(1, "x", True)], "id int, name string, a boolean")
    b = spark.createDataFrame([(1, "y", False)], "id int, name string, b boolean")
    joined = a.join(b, a["id"] == b["id"])
    assert joined.columns.count("name") == 2
    assert joined.transform(trips.dedupe_columns).collect()[0].asDict() == {"id": 1, "name": "x", "a": True, "b": False}
    assert a.transform(trips.dedupe_columns).columns == a.columns


def test_emergency_status_rule(spark):
    df = spark.createDataFrame(
        [("NONE", "RESOLVED"), ("FIRE", "RESOLVED"), (None, "ON GOING"), ("FIRE", None)],
        "emergencyType string, emergencyStatus string",
    )
    statuses = [r["emergencyStatus"] for r in df.transform(trips.normalize_emergency).collect()]
    assert statuses == ["NONE", "RESOLVED", "ON GOING", None]
