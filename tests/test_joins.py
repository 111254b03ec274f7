from __future__ import annotations

import random
from collections import Counter
from datetime import timedelta

from pyspark.sql import functions as F

from telemaque.operators import codec, views
from telemaque.operators.intervals import interval_join, interval_totals
from telemaque.schemas import EMERGENCY, TRIP, VEHICLE, WEATHER
from telemaque.streaming.joins import trip_view_stream
from tests.samples import EMERGENCY_TEXT, T0, TRIP_TEXT, VEHICLE_TEXT, WEATHER_TEXT, envelope, flat_trips


def fleet(spark, seed=1, trips=4, pings=60, reports=25, span_s=40 * 3600):
    """Random topics; trip T0 has far more of everything, and times often fall together."""
    rnd = random.Random(seed)

    def when():
        return T0 + timedelta(seconds=rnd.randrange(0, span_s, 1800))

    def some_trip():
        return f"T{rnd.choice([0, 0, *range(trips)])}"

    ping_rows = [
        (i % 2, i, some_trip(), "A", rnd.uniform(45, 47), -71.0, "B", 46.5, -71.5, when(), rnd.random() < 0.1)
        for i in range(pings)
    ]
    cars = [(f"V{i}", f"T{i}", T0 + timedelta(hours=i), 0, i) for i in range(trips)] + [("V0b", "T0", T0, 0, 99)]
    alarms = [(some_trip(), when(), rnd.choice(["FIRE", "NONE"]), rnd.choice(["ON GOING", "RESOLVED"])) for _ in range(reports)]
    sky = [(some_trip(), when(), rnd.choice(["RAIN", "SNOW"]), rnd.randint(-30, 30), i % 40, i % 100) for i in range(reports)]
    return (
        flat_trips(spark, ping_rows),
        spark.createDataFrame(cars, "immatriculation string, IDTrajet string, DateDebutTrajet timestamp, partition int, offset bigint"),
        spark.createDataFrame(alarms, "emergencyTrip string, EmergencyTime timestamp, emergencyType string, emergencyStatus string"),
        spark.createDataFrame(sky, "weatherTrip string, WeatherTime timestamp, weatherCondition string, temperature int, wind_speed int, humidity int"),
    )


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_the_four_samples_make_one_row(spark):
    def read(text, schema):
        return envelope(spark, [text]).transform(codec.decode_topic(schema))

    view = read(TRIP_TEXT, TRIP).transform(
        views.trip_view(read(VEHICLE_TEXT, VEHICLE), read(EMERGENCY_TEXT, EMERGENCY), read(WEATHER_TEXT, WEATHER))
    )
    rows = view.collect()
    assert len(rows) == 1
    assert not set(views.JOIN_KEYS) & set(view.columns)
    assert rows[0]["departure_location"].asDict() == {"lat": "45.125", "lon": "-72.5"}
    assert (rows[0]["immatriculation"], rows[0]["weatherCondition"], rows[0]["emergencyType"]) == ("ZZ-77", "CLOUDY", "FIRE")


def test_profiles_and_summary_agree_with_the_plain_joins(spark):
    trips, cars, alarms, sky = fleet(spark)
    cars = cars.drop("partition", "offset")
    plain_alarm = trips.transform(views.join_emergency(alarms))
    profile = trips.transform(views.trip_emergency(alarms))
    assert profile.agg(F.sum("n_reports")).collect()[0][0] == plain_alarm.count()
    assert rows_of(profile.select("offset", "emergencyType", "emergencyStatus", "n_reports")) == rows_of(
        plain_alarm.groupBy("offset", "emergencyType", "emergencyStatus").count()
    )
    plain_sky = trips.transform(views.join_weather(sky))
    assert rows_of(trips.transform(views.trip_weather(sky)).select("offset", "weatherCondition", "n_reports", "max_wind_speed")) == rows_of(
        plain_sky.groupBy("offset", "weatherCondition").agg(F.count("*"), F.max("wind_speed"))
    )
    plain = trips.transform(views.trip_view(cars, alarms, sky))
    summary = trips.transform(views.trip_summary(cars, alarms, sky))
    assert rows_of(summary.select("tripId", "view_rows", "min_temperature", "ever_arrived")) == rows_of(
        plain.groupBy("tripId").agg(F.count("*"), F.min("temperature"), F.max("flag_arrivee"))
    )


def near(a, b, within_s):
    return a is not None and b is not None and abs((a - b).total_seconds()) <= within_s


def test_interval_join_finds_every_pair_once(spark):
    for seed in range(3):
        trips, _, alarms, _ = fleet(spark, seed)
        joined = trips.transform(
            interval_join(alarms, ("tripId", "emergencyTrip"), ("heure_depart", "EmergencyTime"), 5400)
        )
        pings, reports = trips.collect(), alarms.collect()
        expected = Counter(
            (p["offset"], e["EmergencyTime"], e["emergencyType"], e["emergencyStatus"])
            for p in pings for e in reports
            if p["tripId"] == e["emergencyTrip"] and near(p["heure_depart"], e["EmergencyTime"], 5400)
        )
        assert rows_of(joined.select("offset", "EmergencyTime", "emergencyType", "emergencyStatus")) == expected


def test_interval_totals_equal_sums_over_pairs(spark):
    for seed in range(3):
        trips, _, _, sky = fleet(spark, seed)
        unknown = flat_trips(spark, [
            (0, 900, None, "A", 1.0, 1.0, "B", 1.0, 1.0, T0, True), (0, 901, "T0", "A", 1.0, 1.0, "B", 1.0, 1.0, None, True),
            (0, 902, "T-none", "A", 1.0, 1.0, "B", 1.0, 1.0, T0, True),
        ])
        trips = trips.unionByName(unknown).unionByName(trips.limit(5))
        totals = trips.transform(
            interval_totals(
                sky, ("tripId", "weatherTrip"), ("heure_depart", "WeatherTime"), 7200,
                {"n": F.lit(1), "warmth": F.col("temperature")},
            )
        )
        assert totals.columns == [*trips.columns, "n", "warmth"]
        marks = sky.collect()
        expected = Counter()
        for p in trips.collect():
            hits = [m for m in marks if m["weatherTrip"] == p["tripId"] and near(p["heure_depart"], m["WeatherTime"], 7200)]
            expected[(p["offset"], len(hits), sum(m["temperature"] for m in hits))] += 1
        assert rows_of(totals.select("offset", "n", "warmth")) == expected


def test_near_view_sizes_equal_the_bounded_join(spark):
    trips, cars, alarms, sky = fleet(spark, 7)
    cars = cars.drop("partition", "offset")
    bound = 6 * 3600
    rows = trips.transform(trip_view_stream(cars, alarms, sky, bound, 400 * 3600, "1 hour"))
    sizes = trips.transform(views.trip_view_near(cars, alarms, sky, bound))
    assert rows_of(sizes.select("offset", "view_rows")) == rows_of(rows.groupBy("offset").count())


def test_released_and_available_vehicles(spark):
    def ping(offset, trip, seconds, flag):
        return (0, offset, trip, "A", 1.0, 1.0, "B", 1.0, 1.0, T0 + timedelta(seconds=seconds), flag)

    trips = flat_trips(spark, [
        ping(0, "T1", 0, False), ping(1, "T1", 1, True), ping(2, "T1", 2, True), ping(3, "T2", 0, False),
        ping(4, "T3", 0, True), ping(5, "T3", 1, False), ping(6, "T4", 0, True),
    ])
    schema = "immatriculation string, IDTrajet string, DateDebutTrajet timestamp, partition int, offset bigint"
    cars = spark.createDataFrame(
        [
            ("done", "T1", T0, 0, 0), ("driving", "T2", T0, 0, 1), ("again", "T4", T0, 0, 2),
            ("again", "T3", T0 + timedelta(hours=1), 0, 3), ("parked", "T9", T0, 0, 4),
            ("twice", "T1", T0, 0, 5), ("twice", "T4", T0 + timedelta(hours=1), 0, 6),
        ],
        schema,
    )
    released = cars.transform(views.released_vehicles(trips)).collect()
    assert sorted((r["immatriculation"], r["IDTrajet"]) for r in released) == [
        ("again", "T3"), ("again", "T4"), ("done", "T1"), ("twice", "T1"), ("twice", "T4"),
    ]
    free = cars.transform(views.available_vehicles(trips)).collect()
    assert sorted((r["immatriculation"], r["IDTrajet"]) for r in free) == [("done", "T1"), ("twice", "T4")]
