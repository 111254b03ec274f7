from __future__ import annotations

import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telemaque.operators import codec
from telemaque.schemas import EMERGENCY, ENVELOPE, TOPICS, TRIP, VEHICLE, WEATHER
from telemaque.sources.files import read_json
from tests.samples import EMERGENCY_TEXT, SAMPLE_TIME, T0, TRIP_TEXT, VEHICLE_TEXT, WEATHER_TEXT, envelope, trip_text


def decode_one(spark, text, schema):
    rows = envelope(spark, [text]).transform(codec.decode_topic(schema)).collect()
    assert len(rows) == 1
    return rows[0].asDict(recursive=True)


@pytest.mark.parametrize("text", ["{not json", "", None, "[1, 2]", '{"tripId": "T1"', "   "])
def test_unreadable_messages_keep_their_row(spark, text):
    assert set(decode_one(spark, text, TRIP).values()) == {None}


def test_unknown_fields_are_ignored_and_missing_ones_null(spark):
    row = decode_one(spark, '{"tripId": "T1", "extra": 5}', TRIP)
    assert row["tripId"] == "T1" and row["departure"] is None and "extra" not in row


def test_wrong_types_null_only_their_field(spark):
    trip = decode_one(spark, TRIP_TEXT, TRIP)
    assert trip["flag_arrivee"] is None and trip["heure_depart"] == SAMPLE_TIME
    car = decode_one(spark, VEHICLE_TEXT, VEHICLE)
    assert car["année"] is None and car["marque"] == "Make 7" and car["speed"] == 12.5
    assert decode_one(spark, '{"vin": "V", "speed": "45"}', VEHICLE)["speed"] is None
    assert decode_one(spark, '{"vin": "V", "année": 99999999999}', VEHICLE)["année"] is None
    bad_time = decode_one(spark, trip_text(time="yesterday"), TRIP)
    assert bad_time["heure_depart"] is None and bad_time["tripId"] == "T1"


def test_numbers_are_accepted_as_text_and_times_keep_microseconds(spark):
    row = decode_one(spark, trip_text(lat=46.85, time="2025-01-01T10:00:05.123456"), TRIP)
    assert row["departure"]["latitude"] == "46.85"
    assert row["heure_depart"] == datetime(2025, 1, 1, 10, 0, 5, 123456)


def test_declared_required_fields_come_back_nullable(spark):
    decoded = envelope(spark, [TRIP_TEXT]).transform(codec.decode_topic(TRIP))
    assert all(field.nullable for field in decoded.schema.fields)
    assert decoded.columns == TRIP.fieldNames()


def test_the_other_topics(spark):
    assert decode_one(spark, EMERGENCY_TEXT, EMERGENCY)["emergencyStatus"] == "RESOLVED"
    weather = decode_one(spark, WEATHER_TEXT, WEATHER)
    assert (weather["temperature"], weather["wind_dir"], weather["WeatherTime"]) == (11, "S", datetime(2031, 5, 6, 7, 11))


def test_invalid_utf8_stays_readable_or_becomes_null(spark):
    messages = envelope(spark, [b'{"tripId":"T\xff1"}', "ok"])
    plain = [r[0] for r in messages.transform(codec.decode_text()).collect()]
    strict = [r[0] for r in messages.transform(codec.decode_text(strict=True)).collect()]
    assert plain == ['{"tripId":"T�1"}', "ok"] and strict == [None, "ok"]


def test_every_message_takes_exactly_one_exit(spark):
    values = [
        TRIP_TEXT, "", None, "{broken", "[1]", '{"k": 1}', b'{"tripId":"\xff"}', '{"tripId": "T"}',
        '{"tripId": "T", "departure": {"name": "x"}, "arrival": {}}', trip_text(flag="no"),
    ]
    inspected = envelope(spark, values).transform(codec.inspect_topic(TRIP, ("offset",)))
    good = [r["offset"] for r in inspected.transform(codec.accepted).collect()]
    bad = {r["offset"]: r["reason"] for r in inspected.transform(codec.rejected(TRIP)).collect()}
    assert sorted(good) == [0, 9]
    assert bad == {
        1: "empty", 2: "empty", 3: "malformed", 4: "malformed", 5: "missing tripId", 6: "invalid utf-8",
        7: "missing departure", 8: "missing departure.latitude",
    }


def test_rejected_messages_keep_their_payload(spark):
    inspected = envelope(spark, ["{broken"]).transform(codec.inspect_topic(TRIP))
    assert [r.asDict() for r in inspected.transform(codec.rejected(TRIP)).collect()] == [
        {"payload": "{broken", "reason": "malformed"}
    ]


def test_pretty_printed_files(spark, tmp_path):
    (tmp_path / "car.json").write_text(VEHICLE_TEXT)
    rows = read_json(spark, str(tmp_path / "car.json"), VEHICLE, multi_line=True).collect()
    assert len(rows) == 1 and rows[0]["immatriculation"] == "ZZ-77"


def test_inferred_and_declared_scan(spark, tmp_path):
    (tmp_path / "trip.json").write_text(TRIP_TEXT)
    inferred, declared = (read_json(spark, str(tmp_path / "trip.json"), s) for s in (None, TRIP))
    assert inferred.count() == declared.count() == 1
    assert inferred.columns == sorted(TRIP.fieldNames()) and declared.columns == TRIP.fieldNames()
    assert inferred.schema["heure_depart"].dataType.simpleString() == "string"


def test_encoded_text_is_the_producers(spark):
    sent = spark.range(1).select(
        F.lit(0).alias("partition"), F.lit(1).alias("offset"), F.lit(T0).cast("timestamp").alias("EmergencyTime"),
        *[F.lit(v).alias(c) for c, v in (("evehicleID", "V"), ("emergencyTrip", "T"), ("emergencyType", "NONE"))],
        F.lit(None).cast("string").alias("emergencyStatus"),
    ).transform(codec.encode_topic(EMERGENCY, "emergency_data1", "EmergencyTime"))
    assert sent.schema.simpleString() == ENVELOPE.simpleString()
    assert json.loads(bytes(sent.collect()[0]["value"])) == {
        "EmergencyTime": "2025-01-01T10:00:05.000000", "evehicleID": "V", "emergencyTrip": "T", "emergencyType": "NONE",
        "emergencyStatus": None,
    }


text = st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=12))
times = st.datetimes(datetime(1971, 1, 1), datetime(2100, 1, 1))
gps = st.fixed_dictionaries({"name": text, "latitude": text, "longitude": text})
trip = st.fixed_dictionaries(
    {
        "tripId": text, "departure": gps, "arrival": gps, "heure_depart": st.one_of(st.none(), times),
        "flag_arrivee": st.one_of(st.none(), st.booleans()),
    }
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trip, min_size=30, max_size=60))
def test_decoding_undoes_encoding(spark, rows):
    for field in TRIP.fields:
        assert field.name in rows[0]
    schema = "partition int, offset bigint, tripId string, departure struct<name:string,latitude:string,"
    schema += "longitude:string>, arrival struct<name:string,latitude:string,longitude:string>, "
    schema += "heure_depart timestamp, flag_arrivee boolean"
    df = spark.createDataFrame([{"partition": 0, "offset": i, **r} for i, r in enumerate(rows)], schema)
    spec = TOPICS["trajet"]
    back = df.transform(codec.encode_topic(TRIP, spec.kafka_topic, spec.event_time)).transform(
        codec.decode_topic(TRIP, ("offset",))
    )
    got = {r["offset"]: r.asDict(recursive=True) for r in back.collect()}
    for i, row in enumerate(rows):
        assert got[i] == {"offset": i, **row}
