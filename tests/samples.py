"""One message per topic, all of the same trip, and helpers to put texts into envelopes."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from telemaque.schemas import ENVELOPE

T0 = datetime(2025, 1, 1, 10, 0, 5)
SAMPLE_TIME = datetime(2031, 5, 6, 7, 8, 9)

TRIP_TEXT = json.dumps(
    {
        "tripId": "T-0042",
        "departure": {"name": "Depot", "latitude": "45.125", "longitude": "-72.5"},
        "arrival": {"name": "Harbour", "latitude": "45.875", "longitude": "-73.25"},
        "heure_depart": "2031-05-06T07:08:09",
        "flag_arrivee": "no",
    }
)
VEHICLE_TEXT = json.dumps(
    {
        "immatriculation": "ZZ-77", "vin": "VIN-77", "marque": "Make 7", "année": "2019",
        "color": "Color 3", "fuelType": "Fuel 1", "IDTrajet": "T-0042", "IDChauffeur": "D-5",
        "speed": 12.5, "DateDebutTrajet": "2031-05-06T07:08:09",
    },
    indent=2,
)
EMERGENCY_TEXT = json.dumps(
    {
        "EmergencyTime": "2031-05-06T07:10:00", "evehicleID": "ZZ-77", "emergencyTrip": "T-0042",
        "emergencyType": "FIRE", "emergencyStatus": "RESOLVED",
    },
    indent=2,
)
WEATHER_TEXT = json.dumps(
    {
        "WeatherTime": "2031-05-06T07:11:00", "wvehicleID": "ZZ-77", "weatherTrip": "T-0042",
        "weatherCondition": "CLOUDY", "temperature": 11, "wind_speed": 7, "wind_dir": "S", "wind_degree": 31,
        "humidity": 64,
    },
    indent=2,
)


def trip_text(trip="T1", lat="46.0", lon="-71.0", time="2025-01-01T10:00:05", flag=False, **more) -> str:
    return json.dumps(
        {
            "tripId": trip,
            "departure": {"name": "A", "latitude": lat, "longitude": lon},
            "arrival": {"name": "B", "latitude": "46.5", "longitude": "-71.5"},
            "heure_depart": time,
            "flag_arrivee": flag,
            **more,
        }
    )


def envelope(spark, values, topic="trajet_data1", partition=0):
    """Messages with the given texts, bytes or NULLs, in order of their offsets."""
    rows = [
        (None, v.encode() if isinstance(v, str) else v, topic, partition, i, T0 + timedelta(seconds=i), 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, ENVELOPE)


def flat_trips(spark, rows):
    """Typed flat trip rows from (partition, offset, trip, dep name, lat, lon, arr name, lat, lon, time, flag), and the
    broker's time if it isn't ``T0``."""
    return spark.createDataFrame(
        [r if len(r) == 12 else (*r, T0) for r in rows],
        "partition int, offset bigint, tripId string, departure_name string, departure_latitude double, "
        "departure_longitude double, arrival_name string, arrival_latitude double, arrival_longitude double, "
        "heure_depart timestamp, flag_arrivee boolean, timestamp timestamp",
    )
