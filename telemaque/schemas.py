"""Message schemas and the topic registry.

Field names, types and declared nullability are part of the data contract: they have to equal what
the vehicles send. ``from_json`` never enforces a declared ``nullable=False``; the declaration is
what :mod:`telemaque.operators.codec` checks when it routes rejected messages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

GPS = (
    T.StructType()
    .add("name", "string", False)
    .add("latitude", "string", False)
    .add("longitude", "string", False)
)

TRIP = (
    T.StructType()
    .add("tripId", "string", False)
    .add("departure", GPS, False)
    .add("arrival", GPS, False)
    .add("heure_depart", "timestamp")
    .add("flag_arrivee", "boolean")
)

VEHICLE = (
    T.StructType()
    .add("immatriculation", "string", False)
    .add("vin", "string", False)
    .add("marque", "string", False)
    .add("année", "integer")
    .add("color", "string")
    .add("fuelType", "string")
    .add("IDTrajet", "string")
    .add("IDChauffeur", "string")
    .add("speed", "float", False)
    .add("DateDebutTrajet", "timestamp")
)

EMERGENCY = (
    T.StructType()
    .add("EmergencyTime", "timestamp", False)
    .add("evehicleID", "string", False)
    .add("emergencyTrip", "string", False)
    .add("emergencyType", "string")
    .add("emergencyStatus", "string")
)

WEATHER = (
    T.StructType()
    .add("WeatherTime", "timestamp", False)
    .add("wvehicleID", "string", False)
    .add("weatherTrip", "string", False)
    .add("weatherCondition", "string")
    .add("temperature", "integer")
    .add("wind_speed", "integer")
    .add("wind_dir", "string")
    .add("wind_degree", "integer")
    .add("humidity", "integer", False)
)

# The columns of Spark's Kafka source; replay files carry exactly these.
ENVELOPE = (
    T.StructType()
    .add("key", "binary")
    .add("value", "binary")
    .add("topic", "string")
    .add("partition", "integer")
    .add("offset", "long")
    .add("timestamp", "timestamp")
    .add("timestampType", "integer")
)


@dataclass(frozen=True)
class Topic:
    """One topic: where it lives, what it carries, and which columns identify and date a message."""

    name: str
    kafka_topic: str
    schema: T.StructType
    trip_key: str
    event_time: str


TOPICS: dict[str, Topic] = {
    t.name: t
    for t in (
        Topic("trajet", "trajet_data1", TRIP, "tripId", "heure_depart"),
        Topic("cars", "vehicle_data1", VEHICLE, "IDTrajet", "DateDebutTrajet"),
        Topic("emergency", "emergency_data1", EMERGENCY, "emergencyTrip", "EmergencyTime"),
        Topic("weather", "weather_data1", WEATHER, "weatherTrip", "WeatherTime"),
    )
}

# The order of messages of one event time: the broker's time, then the place. Offsets of different partitions
# do not compare, so they come last.
ARRIVAL_ORDER = ("timestamp", "partition", "offset")
