"""The ``events`` table seen as the four topics.

Every event is a position ping of the trip of its user; sign-ups register the trip's vehicle,
errors are emergencies, views are weather reports. Plain projections (plus one aggregate for the
vehicles), so column pruning and filters reach the parquet scan, and everything but the vehicles
can also be read as a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemaque.operators.codec import encode_text, encode_topic
from telemaque.schemas import TOPICS
from telemaque.sources.topics import FILES_PER_BATCH

# The value domains of the producer.
CONDITIONS = ("RAIN", "SNOW", "CLOUDY")
WIND_DIRS = ("W", "S", "O", "E")
EMERGENCY_TYPES = ("ACCIDENT", "FIRE", "POLICE", "MEDICAL", "NONE")
EMERGENCY_STATUSES = ("RESOLVED", "ON GOING")

# Messages have no key, so a producer deals them out over the partitions.
PARTITIONS = 4
REDELIVERY_SHIFT = 1 << 40


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Messages carry wall-clock times without a zone; all results are stated in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = events_table(spark, sf_dir).schema
    # A pattern, as a stream takes a folder or a pattern but not one single file.
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH)
    return reader.parquet(f"{sf_dir}/events.parque[t]")


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


def _tagged(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _place(number: Column) -> list[Column]:
    return [(number % PARTITIONS).cast("int").alias("partition"), _div(number, PARTITIONS).alias("offset")]


def _gps(name: Column, latitude: Column, longitude: Column) -> Column:
    return F.struct(
        name.alias("name"), latitude.cast("string").alias("latitude"), longitude.cast("string").alias("longitude")
    )


def trip_rows(events: DataFrame, *keep: str | Column) -> DataFrame:
    user = F.col("user_id")
    return events.select(
        *keep,
        *_place(F.col("event_id")),
        _tagged("TR", user).alias("tripId"),
        _gps(_tagged("D", user % 7), 45 + F.col("value") / 1000, -73 + F.col("value") / 1000).alias("departure"),
        _gps(_tagged("A", user % 5), 46.5 + (user % 10) / 10.0, F.lit(-71.5)).alias("arrival"),
        F.col("ts").cast("timestamp").alias("heure_depart"),
        (F.col("event_type") == "purchase").alias("flag_arrivee"),
    )


def arrival_rows(events: DataFrame, *keep: str | Column) -> DataFrame:
    """The arrival ping of each trip that has ended (those of users with an even number).

    It repeats the time and the position of the trip's last ping, with the flag set, and has come in by another
    partition, at a lower offset: only the flag shows that it is the later one.
    """
    place = _place(F.col("event_id"))
    last = F.max_by(F.struct("event_id", "ts", "event_type", "value"), F.struct("ts", *place)).alias("last")
    ended = events.where(F.col("user_id") % 2 == 0).groupBy("user_id").agg(last).select("user_id", "last.*")
    elsewhere = {"partition": (F.col("partition") + 1) % PARTITIONS, "offset": F.col("offset") - 1, "flag_arrivee": F.lit(True)}
    return trip_rows(ended, *keep).withColumns(elsewhere)


def stored_rows(events: DataFrame, *keep: str | Column) -> DataFrame:
    """All pings of the trips, arrivals included."""
    return trip_rows(events, *keep).unionByName(arrival_rows(events, *keep))


def vehicle_rows(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    first = events.where(F.col("event_type") == "signup").groupBy("user_id").agg(F.min("ts").alias("ts"))
    return first.select(
        *_place(user),
        _tagged("V", user).alias("immatriculation"),
        _tagged("VIN", user).alias("vin"),
        _tagged("Make ", user % 14).alias("marque"),
        (2010 + user % 15).cast("int").alias("année"),
        _tagged("Color ", user % 7).alias("color"),
        _tagged("Fuel ", user % 4).alias("fuelType"),
        _tagged("TR", user).alias("IDTrajet"),
        _tagged("C", user).alias("IDChauffeur"),
        F.lit(0.0).cast("float").alias("speed"),
        F.col("ts").cast("timestamp").alias("DateDebutTrajet"),
    )


def emergency_rows(events: DataFrame) -> DataFrame:
    """Status as drawn, before the rule for type NONE."""
    user, event = F.col("user_id"), F.col("event_id")
    return events.where(F.col("event_type") == "error").select(
        *_place(event),
        F.col("ts").cast("timestamp").alias("EmergencyTime"),
        _tagged("V", user).alias("evehicleID"),
        _tagged("TR", user).alias("emergencyTrip"),
        _pick(EMERGENCY_TYPES, event).alias("emergencyType"),
        _pick(EMERGENCY_STATUSES, event).alias("emergencyStatus"),
    )


def weather_rows(events: DataFrame) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    return events.where(F.col("event_type") == "view").select(
        *_place(event),
        F.col("ts").cast("timestamp").alias("WeatherTime"),
        _tagged("V", user).alias("wvehicleID"),
        _tagged("TR", user).alias("weatherTrip"),
        _pick(CONDITIONS, event).alias("weatherCondition"),
        (event % 61 - 30).cast("int").alias("temperature"),
        (event % 51).cast("int").alias("wind_speed"),
        _pick(WIND_DIRS, event).alias("wind_dir"),
        (event % 61).cast("int").alias("wind_degree"),
        (event % 101).cast("int").alias("humidity"),
    )


ROWS = {"trajet": trip_rows, "cars": vehicle_rows, "emergency": emergency_rows, "weather": weather_rows}


def messages(events: DataFrame, topic: str) -> DataFrame:
    """The topic's messages in the envelope's shape."""
    spec = TOPICS[topic]
    return ROWS[topic](events).transform(encode_topic(spec.schema, spec.kafka_topic, spec.event_time))


def damaged_messages(events: DataFrame) -> DataFrame:
    """Trip messages, of which some cannot be used.

    Instead of the trip, ``error`` events carry their raw properties (an object without the
    fields), ``signup`` events a text cut off in the middle, and ``view`` events no bytes at all.
    """
    kind = F.col("event_type")
    damage = (
        F.when(kind == "error", F.col("props"))
        .when(kind == "signup", F.concat(F.lit('{"tripId":"'), F.col("tripId")))
        .when(kind == "view", F.lit(""))
    )
    spec = TOPICS["trajet"]
    rows = trip_rows(events, "event_type", "props")
    text = F.coalesce(damage, encode_text(spec.schema))
    return rows.transform(encode_topic(spec.schema, spec.kafka_topic, spec.event_time, text))


def redelivered_messages(events: DataFrame) -> DataFrame:
    """Trip messages, those of ``purchase`` events delivered a second time at a later offset."""
    again = F.array(F.lit(0), F.lit(1))
    copies = F.when(F.col("event_type") == "purchase", again).otherwise(F.array(F.lit(0)))
    sent = events.withColumn("_copy", F.explode(copies))
    spec = TOPICS["trajet"]
    shifted = trip_rows(sent, "_copy").withColumn("offset", F.col("offset") + F.col("_copy") * REDELIVERY_SHIFT)
    return shifted.transform(encode_topic(spec.schema, spec.kafka_topic, spec.event_time))


def note() -> Column:
    """A text that is hard to store: line breaks, quotes, outer blanks, backslashes, empty, NULL."""
    texts = ("a\nb", "", " x ", 'say "yes", no', "c:\\new\\\r\n")
    place = ((F.col("offset") * PARTITIONS + F.col("partition")) % (len(texts) + 1)).cast("int")
    return F.get(F.array(*map(F.lit, texts)), place)
