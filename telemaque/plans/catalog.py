"""The named queries. Each takes (session, table folder) and runs over whole tables.

Operators that start from decoded rows take them straight from the bound table, so that a query
reads only the columns it needs; the codec, source, sink and stream queries go through messages.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemaque.operators import codec, trips, upserts, views
from telemaque.operators.dedupe import dedupe_events
from telemaque.operators.payloads import payload_chunks
from telemaque.plans import binding, streams
from telemaque.plans.binding import events_stream, events_table, messages
from telemaque.plans.streams import zoneless
from telemaque.schemas import TOPICS, TRIP
from telemaque.sinks.tables import append_csv, append_sink, publish, read_csv
from telemaque.sources.files import read_json
from telemaque.sources.topics import read_topic
from telemaque.streaming.runner import Sink, fan_out, run_stream
from telemaque.streaming.service import service_streams
from telemaque.workspace import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

PLACE = ("partition", "offset")
HOUR_S = 3600
LINES_PER_BODY = 1000
# The positions that the table gives are far from their targets; the threshold is as wide as gives rows.
NEAR_KM = 210.0


def flat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed flat trip rows with their place in the topic, straight from the table."""
    rows = binding.trip_rows(events_table(spark, sf_dir))
    return rows.transform(trips.flatten_trip(PLACE)).transform(trips.cast_positions)


def topic_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vehicles, emergencies (status rule applied) and weather reports."""
    events = events_table(spark, sf_dir)
    emergencies = binding.emergency_rows(events).transform(trips.normalize_emergency)
    return (
        binding.vehicle_rows(events),
        emergencies.drop(*PLACE),
        binding.weather_rows(events).drop(*PLACE),
    )


# -- sources -----------------------------------------------------------------------------------


def topic_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Send the trip messages to a replay folder, stream them back, decode, store, read."""
    root = fresh_dir(spark, "topic_replay")
    topic = TOPICS["trajet"].kafka_topic
    publish(messages(events_table(spark, sf_dir), "trajet"), topic, replay=f"{root}/topics")
    stream = read_topic(spark, topic, replay=f"{root}/topics")
    decoded = stream.transform(codec.decode_topic(TRIP, PLACE)).transform(trips.flatten_trip(PLACE))
    return zoneless(spark.read.parquet(run_stream(decoded, Sink("decoded"), root)))


def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per topic. Decoding keeps every message, so the counts need no parse."""
    events = events_table(spark, sf_dir)
    counts = [
        messages(events, name)
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(spec.kafka_topic).alias("topic"), "n_rows")
        for name, spec in TOPICS.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _json_lines(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "json_lines")
    append_sink(messages(events_table(spark, sf_dir), "trajet").transform(codec.decode_text()), path, "text")
    return path


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_json(spark, _json_lines(spark, sf_dir)).transform(trips.flatten_trip())


def json_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(read_json(spark, _json_lines(spark, sf_dir), TRIP).transform(trips.flatten_trip()))


# -- codec -------------------------------------------------------------------------------------


def decode_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(events_table(spark, sf_dir), "trajet").transform(codec.decode_text(PLACE))


def parse_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested positions shown as JSON text."""
    parsed = messages(events_table(spark, sf_dir), "trajet").transform(codec.decode_topic(TRIP, PLACE))
    return zoneless(parsed.withColumns({end: F.to_json(end) for end in trips.ENDS}))


def _parse(topic: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    decode = codec.decode_topic(TOPICS[topic].schema, PLACE)
    return zoneless(messages(events_table(spark, sf_dir), topic).transform(decode))


def encode_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every message of every topic."""
    events = events_table(spark, sf_dir)
    sent = [messages(events, name).transform(codec.decode_text(("topic", *PLACE))) for name in TOPICS]
    return reduce(DataFrame.unionByName, sent)


def _inspected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.damaged_messages(events_table(spark, sf_dir)).transform(codec.inspect_topic(TRIP, PLACE))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inspected(spark, sf_dir).transform(codec.rejected(TRIP))


def accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _inspected(spark, sf_dir).transform(codec.accepted)
    return zoneless(good.transform(trips.flatten_trip(PLACE)))


def dedupe_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = binding.redelivered_messages(events_table(spark, sf_dir)).transform(trips.typed_trips())
    return zoneless(typed.transform(dedupe_events(typed.columns)))


# -- trip rows ---------------------------------------------------------------------------------


def flatten_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(binding.trip_rows(events_table(spark, sf_dir)).transform(trips.flatten_trip(PLACE)))


def cast_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(flat_rows(spark, sf_dir))


def trip_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to typed flat rows: the whole decode chain."""
    return zoneless(messages(events_table(spark, sf_dir), "trajet").transform(trips.typed_trips(PLACE)))


def line_protocol(spark: SparkSession, sf_dir: str, strict: bool = False) -> DataFrame:
    """Messages to line protocol: the whole trip chain."""
    typed = messages(events_table(spark, sf_dir), "trajet").transform(trips.typed_trips(PLACE))
    return typed.transform(trips.line_protocol(PLACE, strict))


def geo_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = flat_rows(spark, sf_dir).transform(trips.geo_points)
    parts = [
        F.col(f"{end}_location.{axis}").alias(f"{end}_{axis}") for end in trips.ENDS for axis in ("lat", "lon")
    ]
    return located.select(*PLACE, "tripId", *parts)


def dedupe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_rows(spark, sf_dir).select("tripId", "heure_depart", "departure_name")
    cars = binding.vehicle_rows(events_table(spark, sf_dir)).select(
        F.col("IDTrajet").alias("tripId"), F.col("DateDebutTrajet").alias("heure_depart"), "immatriculation"
    )
    return zoneless(flat.join(cars, flat["tripId"] == cars["tripId"]).transform(trips.dedupe_columns))


def trip_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = flat_rows(spark, sf_dir).transform(trips.trip_distance)
    return measured.select(*PLACE, "tripId", F.round("distance_km", 6).alias("distance_km"))


def arrived_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pings within ``NEAR_KM`` of their target."""
    return flat_rows(spark, sf_dir).transform(trips.arrived_trips(NEAR_KM)).select(
        *PLACE, "tripId", "arrival_name", F.round("distance_km", 6).alias("distance_km")
    )


def emergency_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(binding.emergency_rows(events_table(spark, sf_dir)).transform(trips.normalize_emergency))


# -- joins -------------------------------------------------------------------------------------


def _pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_rows(spark, sf_dir).select(
        *PLACE, "tripId", "heure_depart", "departure_latitude", "departure_longitude", "flag_arrivee"
    )


def trip_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cars, _, _ = topic_rows(spark, sf_dir)
    return zoneless(
        _pings(spark, sf_dir).transform(views.join_vehicle(cars.drop(*PLACE))).drop(*views.JOIN_KEYS)
    )


def trip_emergency(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, alarms, _ = topic_rows(spark, sf_dir)
    return zoneless(_pings(spark, sf_dir).transform(views.trip_emergency(alarms)))


def trip_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, sky = topic_rows(spark, sf_dir)
    return zoneless(_pings(spark, sf_dir).transform(views.trip_weather(sky)))


def trip_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(_pings(spark, sf_dir).transform(views.trip_summary(*topic_rows(spark, sf_dir))))


def trip_360_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    pings = _pings(spark, sf_dir).select(*PLACE, "tripId", "heure_depart")
    near = views.trip_view_near(*topic_rows(spark, sf_dir), within_s=6 * HOUR_S)
    return zoneless(pings.transform(near))


def released_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    cars, _, _ = topic_rows(spark, sf_dir)
    return zoneless(cars.drop(*PLACE).transform(views.released_vehicles(_pings(spark, sf_dir))))


def available_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    cars, _, _ = topic_rows(spark, sf_dir)
    return zoneless(cars.transform(views.available_vehicles(_stored_pings(spark, sf_dir))).drop(*PLACE))


# -- last write wins ---------------------------------------------------------------------------


def _stored_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rows with the broker's time, as stored rows have it, arrival pings included."""
    rows = binding.stored_rows(events_table(spark, sf_dir), F.col("ts").cast("timestamp").alias("timestamp"))
    return rows.transform(trips.flatten_trip((*PLACE, "timestamp"))).transform(trips.cast_positions)


def point_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per trip and hour."""
    return zoneless(_stored_pings(spark, sf_dir).transform(upserts.point_upsert(HOUR_S)))


def trip_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(_stored_pings(spark, sf_dir).transform(upserts.trip_latest()))


def trip_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoneless(_stored_pings(spark, sf_dir).transform(upserts.trip_status()))


def payload_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = flat_rows(spark, sf_dir).transform(trips.line_protocol(PLACE))
    return lines.transform(payload_chunks(LINES_PER_BODY))


# -- sinks and streams -------------------------------------------------------------------------


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_date", F.to_date("heure_depart"))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "parquet")
    append_sink(_dated(flat_rows(spark, sf_dir)), path, partition_by=("event_date",))
    return zoneless(spark.read.parquet(path))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "csv")
    rows = flat_rows(spark, sf_dir).withColumn("note", binding.note())
    append_csv(rows, path)
    return zoneless(read_csv(spark, path, rows.schema))


def stream_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip topic as a checkpointed stream into date-partitioned parquet."""
    root = fresh_dir(spark, "stream_to_parquet")
    typed = messages(events_stream(spark, sf_dir), "trajet").transform(trips.typed_trips(PLACE))
    sink = Sink("trajet", partition_by=("event_date",))
    return zoneless(spark.read.parquet(run_stream(_dated(typed), sink, root)))


def stream_line_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip topic as a checkpointed stream into line-protocol text."""
    root = fresh_dir(spark, "stream_line_protocol")
    lines = messages(events_stream(spark, sf_dir), "trajet").transform(trips.typed_trips())
    path = run_stream(lines.transform(trips.line_protocol()), Sink("points", "text"), root)
    return spark.read.text(path).withColumnRenamed("value", "line")


def fan_out_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five streams side by side, the trip topic feeding two of them; rows and trips per sink."""
    root = fresh_dir(spark, "fan_out")
    events = events_stream(spark, sf_dir)
    cars = TOPICS["cars"]
    # Vehicles are an aggregate of the table, so their topic is sent first and replayed.
    publish(messages(events_table(spark, sf_dir), "cars"), cars.kafka_topic, replay=f"{root}/topics")
    sent = {name: messages(events, name) for name in ("trajet", "emergency", "weather")}
    sent["cars"] = read_topic(spark, cars.kafka_topic, replay=f"{root}/topics")
    paths = fan_out(service_streams(sent), root)
    written = {name: spark.read.parquet(path) for name, path in paths.items() if name != "points"}
    written["points"] = spark.read.text(paths["points"]).select(
        F.regexp_extract("value", "tripId=([^,]*)", 1).alias("tripId")
    )
    keys = {name: TOPICS[name].trip_key if name in TOPICS else "tripId" for name in written}
    counts = [
        df.agg(F.count("*").alias("n_rows"), F.count_distinct(F.col(keys[name])).alias("n_trips")).select(
            F.lit(name).alias("stream"), "n_rows", "n_trips"
        )
        for name, df in written.items()
    ]
    return reduce(DataFrame.unionByName, counts)


QUERIES: dict[str, Query] = {
    "topic_replay": topic_replay,
    "topic_counts": topic_counts,
    "json_scan": json_scan,
    "json_scan_typed": json_scan_typed,
    "decode_value": decode_value,
    "parse_trip": parse_trip,
    "parse_vehicle": partial(_parse, "cars"),
    "parse_emergency": partial(_parse, "emergency"),
    "parse_weather": partial(_parse, "weather"),
    "encode_topic": encode_topic,
    "rejected_rows": rejected_rows,
    "accepted_rows": accepted_rows,
    "dedupe_events": dedupe_redelivered,
    "flatten_trip": flatten_trip,
    "cast_trip": cast_trip,
    "trip_typed": trip_typed,
    "line_protocol": line_protocol,
    "line_protocol_strict": partial(line_protocol, strict=True),
    "geo_points": geo_points,
    "dedupe_columns": dedupe_columns,
    "trip_distance": trip_distance,
    "arrived_trips": arrived_trips,
    "emergency_normalize": emergency_normalize,
    "trip_vehicle": trip_vehicle,
    "trip_emergency": trip_emergency,
    "trip_weather": trip_weather,
    "trip_360": trip_360,
    "trip_360_interval": trip_360_interval,
    "released_vehicles": released_vehicles,
    "available_vehicles": available_vehicles,
    "point_upsert": point_upsert,
    "trip_latest": trip_latest,
    "trip_status": trip_status,
    "payload_chunks": payload_bodies,
    "parquet_roundtrip": parquet_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "stream_to_parquet": stream_to_parquet,
    "stream_line_protocol": stream_line_protocol,
    "fan_out": fan_out_streams,
    **streams.QUERIES,
}
