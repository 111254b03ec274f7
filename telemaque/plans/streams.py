"""Named queries that run streams over topics as they come in: late messages, restarts between batches, state.

Each query starts its stream anew from the checkpoint after every slice of messages.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemaque.operators import codec, trips, upserts, windows
from telemaque.operators.dedupe import dedupe_events
from telemaque.plans import binding
from telemaque.plans.binding import events_table
from telemaque.plans.slices import Slices, send_and_run
from telemaque.schemas import ENVELOPE, TOPICS, TRIP
from telemaque.sinks.compacted import CompactedTable
from telemaque.sinks.keyed import KeyedTable
from telemaque.sinks.tables import publish
from telemaque.sources import ranges
from telemaque.sources.topics import read_topic
from telemaque.streaming.batches import batch_writer
from telemaque.streaming.joins import LARGE_STATE, settings, trip_view_stream
from telemaque.streaming.ledger import Ledger
from telemaque.streaming.runner import Sink, StreamsFailed, run_stream
from telemaque.workspace import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

SLICES, JOIN_SLICES = 4, 3
GAP_S, WINDOW_S, SLIDE_S = 6 * 3600, 24 * 3600, 12 * 3600
REPORT_S, TRIP_S = 6 * 3600, 10 * 24 * 3600
SMALL_BATCHES = 7
DAY = datetime(2024, 1, 10, tzinfo=UTC)
ORDER_COLUMNS = ("partition", "offset", "timestamp")
PING_TOPIC = TOPICS["trajet"].kafka_topic


def zoneless(df: DataFrame) -> DataFrame:
    """Instants as plain UTC wall-clock times."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(f"`{name}`").cast("timestamp_ntz") for name in times})


def _sent(rows: DataFrame, topic: str) -> DataFrame:
    spec = TOPICS[topic]
    return rows.transform(codec.encode_topic(spec.schema, spec.kafka_topic, spec.event_time))


def _pings(events: DataFrame, slices: Slices, too_late: bool = False) -> Callable[[int], DataFrame]:
    """The trip messages of each slice."""
    sent = slices.sent(F.col("ts"), F.col("event_id"), too_late)
    return lambda number: _sent(binding.trip_rows(events.where(sent == number)), "trajet")


def _windowed(spark: SparkSession, sf_dir: str, label: str, count: int, per_window: Callable[[str], codec.Transform]) -> DataFrame:
    events, root = events_table(spark, sf_dir), fresh_dir(spark, label)
    slices = Slices.of(events, count)
    typed = {PING_TOPIC: _pings(events, slices, too_late=True)}

    def run(_: int) -> None:
        rows = read_topic(spark, PING_TOPIC, replay=f"{root}/topics").transform(trips.typed_trips())
        run_stream(rows.transform(per_window(slices.delay)), Sink("windows"), root)

    send_and_run(count, typed, f"{root}/topics", run)
    return zoneless(spark.read.parquet(Sink("windows").path(root)))


def trip_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each trip, ended by a pause of six hours; those that are closed when the stream ends."""
    for name, value in windows.LOCAL_MERGE.items():
        spark.conf.set(name, value)
    return _windowed(spark, sf_dir, "sessions", SLICES, lambda delay: windows.sessions(("tripId",), f"{GAP_S} seconds", delay))


def departure_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings by place of departure and day (tumbling windows) that are closed when the stream ends."""
    return _windowed(spark, sf_dir, "days", SLICES, lambda delay: windows.fixed_windows(("departure_name",), f"{WINDOW_S} seconds", delay=delay))


def departure_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in days that begin every twelve hours (sliding windows)."""
    size, slide = f"{WINDOW_S} seconds", f"{SLIDE_S} seconds"
    return _windowed(spark, sf_dir, "windows", SLICES, lambda delay: windows.fixed_windows(("departure_name",), size, slide, delay))


def trip_360_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the four-way join, within six hours of a report and ten days of the registration, as streams."""
    events, root = events_table(spark, sf_dir), fresh_dir(spark, "trip_360_stream")
    slices = Slices.of(events, JOIN_SLICES)
    at = slices.sent(F.col("ts"), F.col("event_id"))
    cars = binding.vehicle_rows(events)
    topics = {
        PING_TOPIC: _pings(events, slices),
        TOPICS["cars"].kafka_topic: lambda number: _sent(cars.where(slices.number(F.col("DateDebutTrajet")) == number), "cars"),
        **{
            TOPICS[name].kafka_topic: lambda number, name=name: _sent(binding.ROWS[name](events.where(at == number)), name)
            for name in ("emergency", "weather")
        },
    }

    def rows(name: str) -> DataFrame:
        sent = read_topic(spark, TOPICS[name].kafka_topic, replay=f"{root}/topics")
        return sent.transform(codec.decode_topic(TOPICS[name].schema))

    def run(_: int) -> None:
        pings = read_topic(spark, PING_TOPIC, replay=f"{root}/topics").transform(trips.typed_trips(("partition", "offset")))
        alarms = rows("emergency").transform(trips.normalize_emergency)
        view = trip_view_stream(rows("cars"), alarms, rows("weather"), REPORT_S, TRIP_S, slices.delay)
        kept = pings.transform(view).select(
            "partition", "offset", "tripId", "heure_depart", "immatriculation", "DateDebutTrajet", "EmergencyTime", "emergencyType",
            "emergencyStatus", "WeatherTime", "weatherCondition", "temperature",
        )
        with settings(spark, LARGE_STATE):
            run_stream(kept, Sink("view"), root)

    send_and_run(JOIN_SLICES, topics, f"{root}/topics", run)
    return zoneless(spark.read.parquet(Sink("view").path(root)))


def dedupe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each trip message once, the copies of a redelivery coming a slice later, after a restart."""
    events, root = events_table(spark, sf_dir), fresh_dir(spark, "dedupe_stream")
    slices = Slices.of(events, JOIN_SLICES)
    # Copies are told by their shifted offset.
    again = (F.col("offset") >= binding.REDELIVERY_SHIFT).cast("bigint")
    when = F.least(slices.number(F.col("timestamp")) + again, F.lit(JOIN_SLICES - 1).cast("bigint"))
    topics = {PING_TOPIC: lambda number: binding.redelivered_messages(events).where(when == number)}

    def run(_: int) -> None:
        typed = read_topic(spark, PING_TOPIC, replay=f"{root}/topics").transform(trips.typed_trips())
        run_stream(typed.transform(dedupe_events(typed.columns, "heure_depart", slices.delay)), Sink("once"), root)

    send_and_run(JOIN_SLICES, topics, f"{root}/topics", run)
    return zoneless(spark.read.parquet(Sink("once").path(root)))


def _kept_up(spark: SparkSession, sf_dir: str, label: str, keys: tuple[str, ...], prepare: codec.Transform) -> DataFrame:
    """Stored pings through a ledger into a keyed table, one of whose batches comes twice."""
    events, root = events_table(spark, sf_dir), fresh_dir(spark, label)
    slices = Slices.of(events, SLICES)
    at = slices.sent(F.col("heure_depart"), F.col("partition") + F.col("offset") * binding.PARTITIONS)
    topics = {PING_TOPIC: lambda number: _sent(binding.stored_rows(events).where(at == number), "trajet")}
    ledger, table = Ledger(f"{root}/pings"), KeyedTable(f"{root}/table", keys)

    def run(number: int) -> None:
        rows = read_topic(spark, PING_TOPIC, replay=f"{root}/topics").transform(trips.typed_trips(ORDER_COLUMNS))
        ledger.pull(rows.transform(prepare))
        ledger.deliver(spark, {"table": table.merge})
        if number == 1:
            table.merge(ledger.rows(spark, number), number)

    send_and_run(SLICES, topics, f"{root}/topics", run)
    return zoneless(table.read(spark))


def trip_latest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per trip, kept up to date batch by batch."""
    return _kept_up(spark, sf_dir, "latest_stream", ("tripId",), lambda rows: rows.where("tripId is not null"))


def point_upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per trip and hour, kept up to date batch by batch."""
    keys = ("tripId", "departure_name", "arrival_name", "epoch_s")
    return _kept_up(spark, sf_dir, "upsert_stream", keys, upserts.timed_points(3600))


def _ledger_of_pings(spark: SparkSession, sf_dir: str, root: str, then: Callable[[Ledger, int], None]) -> None:
    events = events_table(spark, sf_dir)
    slices = Slices.of(events, JOIN_SLICES)
    ledger = Ledger(f"{root}/pings")

    def run(number: int) -> None:
        sent = read_topic(spark, PING_TOPIC, replay=f"{root}/topics")
        ledger.pull(sent.transform(codec.decode_topic(TRIP, ("partition", "offset"))).transform(trips.flatten_trip(("partition", "offset"))))
        then(ledger, number)

    send_and_run(JOIN_SLICES, {PING_TOPIC: _pings(events, slices)}, f"{root}/topics", run)


def _lines(rows: DataFrame) -> DataFrame:
    return rows.transform(trips.cast_positions).transform(trips.line_protocol())


def one_read_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip topic, read once, into rows and into lines: what each sink has, by batch."""
    root = fresh_dir(spark, "one_read")
    sinks = {"rows": batch_writer(f"{root}/rows"), "points": batch_writer(f"{root}/points", transform=_lines)}
    _ledger_of_pings(spark, sf_dir, root, lambda ledger, _: ledger.deliver(spark, sinks))
    rows, points = (spark.read.parquet(f"{root}/{name}") for name in sinks)
    by_trip = points.select("batch_id", F.regexp_extract("line", "tripId=([^,]*)", 1).alias("tripId"))
    counts = [
        df.groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.count_distinct("tripId").alias("n_trips")).select(F.lit(name).alias("sink"), "*")
        for name, df in (("rows", rows), ("points", by_trip))
    ]
    return counts[0].unionByName(counts[1])


def recovered_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a sink that breaks off half-way through a batch, beside one that goes on, and is served again."""
    root = fresh_dir(spark, "recovered")
    points, rows = batch_writer(f"{root}/points", "text", _lines), batch_writer(f"{root}/rows")
    broken: list[int] = []

    def breaking(batch: DataFrame, number: int) -> None:
        if number == 1 and not broken:
            broken.append(number)
            points(batch.where("partition < 2"), number)
            raise OSError("the sink has gone away")
        points(batch, number)

    def serve(ledger: Ledger, _: int) -> None:
        sinks = {"points": breaking, "rows": rows}
        try:
            ledger.deliver(spark, sinks)
        except StreamsFailed as failure:
            if list(failure.errors) != ["points"] or ledger.delivered(spark, "rows") != ledger.finished(spark):
                raise
            ledger.deliver(spark, sinks)

    _ledger_of_pings(spark, sf_dir, root, serve)
    return spark.read.text(f"{root}/points").select(F.col("value").alias("line"))


def compacted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed pings that came in as many small batches, compacted in between, and read through the manifest."""
    root = fresh_dir(spark, "compacted")
    rows = binding.trip_rows(events_table(spark, sf_dir)).transform(trips.flatten_trip(("partition", "offset"))).transform(trips.cast_positions)
    table = CompactedTable(root, rows.schema)
    for number in range(SMALL_BATCHES):
        table.write(rows.where(F.pmod("offset", F.lit(SMALL_BATCHES)) == number), number)
        if number % 3 == 2:
            table.compact(spark)
            table.expire(spark)
    return zoneless(table.read(spark))


def offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip messages of a range of offsets in each of two partitions, and of a day in the others."""
    root = fresh_dir(spark, "offset_ranges")
    publish(_sent(binding.trip_rows(events_table(spark, sf_dir)), "trajet"), PING_TOPIC, replay=root)
    sent = spark.read.schema(ENVELOPE).parquet(f"{root}/{PING_TOPIC}")
    day = ranges.offsets_of_times(sent.where("partition >= 2"), DAY, DAY + timedelta(days=1))
    wanted = [ranges.OffsetRange(0, 10, 120), ranges.OffsetRange(1, 50), *day]
    found = ranges.read_offsets(spark, PING_TOPIC, wanted, replay=root)
    return zoneless(found.transform(trips.typed_trips(("partition", "offset"))))


QUERIES: dict[str, Query] = {
    "trip_sessions": trip_sessions,
    "departure_days": departure_days,
    "departure_windows": departure_windows,
    "trip_360_stream": trip_360_stream,
    "dedupe_stream": dedupe_stream,
    "trip_latest_stream": trip_latest_stream,
    "point_upsert_stream": point_upsert_stream,
    "one_read_two_sinks": one_read_two_sinks,
    "recovered_sink": recovered_sink,
    "compacted_rows": compacted_rows,
    "offset_ranges": offset_ranges,
}
