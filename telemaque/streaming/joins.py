"""The four-way trip view on streams, with state that shrinks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemaque.operators.codec import Transform
from telemaque.operators.intervals import interval_join, micros
from telemaque.operators.trips import geo_points
from telemaque.operators.views import JOIN_KEYS

#: State on the executors' disks, of which a batch stores its changes; a batch without messages, which could only drop
#: state, is left to the next one that has some (inner joins give no row late). Rows are not counted, which would look up
#: each before it is written, and a join's partition has one store (version 3), not four.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session with ``values`` set, for streams that start meanwhile."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def trip_view_stream(
    vehicles: DataFrame,
    emergencies: DataFrame,
    weathers: DataFrame,
    report_within_s: int,
    trip_within_s: int,
    delay: str,
) -> Transform:
    """Rows of the four-way join whose reports lie within ``report_within_s`` of the ping and whose
    vehicle registration lies within ``trip_within_s`` of it.

    Reports carry the trip's start time, so the bounds have to be as wide as a trip. ``delay`` is how
    late messages of any topic may come. Works on batch tables too, with the same result. The reports, which are
    fewer than the pings, meet each other first, within twice their bound, and then the pings: so these are kept
    by one join, and later joins keep little state; set ``LARGE_STATE`` where the state doesn't fit into memory.
    """
    columns = [c for right in (vehicles, emergencies, weathers) for c in right.columns if c not in JOIN_KEYS]
    alarms, skies = emergencies.withWatermark("EmergencyTime", delay), weathers.withWatermark("WeatherTime", delay)
    both = alarms.transform(
        interval_join(skies, ("emergencyTrip", "weatherTrip"), ("EmergencyTime", "WeatherTime"), 2 * report_within_s)
    )
    # A further stream join takes only one event time of either side. Without a zone, a time is a plain value.
    reports = both.withColumns({"_sky_us": micros("WeatherTime"), "WeatherTime": F.col("WeatherTime").cast("timestamp_ntz")})

    def apply(trips: DataFrame) -> DataFrame:
        view = trips.withWatermark("heure_depart", delay)
        for right, key, time, within_s in (
            (reports, "emergencyTrip", "EmergencyTime", report_within_s),
            (vehicles.withWatermark("DateDebutTrajet", delay), "IDTrajet", "DateDebutTrajet", trip_within_s),
        ):
            joined = view.transform(interval_join(right, ("tripId", key), ("heure_depart", time), within_s))
            if right is reports:
                joined = joined.where(F.abs(F.col("_sky_us") - micros("heure_depart")) <= report_within_s * 1_000_000)
            view = joined.withColumn(time, F.col(time).cast("timestamp_ntz"))
        return view.select(*trips.columns, *columns).transform(geo_points)

    return apply
