"""Joins of the four topics by trip.

The joins come in two forms. The plain ones give the join's rows: every ping with every report of
its trip, which is what a view over few reports per trip wants. Reports are re-sent while a trip
runs, so on whole topics those rows multiply. The profile and summary forms hold the same
information in output that grows with the pings only: each side is first reduced per trip (inside
each task, before any shuffle), and multiplicities are carried as counts.

No side is broadcast by hint: Spark broadcasts one whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and else splits skewed join partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemaque.operators.codec import Transform
from telemaque.operators.intervals import interval_totals, salted_join
from telemaque.operators.trips import geo_points
from telemaque.operators.upserts import PING_ORDER, last_write, trip_status

JOIN_KEYS = ("IDTrajet", "emergencyTrip", "weatherTrip")
VEHICLE_ORDER = ("partition", "offset")


# -- plain joins -------------------------------------------------------------------------------


def join_vehicle(vehicles: DataFrame) -> Transform:
    return lambda trips: trips.join(vehicles, F.col("tripId") == F.col("IDTrajet"))


def join_emergency(emergencies: DataFrame) -> Transform:
    return lambda trips: trips.join(emergencies, F.col("tripId") == F.col("emergencyTrip"))


def join_weather(weathers: DataFrame) -> Transform:
    return lambda trips: trips.join(weathers, F.col("tripId") == F.col("weatherTrip"))


def trip_view(vehicles: DataFrame, emergencies: DataFrame, weathers: DataFrame) -> Transform:
    """Rows of the four-way join, without the repeated keys, with both geo points."""
    return lambda trips: (
        trips.transform(join_vehicle(vehicles))
        .transform(join_emergency(emergencies))
        .transform(join_weather(weathers))
        .drop(*JOIN_KEYS)
        .transform(geo_points)
    )


# -- joins with the reports reduced per trip ---------------------------------------------------


def emergency_profile(emergencies: DataFrame) -> DataFrame:
    """Per trip, type and status: how many reports, the first and the last."""
    return emergencies.groupBy(
        F.col("emergencyTrip"), F.col("emergencyType"), F.col("emergencyStatus")
    ).agg(
        F.count("*").alias("n_reports"),
        F.min("EmergencyTime").alias("first_report"),
        F.max("EmergencyTime").alias("last_report"),
    )


def weather_profile(weathers: DataFrame) -> DataFrame:
    """Per trip and condition: how many reports and the range of the measured values."""
    return weathers.groupBy("weatherTrip", "weatherCondition").agg(
        F.count("*").alias("n_reports"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.max("wind_speed").alias("max_wind_speed"),
        F.min("humidity").alias("min_humidity"),
        F.max("humidity").alias("max_humidity"),
    )


def trip_emergency(emergencies: DataFrame) -> Transform:
    """Each ping with the emergency profile of its trip; ``sum(n_reports)`` is the plain join's size."""
    return lambda trips: (
        trips.transform(join_emergency(emergency_profile(emergencies))).drop("emergencyTrip")
    )


def trip_weather(weathers: DataFrame) -> Transform:
    """Each ping with the weather profile of its trip; ``sum(n_reports)`` is the plain join's size."""
    return lambda trips: trips.transform(join_weather(weather_profile(weathers))).drop("weatherTrip")


def trip_summary(vehicles: DataFrame, emergencies: DataFrame, weathers: DataFrame) -> Transform:
    """Batch. The four-way join summed up per trip, without building its rows.

    ``view_rows`` is the exact number of rows :func:`trip_view` has for the trip: the product of the
    four counts. Minima and maxima over the join equal those over each side.
    """
    pings = (
        F.count("*").alias("n_pings"),
        F.min("heure_depart").alias("first_ping"),
        F.max("heure_depart").alias("last_ping"),
        F.max("flag_arrivee").alias("ever_arrived"),
    )
    cars = (F.count("*").alias("n_vehicles"), F.min("immatriculation").alias("immatriculation"))
    alarms = (
        F.count("*").alias("n_emergencies"),
        F.count(F.when(F.col("emergencyStatus") == "ON GOING", 1)).alias("n_ongoing"),
    )
    sky = (
        F.count("*").alias("n_weathers"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
    )

    def apply(trips: DataFrame) -> DataFrame:
        return (
            trips.groupBy("tripId")
            .agg(*pings)
            .join(vehicles.groupBy(F.col("IDTrajet").alias("tripId")).agg(*cars), "tripId")
            .join(emergencies.groupBy(F.col("emergencyTrip").alias("tripId")).agg(*alarms), "tripId")
            .join(weathers.groupBy(F.col("weatherTrip").alias("tripId")).agg(*sky), "tripId")
            .withColumn(
                "view_rows", F.col("n_pings") * F.col("n_vehicles") * F.col("n_emergencies") * F.col("n_weathers")
            )
        )

    return apply


def trip_view_near(
    vehicles: DataFrame, emergencies: DataFrame, weathers: DataFrame, within_s: int
) -> Transform:
    """Batch. The four-way join with reports within ``within_s`` of the ping, summed up per ping.

    ``view_rows`` is the exact number of rows the ping has in that join; pings without any are left
    out. ``sum_temperature`` is over the ping's weather reports.
    """
    alarm, sky = F.lit(1).alias("alarm"), F.lit(0).alias("alarm")
    marks = emergencies.select(
        F.col("emergencyTrip").alias("trip"), F.col("EmergencyTime").alias("time"), alarm, F.lit(0).alias("temperature")
    ).unionByName(
        weathers.select(
            F.col("weatherTrip").alias("trip"), F.col("WeatherTime").alias("time"), sky, F.col("temperature")
        )
    )
    sums = interval_totals(
        marks,
        ("tripId", "trip"),
        ("heure_depart", "time"),
        within_s,
        {"n_emergencies": F.col("alarm"), "n_weathers": 1 - F.col("alarm"), "sum_temperature": F.col("temperature")},
    )
    cars = vehicles.groupBy(F.col("IDTrajet").alias("carTrip")).agg(F.count("*").alias("n_vehicles"))

    def apply(trips: DataFrame) -> DataFrame:
        return (
            trips.transform(sums)
            .where((F.col("n_emergencies") > 0) & (F.col("n_weathers") > 0))
            .transform(lambda near: salted_join(near, cars, [(F.col("tripId"), "carTrip")]))
            .withColumn("view_rows", F.col("n_vehicles") * F.col("n_emergencies") * F.col("n_weathers"))
        )

    return apply


# -- fleet -------------------------------------------------------------------------------------


def released_vehicles(trips: DataFrame) -> Transform:
    """The vehicle rows whose trip has arrived."""
    # Distinct before the join: a semi join cannot split a trip with very many arrival pings.
    arrived = trips.where(F.col("flag_arrivee")).select(F.col("tripId").alias("IDTrajet")).distinct()
    return lambda vehicles: vehicles.join(arrived, "IDTrajet", "left_semi")


def available_vehicles(trips: DataFrame, order: Sequence[str] = PING_ORDER) -> Transform:
    """Batch. The vehicles on no open trip, one row each: its latest registration.

    A vehicle is taken when it is registered for a trip, before the first ping, until the trip arrives.
    """
    arrived = trips.transform(trip_status(order)).where("arrived").select(F.col("tripId").alias("IDTrajet"))

    def apply(vehicles: DataFrame) -> DataFrame:
        on_trips = vehicles.where(F.col("IDTrajet").isNotNull())
        busy = on_trips.join(arrived, "IDTrajet", "left_anti").select("immatriculation").distinct()
        latest = vehicles.transform(last_write(("immatriculation",), ("DateDebutTrajet", *VEHICLE_ORDER)))
        return latest.join(busy, "immatriculation", "left_anti")

    return apply
