"""Last write wins: what keyed stores keep after all pings are in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemaque.functions.text import epoch_seconds
from telemaque.operators.codec import Transform
from telemaque.schemas import ARRIVAL_ORDER

# An arrival ping repeats the time of the ping before it, and arrival is final: at one time it comes last.
PING_ORDER = ("heure_depart", "flag_arrivee", *ARRIVAL_ORDER)


def last_write(keys: Sequence[str], order: Sequence[str] = PING_ORDER) -> Transform:
    """One row per key, the greatest in ``order``. On a stream: update or complete mode.

    An aggregate, not a ranking: every task first reduces its own rows to one per key, so a key
    that holds a third of all rows costs the shuffle no more than any other.
    """

    def apply(df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        winner = F.max_by(F.struct(*rest), F.struct(*order)).alias("winner")
        return df.groupBy(*keys).agg(winner).select(*keys, "winner.*")

    return apply


def timed_points(precision_s: int = 1) -> Transform:
    """Points with ``epoch_s``, the second their time slot begins. A point without a time cannot be stored and is dropped."""
    second = epoch_seconds(F.col("heure_depart"))
    slot = second if precision_s == 1 else (F.floor(second / F.lit(precision_s)) * precision_s)
    return lambda flat: flat.where(F.col("heure_depart").isNotNull()).withColumn("epoch_s", slot.cast("bigint"))


def point_upsert(precision_s: int = 1, order: Sequence[str] = PING_ORDER) -> Transform:
    """The points a time-series store keeps: one per trip, both places and time slot."""
    latest = last_write(("tripId", "departure_name", "arrival_name", "epoch_s"), order)
    return lambda flat: flat.transform(timed_points(precision_s)).transform(latest)


def trip_latest(order: Sequence[str] = PING_ORDER) -> Transform:
    """One document per trip, as a store keyed by ``tripId`` keeps it. Rows without a key are dropped."""
    return lambda flat: flat.where(F.col("tripId").isNotNull()).transform(last_write(("tripId",), order))


def trip_status(order: Sequence[str] = PING_ORDER) -> Transform:
    """Per trip: latest ping time, latest arrival flag, and ``open`` (not arrived, or not known)."""

    def apply(trips: DataFrame) -> DataFrame:
        needed = dict.fromkeys(("tripId", "heure_depart", "flag_arrivee", *order))
        return (
            trips.select(*needed)
            .transform(trip_latest(order))
            .select(
                "tripId",
                F.col("heure_depart").alias("last_ping"),
                F.col("flag_arrivee").alias("arrived"),
                (~F.coalesce(F.col("flag_arrivee"), F.lit(False))).alias("open"),
            )
        )

    return apply
