"""Trip rows: flatten, type, measure, move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemaque.functions import geo
from telemaque.functions.lineprotocol import COORDINATES, parity_line, renderable, strict_line
from telemaque.operators.codec import Transform, decode_topic
from telemaque.operators.once import expand_once
from telemaque.schemas import TRIP

ENDS = ("departure", "arrival")
GPS_FIELDS = ("name", "latitude", "longitude")


def flatten_trip(keep: tuple[str, ...] = ()) -> Transform:
    """Nested positions to nine scalar columns: key, departure, arrival, time, flag."""
    positions = [F.col(f"{end}.{field}").alias(f"{end}_{field}") for end in ENDS for field in GPS_FIELDS]
    return lambda trips: trips.select(*keep, "tripId", *positions, "heure_depart", "flag_arrivee")


def cast_positions(flat: DataFrame) -> DataFrame:
    """The four coordinates as doubles; text that is no number becomes NULL."""
    return flat.withColumns({c: F.col(c).try_cast("double") for c in COORDINATES})


def typed_trips(keep: tuple[str, ...] = ()) -> Transform:
    """Trip messages to typed flat rows: decode, flatten, cast."""
    return lambda messages: (
        messages.transform(decode_topic(TRIP, keep)).transform(flatten_trip(keep)).transform(cast_positions)
    )


def line_protocol(keep: tuple[str, ...] = (), strict: bool = False) -> Transform:
    """One line per typed trip row; rows that cannot be rendered are dropped.

    The plain mode drops rows without a time; ``strict`` writes valid line protocol only, and drops
    rows without a key or without any field as well.
    """
    if not strict:
        return lambda flat: flat.where(F.col("heure_depart").isNotNull()).select(*keep, parity_line().alias("line"))
    return lambda flat: flat.where(renderable()).select(*keep, strict_line().alias("line"))


def geo_points(rows: DataFrame) -> DataFrame:
    """Add ``departure_location`` and ``arrival_location`` as ``{lat, lon}``, from nested or flat rows."""

    def part(end: str, field: str) -> Column:
        return F.col(f"{end}.{field}") if end in rows.columns else F.col(f"{end}_{field}")

    return rows.withColumns(
        {
            f"{end}_location": F.struct(part(end, "latitude").alias("lat"), part(end, "longitude").alias("lon"))
            for end in ENDS
        }
    )


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Keep the first column of each name, by position, so that ambiguous names cannot get in the way.

    Names that the session takes as one name (by default, whatever their case) are one.
    """
    by_case = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    seen: set[str] = set()
    spare = f"_{len(df.columns)}_"
    renamed, extra = [], []
    for i, name in enumerate(df.columns):
        if (name if by_case else name.lower()) in seen:
            extra.append(f"{spare}{i}")
            renamed.append(extra[-1])
        else:
            seen.add(name if by_case else name.lower())
            renamed.append(name)
    return df.toDF(*renamed).drop(*extra)


def _remaining_km() -> Column:
    return geo.distance_km(*[F.col(c) for c in COORDINATES])


def trip_distance(flat: DataFrame) -> DataFrame:
    """Add ``distance_km`` from the current position to the target."""
    return flat.withColumn("distance_km", _remaining_km())


def arrived_trips(threshold_km: float = geo.ARRIVAL_THRESHOLD_KM) -> Transform:
    """The rows whose position lies within the threshold of the target, with their distance."""

    def apply(flat: DataFrame) -> DataFrame:
        measured = flat.transform(expand_once(F.struct(_remaining_km().alias("distance_km")), flat.columns))
        return measured.where(F.col("distance_km") <= threshold_km)

    return apply


def normalize_emergency(emergencies: DataFrame) -> DataFrame:
    """An emergency of type ``NONE`` has status ``NONE``."""
    status = F.when(F.col("emergencyType") == "NONE", F.lit("NONE")).otherwise(F.col("emergencyStatus"))
    return emergencies.withColumn("emergencyStatus", status)
