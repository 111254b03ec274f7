"""A typed trip row as one line of time-series line protocol."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemaque.functions.text import bool_text, epoch_seconds, float_text, or_none, short_exponents

# Fixed values of the line format.
MEASUREMENT = "trajets"
TAGS = {"tripId": "tripId", "departure": "departure_name", "arrival": "arrival_name"}
COORDINATES = ("departure_latitude", "departure_longitude", "arrival_latitude", "arrival_longitude")
FLAG = "flag_arrivee"
TIME = "heure_depart"


def parity_line() -> Column:
    """Line as the running service writes it: nothing escaped, unknown values print ``None``."""
    tags = [F.concat(F.lit(f"{tag}="), or_none(F.col(c))) for tag, c in TAGS.items()]
    numbers = F.concat_ws(",", *[F.concat(F.lit(f"{c}="), or_none(float_text(F.col(c)))) for c in COORDINATES])
    return F.concat(
        F.concat_ws(",", F.lit(MEASUREMENT), *tags),
        F.lit(" "),
        short_exponents(numbers),
        F.lit(f",{FLAG}="),
        bool_text(F.col(FLAG)),
        F.lit(" "),
        epoch_seconds(F.col(TIME)).cast("string"),
    )


def _clean(tag: Column) -> Column:
    """Without what a tag value cannot hold: line breaks (now blanks) and backslashes at its end."""
    return F.rtrim(F.translate(tag, "\r\n", "  "), F.lit("\\"))


def _escaped(tag: Column) -> Column:
    for special in (",", "=", " "):
        tag = F.replace(tag, F.lit(special), F.lit(f"\\{special}"))
    return tag


def _finite(coordinate: str) -> Column:
    """The database knows neither NaN nor infinity."""
    return F.abs(F.col(coordinate)) < float("inf")


def renderable() -> Column:
    """Whether a valid line can be written: key and time known, and at least one field."""
    some_field = F.col(FLAG).isNotNull()
    for c in COORDINATES:
        some_field = some_field | F.coalesce(_finite(c), F.lit(False))
    return (_clean(F.col("tripId")) != "") & F.col(TIME).isNotNull() & some_field


def strict_line() -> Column:
    """Valid line protocol for a :func:`renderable` row: tag values escaped, unknown tags and fields left out."""
    tags = [
        F.when(_clean(F.col(c)) != "", F.concat(F.lit(f"{tag}="), _escaped(_clean(F.col(c))))) for tag, c in TAGS.items()
    ]
    fields = [F.when(_finite(c), F.concat(F.lit(f"{c}="), float_text(F.col(c)))) for c in COORDINATES]
    fields.append(F.concat(F.lit(f"{FLAG}="), F.col(FLAG).cast("string")))
    return F.concat(
        F.concat_ws(",", F.lit(MEASUREMENT), *tags),
        F.lit(" "),
        short_exponents(F.concat_ws(",", *fields)),
        F.lit(" "),
        epoch_seconds(F.col(TIME)).cast("string"),
    )
