"""Topic messages to typed rows and back, with a side exit for messages that cannot be used."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemaque.functions.text import JSON_MESSAGE
from telemaque.operators.once import expand_once
from telemaque.schemas import ENVELOPE

Transform = Callable[[DataFrame], DataFrame]

TEXT = "decoded_value"
PAYLOAD = "payload"
REASON = "reason"
_CORRUPT = "_corrupt"


def decode_text(keep: Sequence[str] = (), strict: bool = False) -> Transform:
    """``value`` bytes as UTF-8 text in ``decoded_value``, next to the envelope columns in ``keep``.

    Bad bytes never fail the query: they stay in the text (shown as U+FFFD), or with ``strict``
    make the text NULL.
    """
    raw = F.col("value")
    text = F.try_validate_utf8(raw.cast("string")) if strict else raw.cast("string")
    return lambda messages: messages.select(*keep, text.alias(TEXT))


def decode_topic(schema: T.StructType, keep: Sequence[str] = (), strict: bool = False) -> Transform:
    """Parse each message by its declared schema; permissive, so no message is dropped.

    A message that is no JSON object gives a row of NULLs, a field of the wrong type gives NULL in
    that field, unknown fields are ignored.
    """

    def apply(messages: DataFrame) -> DataFrame:
        parsed = F.from_json(F.col(TEXT), schema)
        return messages.transform(decode_text(keep, strict)).transform(expand_once(parsed, keep))

    return apply


def _required(schema: T.StructType, prefix: str = "") -> list[tuple[str, Column]]:
    """Every field declared required, as (dotted name, column); a struct before its own fields."""
    found = []
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        if not field.nullable:
            found.append((path, F.col(".".join(f"`{part}`" for part in path.split(".")))))
            if isinstance(field.dataType, T.StructType):
                found.extend(_required(field.dataType, f"{path}."))
    return found


def inspect_topic(schema: T.StructType, keep: Sequence[str] = ()) -> Transform:
    """Decode, and say why a message is unusable: ``reason`` is NULL for a good one.

    Reasons: ``empty``, ``invalid utf-8``, ``malformed``, ``missing <field>`` (first missing
    required field). One parse serves both exits; take them with :func:`accepted` and
    :func:`rejected`.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])

    def apply(messages: DataFrame) -> DataFrame:
        text = F.col("value").cast("string")
        parsed = F.from_json(F.col(PAYLOAD), with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT})
        missing = [F.when(column.isNull(), F.lit(f"missing {path}")) for path, column in _required(schema)]
        nothing_read = reduce(and_, [F.col(f"`{name}`").isNull() for name in schema.fieldNames()])
        reason = (
            F.when(F.col(PAYLOAD).isNull() | (F.trim(F.col(PAYLOAD)) == ""), F.lit("empty"))
            .when(F.try_validate_utf8(F.col(PAYLOAD)).isNull(), F.lit("invalid utf-8"))
            .when(F.col(_CORRUPT).isNotNull() & nothing_read, F.lit("malformed"))
            .otherwise(F.coalesce(*missing))
        )
        return (
            messages.select(*keep, text.alias(PAYLOAD))
            .transform(expand_once(parsed, (*keep, PAYLOAD)))
            .withColumn(REASON, reason)
            .drop(_CORRUPT)
        )

    return apply


def accepted(inspected: DataFrame) -> DataFrame:
    return inspected.where(F.col(REASON).isNull()).drop(PAYLOAD, REASON)


def rejected(schema: T.StructType) -> Transform:
    """The unusable messages with their raw payload and the reason."""
    return lambda inspected: inspected.where(F.col(REASON).isNotNull()).drop(*schema.fieldNames())


def encode_text(schema: T.StructType) -> Column:
    """A typed row as JSON text: fields in declared order, NULL as ``null``, ISO microsecond times."""
    return F.to_json(F.struct(*[F.col(f"`{name}`") for name in schema.fieldNames()]), JSON_MESSAGE)


def encode_topic(schema: T.StructType, topic: str, event_time: str, text: Column | None = None) -> Transform:
    """Typed rows to topic messages in the envelope's shape.

    ``partition`` and ``offset`` are taken from the rows; messages carry no key. ``text`` replaces
    the encoded row as the message text.
    """

    def apply(rows: DataFrame) -> DataFrame:
        filled = {
            "key": F.lit(None),
            "value": encode_text(schema) if text is None else text,
            "topic": F.lit(topic),
            "timestamp": F.col(event_time),
            "timestampType": F.lit(0),
        }
        return rows.select(
            *[filled.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in ENVELOPE.fields]
        )

    return apply
