"""Windows over pings: tumbling and sliding ones of fixed size, and sessions that end with a pause.

All work on batch tables and, with ``delay``, on streams: there a window is delivered once, when no message
that may still come can change it, and its state is dropped. Messages later than ``delay`` are left out of
windows that are closed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemaque.operators.codec import Transform

#: Lets each task merge its own sessions before the shuffle, so that a busy key sends few rows.
LOCAL_MERGE = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def ping_measures() -> list[Column]:
    """What is kept of the pings of a window."""
    return [
        F.count("*").alias("n_pings"),
        F.count_if("flag_arrivee").alias("n_arrivals"),
        F.min("heure_depart").alias("first_ping"),
        F.max("heure_depart").alias("last_ping"),
        F.min("departure_latitude").alias("min_latitude"),
        F.max("departure_latitude").alias("max_latitude"),
    ]


def _dated(df: DataFrame, time: str, delay: str | None) -> DataFrame:
    if df.isStreaming:
        if delay is None:
            raise ValueError("a stream needs delay")
        return df.withWatermark(time, delay)
    return df.where(F.col(time).isNotNull())


def fixed_windows(
    keys: Sequence[str], size: str, slide: str | None = None, delay: str | None = None, time: str = "heure_depart",
    measures: Sequence[Column] | None = None,
) -> Transform:
    """``measures`` (those of pings by default) per key and window ``[window_start, window_end)``.

    Windows follow each other, or begin every ``slide`` and overlap. A row without a time is in no window.
    Counts and extremes are reduced inside each task before the shuffle.
    """

    def apply(df: DataFrame) -> DataFrame:
        window = F.window(time, size, slide) if slide else F.window(time, size)
        groups = _dated(df, time, delay).groupBy(*keys, window.alias("window"))
        rows = groups.agg(*(measures or ping_measures()))
        rest = [c for c in rows.columns if c not in (*keys, "window")]
        return rows.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)

    return apply


def sessions(
    keys: Sequence[str], gap: str, delay: str | None = None, time: str = "heure_depart", measures: Sequence[Column] | None = None
) -> Transform:
    """``measures`` per key and session: rows of a key no two neighbours of which lie ``gap`` or more apart.

    A row that falls between two sessions, however late it comes, makes them one. ``session_end`` is the
    time of the last row plus the gap. Set ``LOCAL_MERGE`` on the session for busy keys.
    """

    def apply(df: DataFrame) -> DataFrame:
        window = F.session_window(time, gap).alias("session")
        rows = _dated(df, time, delay).groupBy(*keys, window).agg(*(measures or ping_measures()))
        rest = [c for c in rows.columns if c not in (*keys, "session")]
        return rows.select(*keys, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), *rest)

    return apply
