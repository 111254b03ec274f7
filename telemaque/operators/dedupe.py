"""Redelivered messages: keep one of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from telemaque.operators.codec import Transform


def dedupe_events(columns: Sequence[str], event_time: str | None = None, delay: str | None = None) -> Transform:
    """One row per combination of ``columns``.

    On a stream give the event time and the delay within which copies arrive; state older than
    that is dropped.
    """

    def apply(df: DataFrame) -> DataFrame:
        if df.isStreaming:
            if event_time is None or delay is None:
                raise ValueError("a stream needs event_time and delay")
            return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(columns))
        return df.dropDuplicates(list(columns))

    return apply
