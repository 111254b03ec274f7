"""The topics as they come in over time: sent slice by slice, some messages late, and streamed after each.

A table's time span is cut into equal slices. Messages are sent in the slice of their time, every
seventh one slice later, and every eleventh of the first slice only with the last one, when all that they
belong to is closed (``TOO_LATE``; not where a query has to deliver all rows).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemaque.sinks.tables import publish

LATE, TOO_LATE = 7, 11
HOUR_S = 3600


@dataclass(frozen=True)
class Slices:
    """``count`` equal slices of the seconds ``low`` to ``high`` (both included)."""

    low: int
    high: int
    count: int

    @classmethod
    def of(cls, events: DataFrame, count: int) -> Slices:
        seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
        low, high = events.agg(F.min(seconds), F.max(seconds)).first()
        return cls(low or 0, high or 0, count)

    @property
    def width_s(self) -> int:
        return -(-(self.high - self.low + 1) // self.count)

    @property
    def delay(self) -> str:
        """How late a message of one slice may come: until the next one has been sent, and an hour."""
        return f"{self.width_s + HOUR_S} seconds"

    def number(self, time: Column) -> Column:
        """The slice of a time."""
        since = F.unix_seconds(time.cast("timestamp")) - F.lit(self.low)
        return F.call_function("div", since * self.count, F.lit(self.high - self.low + 1).cast("bigint"))

    def sent(self, time: Column, event: Column, too_late: bool = False) -> Column:
        """The slice with which an event's message is sent."""
        own = self.number(time)
        last = F.lit(self.count - 1).cast("bigint")
        sent = F.when(event % LATE == 0, F.least(own + 1, last)).otherwise(own)
        return F.when((own == 0) & (event % TOO_LATE == 0), last).otherwise(sent) if too_late else sent


def send_and_run(count: int, topics: Mapping[str, Callable[[int], DataFrame]], replay: str, run: Callable[[int], object]) -> None:
    """For each slice: send the messages that ``topics`` gives for it, then ``run``, which starts the streams anew."""
    for number in range(count):
        for topic, messages in topics.items():
            publish(messages(number), topic, replay=replay)
        run(number)
