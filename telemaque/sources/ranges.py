"""Part of a topic as a table: from and to offsets of each partition, or times."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemaque.schemas import ENVELOPE


@dataclass(frozen=True)
class OffsetRange:
    """Messages of one partition from ``start`` (included) to ``end`` (not included; None: to the last)."""

    partition: int
    start: int = 0
    end: int | None = None

    def __post_init__(self) -> None:
        if self.end is not None and self.end < self.start:
            raise ValueError(f"the range of partition {self.partition} ends before it starts")

    def condition(self) -> Column:
        inside = (F.col("partition") == self.partition) & (F.col("offset") >= self.start)
        return inside if self.end is None else inside & (F.col("offset") < self.end)


def range_options(topic: str, servers: str, ranges: list[OffsetRange]) -> dict[str, str]:
    """Options of Spark's batch Kafka source for ``ranges``. It wants every partition of the topic named."""
    ends = {str(r.partition): -1 if r.end is None else r.end for r in ranges}
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": json.dumps({topic: {str(r.partition): r.start for r in ranges}}),
        "endingOffsets": json.dumps({topic: ends}),
    }


def read_offsets(spark: SparkSession, topic: str, ranges: list[OffsetRange], servers: str | None = None, replay: str | None = None) -> DataFrame:
    """The messages of ``ranges``, from ``servers`` or from the replay folder.

    Partitions without a range have no rows. In a replay the ranges are pushed into the scan, whose statistics
    let it pass over the files and row groups that hold none of them.
    """
    if (servers is None) == (replay is None):
        raise ValueError("give either servers or replay")
    if len({r.partition for r in ranges}) < len(ranges):
        raise ValueError("a partition has one range")
    if servers is not None:
        return spark.read.format("kafka").options(**range_options(topic, servers, ranges)).load()
    sent = spark.read.schema(ENVELOPE).parquet(f"{replay}/{topic}")
    return sent.where(reduce(lambda a, b: a | b, [r.condition() for r in ranges], F.lit(False)))


def offsets_of_times(sent: DataFrame, start: datetime | None = None, end: datetime | None = None) -> list[OffsetRange]:
    """The smallest range of each partition that holds its messages of the broker's times from ``start`` to before ``end``.

    A partition's times may go back, so a range can hold a few messages of other times. What comes to the driver
    is two numbers per partition of the topic.
    """
    inside = sent if start is None else sent.where(F.col("timestamp") >= F.lit(start))
    inside = inside if end is None else inside.where(F.col("timestamp") < F.lit(end))
    found = inside.groupBy("partition").agg(F.min("offset").alias("first"), F.max("offset").alias("last")).collect()
    return [OffsetRange(r["partition"], r["first"], r["last"] + 1) for r in sorted(found)]


def committed(sent: DataFrame, seen: Mapping[int, int]) -> list[OffsetRange]:
    """The ranges after the last ``seen`` offset of each partition, up to what the topic holds now."""
    found = sent.groupBy("partition").agg(F.min("offset").alias("first"), F.max("offset").alias("last")).collect()
    starts = {r["partition"]: seen.get(r["partition"], r["first"] - 1) + 1 for r in found}
    return [OffsetRange(r["partition"], starts[r["partition"]], r["last"] + 1) for r in sorted(found) if starts[r["partition"]] <= r["last"]]
