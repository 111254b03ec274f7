"""Request bodies for a line-protocol endpoint, put together on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemaque.operators.codec import Transform

LINES_PER_BODY = 5000


def payload_chunks(lines_per_body: int = LINES_PER_BODY) -> Transform:
    """Batch. Join lines by newline into bodies of at most ``lines_per_body`` lines.

    Input: ``partition``, ``offset``, ``line``. A chunk is a run of offsets of one topic partition,
    so its size has a fixed bound whatever the keys look like, and a redelivery builds the same
    chunk again.
    """
    chunk = F.call_function("div", F.col("offset"), F.lit(lines_per_body).cast("bigint"))

    def apply(lines: DataFrame) -> DataFrame:
        return (
            lines.select("partition", chunk.alias("chunk"), "offset", "line")
            .groupBy("partition", "chunk")
            .agg(
                F.count("line").alias("n_lines"),
                F.expr("listagg(line, '\n') within group (order by offset)").alias("body"),
            )
        )

    return apply
