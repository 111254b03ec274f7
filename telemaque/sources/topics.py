"""Topic sources: a Kafka topic, or a folder of envelope files replayed as if it were one."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from telemaque.schemas import ENVELOPE

log = logging.getLogger(__name__)

# Fixed value: how long a broker may take to answer.
TIMEOUT_MS = 3000
# A replay makes progress, and a checkpoint, every so many files.
FILES_PER_BATCH = 1000


def kafka_options(
    topic: str, servers: str, starting: str = "earliest", offsets_per_batch: int | None = None, **options: str
) -> dict[str, str]:
    """Options of Spark's Kafka source. Client settings carry the ``kafka.`` prefix, Spark's own do not.

    ``offsets_per_batch`` paces a batch over what a topic retains; ``options`` win over all others.
    """
    pace = {} if offsets_per_batch is None else {"maxOffsetsPerTrigger": str(offsets_per_batch)}
    defaults = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "kafka.request.timeout.ms": str(TIMEOUT_MS),
        "kafka.metadata.fetch.timeout.ms": str(TIMEOUT_MS),
    }
    return defaults | pace | options


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: str | None = None,
    replay: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    starting: str = "earliest",
    offsets_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream of a topic's messages, from ``servers`` or replayed from the folder ``replay``.

    Give exactly one of the two. ``starting`` and ``offsets_per_batch`` are for servers,
    ``files_per_batch`` for a replay; ``options`` of the source win. Errors are logged and raised.
    """
    if (servers is None) == (replay is None):
        raise ValueError("give either servers or replay")
    try:
        if servers is not None:
            return spark.readStream.format("kafka").options(
                **kafka_options(topic, servers, starting, offsets_per_batch, **options)
            ).load()
        reader = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", files_per_batch).options(**options)
        return reader.parquet(f"{replay}/{topic}")
    except Exception:
        log.exception("cannot read topic %s", topic)
        raise


def read_topics(spark: SparkSession, topics: list[str], **source: str) -> dict[str, DataFrame]:
    """One independent stream per topic."""
    return {topic: read_topic(spark, topic, **source) for topic in topics}
