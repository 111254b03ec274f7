"""The running service: four topics in; parquet per topic and line protocol for the trips out.

``spark-submit telemaque/streaming/service.py --servers host:9092 --root s3a://bucket/raw_data``
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemaque.operators import codec, trips
from telemaque.schemas import TOPICS, TRIP
from telemaque.sinks.keyed import KeyedTable
from telemaque.sources.topics import read_topic
from telemaque.streaming.batches import batch_writer
from telemaque.streaming.ledger import Ledger
from telemaque.streaming.runner import AVAILABLE_NOW, Sink, StreamsFailed, fan_out

# What orders messages of one time: kept in stored rows, as the upserts need it.
PLACE = ("partition", "offset", "timestamp")


def service_streams(messages: Mapping[str, DataFrame], rejects: bool = False) -> list[tuple[Sink, DataFrame]]:
    """The sinks of the service, given each topic's messages.

    Every message becomes a row, unusable ones a row of NULLs. With ``rejects`` these go, with their
    payload and the reason, to ``<topic>_rejected`` instead.
    """
    streams: list[tuple[Sink, DataFrame]] = []
    for name, sent in messages.items():
        schema = TOPICS[name].schema
        if rejects:
            inspected = sent.transform(codec.inspect_topic(schema, PLACE))
            streams.append((Sink(f"{name}_rejected"), inspected.transform(codec.rejected(schema))))
            rows = inspected.transform(codec.accepted)
        else:
            rows = sent.transform(codec.decode_topic(schema, PLACE))
        if schema is TRIP:
            rows = rows.transform(trips.flatten_trip(PLACE)).transform(trips.cast_positions)
            streams.append((Sink("points", "text"), rows.transform(trips.line_protocol(strict=rejects))))
        day = F.to_date(F.coalesce(F.col(TOPICS[name].event_time), F.col("timestamp")))
        streams.append((Sink(name, partition_by=("event_date",)), rows.withColumn("event_date", day)))
    return streams


def serve(
    spark: SparkSession,
    root: str,
    servers: str | None = None,
    replay: str | None = None,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    rejects: bool = False,
    zone: str = "UTC",
    starting: str = "earliest",
    offsets_per_batch: int | None = None,
) -> dict[str, str]:
    """Run the service on live topics or on replayed ones. Returns the path by sink name.

    ``zone``: the time zone in which the messages' times, which name none, are meant; set on the session.
    """
    spark.conf.set("spark.sql.session.timeZone", zone)
    messages = {
        name: read_topic(
            spark, topic.kafka_topic, servers=servers, replay=replay, starting=starting, offsets_per_batch=offsets_per_batch
        )
        for name, topic in TOPICS.items()
    }
    return fan_out(service_streams(messages, rejects), root, trigger)


def serve_runs(
    spark: SparkSession, root: str, servers: str | None = None, replay: str | None = None, zone: str = "UTC", starting: str = "earliest",
    offsets_per_batch: int | None = None,
) -> dict[str, str]:
    """Take in what the topics hold now, each read and parsed once, and serve all sinks from that.

    The sinks of :func:`serve`, one folder per batch, and ``latest``: a document per trip. Call it again and
    again; every call goes on where each sink is. Returns the path by sink name.
    """
    spark.conf.set("spark.sql.session.timeZone", zone)
    paths = {name: f"{root}/{name}" for name in (*TOPICS, "points", "latest")}
    failed: dict[str, Exception] = {}
    for name, topic in TOPICS.items():
        sent = read_topic(spark, topic.kafka_topic, servers=servers, replay=replay, starting=starting, offsets_per_batch=offsets_per_batch)
        rows = sent.transform(codec.decode_topic(topic.schema, PLACE))
        sinks = {name: batch_writer(paths[name])}
        if topic.schema is TRIP:
            rows = rows.transform(trips.flatten_trip(PLACE)).transform(trips.cast_positions)
            latest = KeyedTable(paths["latest"], ("tripId",))
            sinks["points"] = batch_writer(paths["points"], "text", trips.line_protocol())
            sinks["latest"] = lambda batch, number, table=latest: table.merge(batch.where("tripId is not null"), number)
        try:
            ledger = Ledger(f"{root}/_ledgers/{name}")
            ledger.pull(rows)
            ledger.deliver(spark, sinks)
        except StreamsFailed as failure:
            failed |= failure.errors
        except Exception as error:  # noqa: BLE001 - the other topics are served all the same
            failed[name] = error
    if failed:
        raise StreamsFailed(failed)
    return paths


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--replay", help="folder with one sub-folder of envelope files per topic")
    parser.add_argument("--root", required=True, help="folder for rows and checkpoints, shared by all executors")
    parser.add_argument("--every", help="processing-time trigger such as '10 seconds'; without it, catch up and stop")
    parser.add_argument("--zone", default="UTC", help="time zone of the messages' times")
    parser.add_argument("--starting", default="earliest", help="where a first start begins: earliest, latest or offsets in JSON")
    parser.add_argument("--offsets-per-batch", type=int, help="most messages of a topic in one batch")
    parser.add_argument("--rejects", action="store_true", help="keep unusable messages apart")
    parser.add_argument("--one-read", action="store_true", help="catch up, read each topic once for all its sinks, and stop")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("fleet telemetry").getOrCreate()
    if args.one_read:
        serve_runs(spark, args.root, args.servers, args.replay, args.zone, args.starting, args.offsets_per_batch)
        return
    trigger = {"processingTime": args.every} if args.every else AVAILABLE_NOW
    serve(
        spark, args.root, args.servers, args.replay, trigger, args.rejects, args.zone, args.starting, args.offsets_per_batch
    )


if __name__ == "__main__":
    main()
