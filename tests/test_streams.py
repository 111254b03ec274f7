from __future__ import annotations

import time
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from telemaque.operators import codec, trips, upserts
from telemaque.operators.dedupe import dedupe_events
from telemaque.operators.intervals import interval_join
from telemaque.operators.payloads import payload_chunks
from telemaque.schemas import ENVELOPE, TOPICS, TRIP
from telemaque.sinks.tables import append_csv, append_sink, publish, read_csv
from telemaque.sources.topics import TIMEOUT_MS, kafka_options, read_topic, read_topics
from telemaque.streaming.batches import batch_writer
from telemaque.streaming.joins import LARGE_STATE, settings, trip_view_stream
from telemaque.streaming.runner import Sink, StreamsFailed, fan_out, run_stream, start_stream
from telemaque.streaming.service import serve
from tests.samples import EMERGENCY_TEXT, T0, TRIP_TEXT, VEHICLE_TEXT, WEATHER_TEXT, envelope, flat_trips, trip_text
from tests.test_joins import fleet

TOPIC = TOPICS["trajet"].kafka_topic


def messages(spark, n, start=0):
    return envelope(spark, [trip_text(f"T{i % 5}", lat=str(45 + i / 100), flag=i % 7 == 0) for i in range(start, start + n)])


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_kafka_options():
    options = kafka_options("t", "host:9092")
    assert options["startingOffsets"] == "earliest" and "kafka.startingOffsets" not in options
    assert options["subscribe"] == "t" and options["kafka.request.timeout.ms"] == str(TIMEOUT_MS)


def test_exactly_one_source(spark):
    for given in ({}, {"servers": "h:1", "replay": "/x"}):
        with pytest.raises(ValueError):
            read_topic(spark, TOPIC, **given)


def test_source_errors_are_raised(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, TOPIC, servers="nowhere:9092")


@pytest.mark.parametrize("files", [1, 6])
def test_the_stream_gives_the_batch_result(spark, tmp_path, files):
    sent = messages(spark, 60)
    publish(sent.repartition(files), TOPIC, replay=str(tmp_path / "in"))
    stream = read_topic(spark, TOPIC, replay=str(tmp_path / "in"), files_per_batch=1)
    assert stream.isStreaming and stream.schema == ENVELOPE
    path = run_stream(stream.transform(trips.typed_trips(("offset",))), Sink("trajet"), str(tmp_path / "out"))
    assert bag(spark.read.parquet(path)) == bag(sent.transform(trips.typed_trips(("offset",))))


def test_a_second_run_takes_only_what_is_new(spark, tmp_path):
    source, root, sink = str(tmp_path / "in"), str(tmp_path / "out"), Sink("trajet", partition_by=("event_date",))

    def run():
        typed = read_topic(spark, TOPIC, replay=source).transform(trips.typed_trips(("offset",)))
        return spark.read.parquet(run_stream(typed.withColumn("event_date", F.to_date("heure_depart")), sink, root))

    publish(messages(spark, 20), TOPIC, replay=source)
    assert run().count() == 20
    assert run().count() == 20
    publish(messages(spark, 10, start=20), TOPIC, replay=source)
    result = run()
    assert result.count() == result.distinct().count() == 30


def test_line_protocol_stream(spark, tmp_path):
    sent = messages(spark, 30)
    publish(sent, TOPIC, replay=str(tmp_path / "in"))
    lines = read_topic(spark, TOPIC, replay=str(tmp_path / "in")).transform(trips.typed_trips()).transform(trips.line_protocol())
    path = run_stream(lines, Sink("points", "text"), str(tmp_path / "out"))
    assert bag(spark.read.text(path)) == bag(sent.transform(trips.typed_trips()).transform(trips.line_protocol()))


def test_one_failing_stream_leaves_the_others_alone(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    publish(messages(spark, 20), TOPIC, replay=source)
    publish(messages(spark, 20), "other", replay=source)
    streams = read_topics(spark, [TOPIC, "other"], replay=source)
    good = streams["other"].transform(codec.decode_topic(TRIP))
    poison = streams[TOPIC].select(F.raise_error(F.lit("poison")).cast("string").alias("value"))
    with pytest.raises(StreamsFailed) as failure:
        fan_out([(Sink("bad"), poison), (Sink("good"), good)], root, restarts=1)
    assert list(failure.value.errors) == ["bad"] and "poison" in str(failure.value)
    for query in failure.value.running.values():
        query.awaitTermination()
    assert spark.read.parquet(f"{root}/good").count() == 20
    # The failed batch was not committed: once repaired, the stream delivers it whole.
    fan_out([(Sink("bad"), streams[TOPIC].transform(codec.decode_text()))], root)
    assert spark.read.parquet(f"{root}/bad").count() == 20


def test_one_stream_into_two_sinks(spark, tmp_path):
    publish(messages(spark, 20), TOPIC, replay=str(tmp_path / "in"))
    typed = read_topic(spark, TOPIC, replay=str(tmp_path / "in")).transform(trips.typed_trips())
    paths = fan_out([(Sink("rows"), typed), (Sink("points", "text"), typed.transform(trips.line_protocol()))], str(tmp_path / "out"))
    assert spark.read.parquet(paths["rows"]).count() == spark.read.text(paths["points"]).count() == 20


@pytest.mark.parametrize("rejects", [False, True])
def test_the_whole_service_on_replayed_topics(spark, tmp_path, rejects):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    texts = {"trajet": TRIP_TEXT, "cars": VEHICLE_TEXT, "emergency": EMERGENCY_TEXT, "weather": WEATHER_TEXT}
    for name, text in texts.items():
        publish(envelope(spark, [text, "{broken"], TOPICS[name].kafka_topic), TOPICS[name].kafka_topic, replay=source)
    paths = serve(spark, root, replay=source, rejects=rejects)
    for name in texts:
        stored = spark.read.parquet(paths[name])
        assert stored.count() == (1 if rejects else 2)
        assert stored.where(F.col(TOPICS[name].trip_key) == "T-0042").count() == 1
        if rejects:
            assert [r["reason"] for r in spark.read.parquet(paths[f"{name}_rejected"]).collect()] == ["malformed"]
    lines = [r[0] for r in spark.read.text(paths["points"]).collect()]
    assert len(lines) == 1 and lines[0].startswith("trajets,tripId=T-0042,departure=Depot,arrival=Harbour ")


def test_query_a_stream_as_a_table(spark, tmp_path):
    publish(envelope(spark, [TRIP_TEXT]), TOPIC, replay=str(tmp_path / "in"))
    stream = read_topic(spark, TOPIC, replay=str(tmp_path / "in")).transform(codec.decode_topic(TRIP))
    query = stream.writeStream.format("memory").queryName("seen_trips").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.sql("SELECT tripId FROM seen_trips").collect()[0][0] == "T-0042"


def test_console_sink(spark, tmp_path):
    publish(envelope(spark, [TRIP_TEXT]), TOPIC, replay=str(tmp_path / "in"))
    stream = read_topic(spark, TOPIC, replay=str(tmp_path / "in")).transform(codec.decode_topic(TRIP))
    query = stream.writeStream.format("console").option("truncate", "false").trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None


def test_an_empty_topic_writes_nothing(spark, tmp_path):
    publish(envelope(spark, []), TOPIC, replay=str(tmp_path / "in"))
    lines = read_topic(spark, TOPIC, replay=str(tmp_path / "in")).transform(trips.typed_trips()).transform(trips.line_protocol())
    path = run_stream(lines, Sink("points", "text"), str(tmp_path / "out"))
    assert spark.read.text(path).isEmpty()


def test_latest_document_on_a_stream(spark, tmp_path):
    sent = messages(spark, 40)
    publish(sent.repartition(4), TOPIC, replay=str(tmp_path / "in"))
    keep = ("partition", "offset", "timestamp")
    stream = read_topic(spark, TOPIC, replay=str(tmp_path / "in"), files_per_batch=1).transform(trips.typed_trips(keep))
    query = (
        stream.transform(upserts.trip_latest()).writeStream.outputMode("complete").format("memory")
        .queryName("latest_trips").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert bag(spark.table("latest_trips")) == bag(sent.transform(trips.typed_trips(keep)).transform(upserts.trip_latest()))


def test_copies_on_a_stream(spark, tmp_path):
    sent = messages(spark, 20)
    for _ in range(2):
        publish(sent, TOPIC, replay=str(tmp_path / "in"))
    typed = read_topic(spark, TOPIC, replay=str(tmp_path / "in"), files_per_batch=1).transform(trips.typed_trips())
    once = typed.transform(dedupe_events(typed.columns, "heure_depart", "1 hour"))
    path = run_stream(once, Sink("once"), str(tmp_path / "out"))
    assert spark.read.parquet(path).count() == sent.transform(trips.typed_trips()).distinct().count()
    with pytest.raises(ValueError):
        typed.transform(dedupe_events(typed.columns))


def test_four_way_stream_join_equals_batch_and_forgets(spark, tmp_path):
    tables = dict(zip(("trips", "cars", "alarms", "sky"), fleet(spark, 5, pings=24, reports=12, span_s=24 * 3600)))
    tables["trips"] = tables["trips"].drop("partition")
    tables["cars"] = tables["cars"].drop("partition", "offset")
    times = {"trips": "heure_depart", "cars": "DateDebutTrajet", "alarms": "EmergencyTime", "sky": "WeatherTime"}
    steps = 4
    for step in range(steps):  # in the order of event time, as a live topic comes
        for name, df in tables.items():
            low = T0 + timedelta(hours=6 * step)
            part = df.where((F.col(times[name]) >= low) & (F.col(times[name]) < low + timedelta(hours=6)))
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        time.sleep(0.05)  # file order is by modification time
    # Ten days later one more trip starts, which lets all state before it go.
    late = [tables[n].limit(1).withColumn(times[n], F.lit(T0 + timedelta(days=10)).cast("timestamp")) for n in tables]
    for name, df in zip(tables, late):
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    def view(source):
        return source["trips"].transform(
            trip_view_stream(source["cars"], source["alarms"], source["sky"], 6 * 3600, 24 * 3600, "1 hour")
        )

    streams = {
        n: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / n))
        for n, df in tables.items()
    }
    query = (
        view(streams).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    stored = {n: spark.read.parquet(str(tmp_path / n)) for n in tables}
    expected = view(stored)
    assert expected.count() > 20
    assert bag(spark.read.parquet(str(tmp_path / "out"))) == bag(expected)
    state = [sum(op.numRowsTotal for op in p.stateOperators) for p in query.recentProgress if p.stateOperators]
    assert max(state) > 0 and state[-1] < max(state) / 2


def test_time_bounded_joins_keep_few_copies_and_settings_end(spark, tmp_path):
    trips, _, alarms, _ = fleet(spark, 5, pings=40, reports=60)
    streams = {}
    for name, df in (("trips", trips), ("alarms", alarms)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        streams[name] = spark.readStream.schema(df.schema).parquet(str(tmp_path / name))
    bound = ("tripId", "emergencyTrip"), ("heure_depart", "EmergencyTime"), 6 * 3600
    joined = streams["trips"].withWatermark("heure_depart", "30 days").transform(
        interval_join(streams["alarms"].withWatermark("EmergencyTime", "30 days"), *bound)
    )
    before = {name: spark.conf.get(name, None) for name in LARGE_STATE}
    with settings(spark, LARGE_STATE):
        query = start_stream(joined, Sink("joined"), str(tmp_path / "out"))
        query.awaitTermination()
    assert {name: spark.conf.get(name, None) for name in LARGE_STATE} == before
    progress = [p for p in query.recentProgress if p.stateOperators]
    assert len(progress) == 1  # no batch without messages
    # Each side is in the state once as a row and, by key and slot, once as a number of rows.
    keys = trips.select("tripId", F.col("heure_depart").cast("date")).distinct().count()
    assert progress[0].stateOperators[0].numRowsTotal <= 40 + 2 * 60 + keys
    assert bag(spark.read.parquet(str(tmp_path / "out" / "joined"))) == bag(trips.transform(interval_join(alarms, *bound)))


def test_pings_with_many_reports_are_in_the_state_once(spark, tmp_path):
    """Pairs of pings and alarms once were state of their own; reports meet each other first now, in one store for a join's partition."""
    def at(hours):
        return T0 + timedelta(hours=hours)

    pings = [(0, i, trip, "A", 45.0, -71.0, "B", 46.5, -71.5, at(i / 100), False) for i, trip in enumerate(["T0"] * 100 + ["T1"] * 4)]
    tables = {
        "trips": flat_trips(spark, pings).drop("partition"),
        "cars": spark.createDataFrame([(f"V{i}", f"T{i}", T0) for i in (0, 1)], "immatriculation string, IDTrajet string, DateDebutTrajet timestamp"),
        "alarms": spark.createDataFrame([("T0", at(1 + i / 10), "FIRE") for i in range(8)] + [("T1", at(-4.99), "FIRE"), ("T1", at(-4), "FIRE")], "emergencyTrip string, EmergencyTime timestamp, emergencyType string"),
        # Those of T0 are near no ping; T1's are near its pings, the last one near some of them only, and twelve hours from an alarm.
        "sky": spark.createDataFrame([("T0", at(90), "SNOW"), ("T1", at(2), "RAIN"), ("T1", at(7.015), "SNOW")], "weatherTrip string, WeatherTime timestamp, weatherCondition string"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(str(tmp_path / name))

    def view(source):
        return source["trips"].transform(trip_view_stream(source["cars"], source["alarms"], source["sky"], 6 * 3600, 240 * 3600, "30 days"))

    def state(name, more):
        streams = {n: spark.readStream.schema(df.schema).parquet(str(tmp_path / n)) for n, df in tables.items()}
        with settings(spark, {**LARGE_STATE, **more}):
            query = start_stream(view(streams), Sink(name), str(tmp_path / "out"))
            query.awaitTermination()
        return next(p.stateOperators for p in query.recentProgress if p.stateOperators)

    counted = state("counted", {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "true"})
    assert sum(op.numRowsTotal for op in counted) < 2 * len(pings) + 100
    plain = state("plain", {})
    assert all(op.numStateStoreInstances == op.numShufflePartitions for op in plain)
    t1 = [(p[9], a, w) for p in pings[100:] for a in (at(-4.99), at(-4)) for w in (at(2), at(7.015)) if all(abs(x - p[9]) <= timedelta(hours=6) for x in (a, w))]
    for name in ("counted", "plain"):
        rows = spark.read.parquet(str(tmp_path / "out" / name))
        assert bag(rows) == bag(view(tables)) and rows.count() == len(t1) > 4


def test_a_repeated_batch_replaces_its_first_attempt(spark, tmp_path):
    """The callback by itself: running it under a stream would open a callback port."""
    target = str(tmp_path / "bodies")
    lines = messages(spark, 25).transform(trips.typed_trips(("partition", "offset"))).transform(
        trips.line_protocol(("partition", "offset"))
    )
    write = batch_writer(target, "parquet", payload_chunks(10))
    write(lines, 0)
    write(lines.where("offset < 5"), 1)
    write(lines, 0)
    write(lines.limit(0), 2)
    bodies = spark.read.parquet(target)
    assert bag(bodies.groupBy("batch_id").agg(F.sum("n_lines"))) == Counter([(0, 25), (1, 5)])


def test_append_sink(spark, tmp_path):
    rows = messages(spark, 10).transform(trips.typed_trips())
    for fmt in ("parquet", "orc", "json", "csv"):
        for _ in range(2):
            append_sink(rows, str(tmp_path / fmt), fmt)
        reader = spark.read.schema(rows.schema).format(fmt)
        assert bag(reader.load(str(tmp_path / fmt))) == bag(rows.unionAll(rows))


def test_a_dead_stream_is_reported_while_another_runs(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    publish(messages(spark, 20), TOPIC, replay=source)
    stream = read_topic(spark, TOPIC, replay=source)
    poison = stream.select(F.raise_error(F.lit("poison")).cast("string").alias("value"))
    served = {"processingTime": "1 second"}
    with pytest.raises(StreamsFailed) as failure:
        fan_out([(Sink("bad"), poison), (Sink("good"), stream.transform(codec.decode_topic(TRIP)))], root, served, restarts=0)
    (good,) = failure.value.running.values()
    assert good.isActive
    good.stop()
    with pytest.raises(StreamsFailed) as failure:
        fan_out([(Sink("bad2"), poison), (Sink("good2"), stream)], root, served, restarts=0, stop_others=True)
    assert not failure.value.running and not spark.streams.active


def test_looking_at_a_stream(spark, tmp_path):
    publish(messages(spark, 5), TOPIC, replay=str(tmp_path / "in"))
    stream = read_topic(spark, TOPIC, replay=str(tmp_path / "in")).transform(trips.typed_trips())
    for fmt in ("memory", "console"):
        start_stream(stream, Sink("looked_at", fmt), "").awaitTermination()
    assert spark.table("looked_at").count() == 5


def test_csv_comes_back_as_it_was(spark, tmp_path):
    texts = ["a\nb", "", None, " x ", "~", 'q"q', "back\\slash\\n", "\r\n", "\\", "é,;"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    append_csv(rows, str(tmp_path / "csv"))
    assert bag(read_csv(spark, str(tmp_path / "csv"), rows.schema)) == bag(rows)


def test_partition_values_are_written_by_few_tasks(spark, tmp_path):
    rows = spark.range(0, 10000, numPartitions=16).selectExpr("id", "id % 5 as part")
    append_sink(rows, str(tmp_path / "out"), partition_by=("part",))
    files = list((tmp_path / "out").glob("part=*/*.parquet"))
    assert len(files) < 16 and spark.read.parquet(str(tmp_path / "out")).count() == 10000


def test_options_of_a_live_topic():
    options = kafka_options("t", "host:1", "latest", 500, **{"kafka.request.timeout.ms": "7"})
    assert (options["startingOffsets"], options["maxOffsetsPerTrigger"], options["kafka.request.timeout.ms"]) == ("latest", "500", "7")
    assert kafka_options("t", "host:1", startingOffsets="{}")["startingOffsets"] == "{}"
    assert "maxOffsetsPerTrigger" not in kafka_options("t", "host:1")
