"""Windows, keyed tables and ledgers: late messages, restarts, batches that break off or come twice."""

from __future__ import annotations

import random
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from telemaque.operators import trips, upserts, windows
from telemaque.plans import binding
from telemaque.plans.slices import Slices
from telemaque.schemas import TOPICS, TRIP
from telemaque.sinks import keyed
from telemaque.sinks.compacted import CompactedTable
from telemaque.sinks.keyed import KeyedTable
from telemaque.sinks.tables import publish
from telemaque.sources import ranges
from telemaque.sources.ranges import OffsetRange
from telemaque.sources.topics import read_topic
from telemaque.streaming.batches import batch_writer
from telemaque.streaming.ledger import Ledger
from telemaque.streaming.runner import Sink, StreamsFailed, start_stream
from telemaque.streaming.service import serve_runs
from telemaque.workspace import get_text, listed, put_text, removed
from tests.samples import EMERGENCY_TEXT, T0, TRIP_TEXT, VEHICLE_TEXT, WEATHER_TEXT, envelope, flat_trips, trip_text

TOPIC = TOPICS["trajet"].kafka_topic


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def ping(trip, minutes, flag=False):
    return trip_text(trip, time=(T0 + timedelta(minutes=minutes)).isoformat(), flag=flag)


class Fed:
    """A stream that is started anew after each batch of texts, and what its progress said."""

    def __init__(self, spark, folder, transform):
        self.spark, self.folder, self.transform, self.progress = spark, str(folder), transform, []

    def send(self, texts):
        publish(envelope(self.spark, texts).coalesce(1), TOPIC, replay=f"{self.folder}/in")
        typed = read_topic(self.spark, TOPIC, replay=f"{self.folder}/in").transform(trips.typed_trips())
        query = start_stream(typed.transform(self.transform), Sink("out"), f"{self.folder}/out")
        query.awaitTermination()
        self.progress += [p for p in query.recentProgress if p["stateOperators"]]
        return self

    @property
    def rows(self):
        return self.spark.read.parquet(f"{self.folder}/out/out")

    @property
    def state(self):
        return [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in self.progress]

    @property
    def dropped(self):
        return sum(op["numRowsDroppedByWatermark"] for p in self.progress for op in p["stateOperators"])


def test_a_late_ping_joins_two_sessions_and_a_later_one_is_dropped(spark, tmp_path):
    fed = Fed(spark, tmp_path, windows.sessions(("tripId",), "10 minutes", "1 hour"))
    fed.send([ping("A", 0), ping("A", 16), ping("B", 3)])
    fed.send([ping("A", 8, flag=True), ping("B", 50)])  # closes the gap, after a restart
    fed.send([ping("Z", 300)])
    fed.send([ping("A", 5), ping("Z", 301)])  # far too late
    got = {(r.tripId, r.n_pings): (r.session_start, r.session_end, r.n_arrivals) for r in fed.rows.collect()}
    at = lambda m: T0 + timedelta(minutes=m)
    assert got == {("A", 3): (at(0), at(26), 1), ("B", 1): got["B", 1]} and fed.rows.count() == 3
    assert fed.dropped == 1 and max(fed.state) >= 3 and fed.state[-1] == 1


def test_windows_on_a_stream_are_those_of_the_batch_and_state_shrinks(spark, tmp_path):
    rnd = random.Random(2)
    minutes = sorted(rnd.randrange(0, 3000) for _ in range(300))
    texts = [ping(f"T{rnd.randrange(4)}", m, rnd.random() < 0.2) for m in minutes]
    for name, make in (("fixed", lambda d: windows.fixed_windows(("tripId",), "4 hours", "1 hour", d)), ("gap", lambda d: windows.sessions(("tripId",), "30 minutes", d))):
        fed = Fed(spark, tmp_path / name, make("2 hours"))
        for i in range(0, 300, 100):
            fed.send(texts[i : i + 100])
        fed.send([ping("end", 100_000)])
        whole = envelope(spark, texts).transform(trips.typed_trips()).transform(make(None))
        assert bag(fed.rows) == bag(whole)
        assert fed.state[-1] <= 4 < max(fed.state) and not fed.dropped


def test_windows_of_a_batch(spark):
    rows = flat_trips(spark, [(0, i, "T", "A", 1.0, 2.0, "B", 1.0, 2.0, t, False) for i, t in enumerate([T0, T0, None, T0 + timedelta(hours=2)])])
    days = rows.transform(windows.fixed_windows(("tripId",), "1 day")).collect()
    assert [(r.n_pings, r.n_arrivals) for r in days] == [(3, 0)]
    apart = rows.transform(windows.sessions(("tripId",), "1 hour")).collect()
    assert sorted(r.n_pings for r in apart) == [1, 2]
    assert rows.limit(0).transform(windows.sessions(("tripId",), "1 hour")).collect() == []
    with pytest.raises(ValueError):
        read = spark.readStream.schema(rows.schema).parquet("/nowhere*")
        read.transform(windows.sessions(("tripId",), "1 hour"))


def test_slices_cover_the_span(spark):
    events = spark.createDataFrame([(i, T0 + timedelta(seconds=i)) for i in range(100)], "event_id long, ts timestamp_ntz")
    for count in (1, 3, 7):
        slices = Slices.of(events, count)
        sizes = bag(events.select(slices.number(F.col("ts")))).values()
        assert len(sizes) == count and max(sizes) <= slices.width_s and sum(sizes) == 100
        sent = bag(events.select(slices.sent(F.col("ts"), F.col("event_id"), too_late=True)))
        assert set(sent) <= {(i,) for i in range(count)} and sum(sent.values()) == 100
    assert Slices.of(events.limit(0), 3).width_s == 1


# -- keyed tables ------------------------------------------------------------------------------------


def pings(spark, rnd, n):
    rows = [
        (rnd.randrange(3), rnd.randrange(50), rnd.choice(["T1", "T2", "T3", None]), "A", 1.0, 2.0, "B", 1.0, 2.0, T0 + timedelta(minutes=rnd.randrange(20)), rnd.random() < 0.3, T0)
        for _ in range(n)
    ]
    return flat_trips(spark, rows)


def test_a_keyed_table_equals_one_pass_over_all_batches(spark, tmp_path):
    rnd = random.Random(1)
    batches = [pings(spark, rnd, 30).cache() for _ in range(4)]
    table = KeyedTable(str(tmp_path / "t"), ("tripId", "departure_name"), buckets=3)
    with pytest.raises(ValueError):
        table.read(spark)
    for i, batch in enumerate(batches):
        table.merge(batch, i)
        table.merge(batches[0], i)  # comes again: that version is there
        table.merge(batches[0], 0)
        whole = batches[0]
        for b in batches[1 : i + 1]:
            whole = whole.unionByName(b)
        assert bag(table.read(spark)) == bag(whole.transform(upserts.last_write(("tripId", "departure_name"))).select(*batch.columns))
    assert table.versions(spark) == [0, 1, 2, 3]
    before, last = bag(table.read(spark, 2)), bag(table.read(spark))
    table.expire(spark, keep=2)
    assert table.versions(spark) == [2, 3] and bag(table.read(spark, 2)) == before and bag(table.read(spark)) == last
    table.merge(batches[0].limit(0), 4)
    assert bag(table.read(spark)) == last and table.versions(spark)[-1] == 4


def test_only_touched_buckets_are_written_again(spark, tmp_path):
    rows = spark.range(200).selectExpr("id", "0 as v")
    table = KeyedTable(str(tmp_path / "t"), ("id",), ("v",), buckets=16)
    table.merge(rows, 0)
    table.merge(rows.where("id = 7").withColumn("v", F.lit(1)), 1)
    folders = [table._manifest(spark, v)["folders"] for v in (0, 1)]
    assert len(folders[0]) == 16 and sum(folders[0][b] != folders[1][b] for b in folders[0]) == 1
    assert bag(table.read(spark).where("v = 1")) == Counter([(7, 1)]) and table.read(spark).count() == 200


def test_a_merge_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    table = KeyedTable(str(tmp_path / "t"), ("id",), ("v",), buckets=4)
    table.merge(spark.range(50).selectExpr("id", "0 as v"), 0)
    write = keyed.append_sink

    def breaking(df, path, **options):
        write(df.where("id < 20"), path, **options)
        raise OSError("gone")

    more = spark.range(100).selectExpr("id", "1 as v")
    monkeypatch.setattr(keyed, "append_sink", breaking)
    with pytest.raises(OSError):
        table.merge(more, 1)
    assert table.versions(spark) == [0] and bag(table.read(spark).groupBy("v").count()) == Counter([(0, 50)])
    monkeypatch.setattr(keyed, "append_sink", write)
    table.merge(more, 1)
    assert bag(table.read(spark).groupBy("v").count()) == Counter([(1, 100)])
    table.expire(spark, keep=1)
    assert len(listed(spark, f"{table.root}/data")) == 1


# -- ledgers -----------------------------------------------------------------------------------------


def typed(spark, folder):
    return read_topic(spark, TOPIC, replay=f"{folder}/in").transform(trips.typed_trips(("offset",)))


def test_each_sink_gets_each_run_once(spark, tmp_path):
    ledger, seen = Ledger(f"{tmp_path}/ledger"), {"a": Counter(), "b": Counter()}
    sent, broken = Counter(), []

    def note(name):
        def write(batch, run):
            if name == "b" and run == 1 and len(broken) < 2:
                broken.append(run)
                raise OSError("gone")
            seen[name] += Counter({(run, *r): n for r, n in bag(batch.select("offset", "tripId")).items()})

        return write

    sinks = {name: note(name) for name in seen}
    for run in range(4):
        texts = [ping(f"T{run}", i) for i in range(5)]
        publish(envelope(spark, texts), TOPIC, replay=f"{tmp_path}/in")
        sent += Counter((run, i, f"T{run}") for i in range(5))
        assert ledger.pull(typed(spark, tmp_path)) == run
        if run in (1, 2):
            with pytest.raises(StreamsFailed) as failure:
                ledger.deliver(spark, sinks)
            assert list(failure.value.errors) == ["b"]
            assert (ledger.delivered(spark, "a"), ledger.delivered(spark, "b")) == (run, 0)
        else:
            ledger.deliver(spark, sinks)
    assert seen["a"] == seen["b"] == sent and ledger.delivered(spark, "b") == 3
    ledger.deliver(spark, {"new": note("a")})  # a sink that joins later gets all runs
    assert seen["a"] == sent + sent
    # One read of the source per run: the stream's own counts.
    logged = spark.read.parquet(f"{tmp_path}/ledger/log")
    assert logged.groupBy("run").count().collect() and bag(logged.groupBy("run").count()) == Counter([(i, 5) for i in range(4)])


def test_a_pull_that_breaks_off_goes_on_with_its_run(spark, tmp_path, monkeypatch):
    ledger = Ledger(f"{tmp_path}/ledger")
    publish(envelope(spark, [ping("T", i) for i in range(6)]), TOPIC, replay=f"{tmp_path}/in")
    commit = Ledger._commit
    monkeypatch.setattr(Ledger, "_commit", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        ledger.pull(typed(spark, tmp_path))  # the rows are there, the run is not
    assert ledger.finished(spark) == -1
    monkeypatch.setattr(Ledger, "_commit", commit)
    publish(envelope(spark, [ping("T", 9)]), TOPIC, replay=f"{tmp_path}/in")
    assert ledger.pull(typed(spark, tmp_path)) == 0 and ledger.rows(spark, 0).count() == 7
    assert ledger.pull(typed(spark, tmp_path)) == 1 and ledger.rows(spark, 1).count() == 0


def test_an_empty_topic_has_empty_runs(spark, tmp_path):
    publish(envelope(spark, []), TOPIC, replay=f"{tmp_path}/in")
    ledger = Ledger(f"{tmp_path}/ledger")
    ledger.pull(typed(spark, tmp_path))
    ledger.deliver(spark, {"rows": batch_writer(f"{tmp_path}/rows"), "table": KeyedTable(f"{tmp_path}/t", ("tripId",)).merge})
    assert ledger.rows(spark, 0).collect() == [] and KeyedTable(f"{tmp_path}/t", ("tripId",)).read(spark).collect() == []


def test_the_service_with_one_read(spark, tmp_path):
    source, root = f"{tmp_path}/in", f"{tmp_path}/out"
    texts = {"trajet": TRIP_TEXT, "cars": VEHICLE_TEXT, "emergency": EMERGENCY_TEXT, "weather": WEATHER_TEXT}
    for round_ in range(2):
        for name, text in texts.items():
            publish(envelope(spark, [text, "{broken"], TOPICS[name].kafka_topic), TOPICS[name].kafka_topic, replay=source)
        paths = serve_runs(spark, root, replay=source)
        for name in texts:
            assert spark.read.parquet(paths[name]).count() == 2 * (round_ + 1)
        assert spark.read.text(paths["points"]).count() == round_ + 1
        latest = KeyedTable(paths["latest"], ("tripId",)).read(spark).collect()
        assert [r.tripId for r in latest] == ["T-0042"]


def test_an_arrival_repeats_the_last_ping_elsewhere(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = binding.stored_rows(events)
    assert rows.schema["tripId"].dataType == TRIP["tripId"].dataType
    last = {r.tripId: r for r in rows.transform(trips.flatten_trip(("partition", "offset"))).transform(trips.cast_positions).withColumn("timestamp", F.col("heure_depart")).transform(upserts.trip_latest()).collect()}
    even = {t for t in last if int(t[2:]) % 2 == 0}
    assert even and all(last[t].flag_arrivee for t in even) and rows.count() == events.count() + len(even)


def test_small_files(spark, tmp_path):
    path = f"{tmp_path}/a/b"
    assert listed(spark, f"{tmp_path}/a") == [] and not removed(spark, path)
    put_text(spark, path, "é\n")
    put_text(spark, path, "second")
    assert get_text(spark, path) == "é\n" and listed(spark, f"{tmp_path}/a") == ["b"]
    assert removed(spark, f"{tmp_path}/a") and listed(spark, f"{tmp_path}/a") == []


# -- compaction and ranges ---------------------------------------------------------------------------


def test_compaction_keeps_rows_and_bounds_files(spark, tmp_path, monkeypatch):
    rows = spark.range(4000).selectExpr("id", "cast(id % 10 as int) as batch", "uuid() as note").cache()
    table = CompactedTable(str(tmp_path / "t"), rows.schema, target_bytes=60_000)
    assert table.read(spark).collect() == [] and table.compact(spark) == -1
    files = lambda: len(set(table.read(spark).inputFiles()))
    for n in range(10):
        table.write(rows.where(F.col("batch") == n).repartition(8), n)
        table.write(rows.where(F.col("batch") == n).repartition(8), n)  # comes again
        if n == 4:
            before = files()
            assert table.compact(spark) == 0 and files() < before / 4
            table.write(rows.limit(1), 2)  # compacted already: passed over
    assert bag(table.read(spark)) == bag(rows)
    readers = table.read(spark)  # planned before the switch
    write = CompactedTable.compact
    monkeypatch.setattr("telemaque.sinks.compacted.put_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        write(table, spark)
    assert table.generations(spark) == [0] and bag(table.read(spark)) == bag(rows)
    monkeypatch.undo()
    assert table.compact(spark) == 1 and bag(table.read(spark)) == bag(readers) == bag(rows)
    table.expire(spark)
    assert bag(table.read(spark)) == bag(rows) and table.generations(spark) == [1] and table.batches(spark) == []
    assert len(listed(spark, f"{table.root}/data")) == len(table.manifest(spark)["folders"])
    assert all(f["bytes"] < 5 * table.target_bytes for f in table.manifest(spark)["folders"]) and files() <= 12


def test_ranges_of_offsets_and_times(spark, tmp_path):
    for partition in range(3):
        publish(envelope(spark, [ping("T", i) for i in range(50)], partition=partition), TOPIC, replay=str(tmp_path))
    wanted = [OffsetRange(0, 5, 8), OffsetRange(2, 48)]
    found = ranges.read_offsets(spark, TOPIC, wanted, replay=str(tmp_path))
    assert bag(found.select("partition", "offset")) == Counter([(0, 5), (0, 6), (0, 7), (2, 48), (2, 49)])
    assert "PushedFilters: [Or(" in found._jdf.queryExecution().toString()
    assert ranges.read_offsets(spark, TOPIC, [], replay=str(tmp_path)).collect() == []
    sent = spark.read.parquet(f"{tmp_path}/{TOPIC}")
    at = lambda s: T0 + timedelta(seconds=s)
    assert ranges.offsets_of_times(sent, at(10), at(12)) == [OffsetRange(p, 10, 12) for p in range(3)]
    assert ranges.offsets_of_times(sent, at(500)) == []
    assert ranges.committed(sent, {0: 47, 1: 49}) == [OffsetRange(0, 48, 50), OffsetRange(2, 0, 50)]


def test_options_of_a_range():
    options = ranges.range_options("t", "h:1", [OffsetRange(0, 5, 8), OffsetRange(1)])
    assert options["startingOffsets"] == '{"t": {"0": 5, "1": 0}}' and options["endingOffsets"] == '{"t": {"0": 8, "1": -1}}'
    for wrong in ({"ranges": [OffsetRange(0)], "servers": "h", "replay": "r"}, {"ranges": [OffsetRange(0), OffsetRange(0, 3)], "replay": "r"}):
        with pytest.raises(ValueError):
            ranges.read_offsets(None, "t", **wrong)
    with pytest.raises(ValueError):
        OffsetRange(0, 5, 4)
