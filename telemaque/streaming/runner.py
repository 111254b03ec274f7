"""Run checkpointed streams into files, several side by side.

The file sink is used as it is: with its checkpoint it writes every batch exactly once, so a batch
that fails is retried and never lost or doubled. No Python callback per batch.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)

SHOWN = ("memory", "console")
AVAILABLE_NOW: Mapping[str, object] = {"availableNow": True}
POLL_S = 0.05
PAUSE_S = 0.5


@dataclass(frozen=True)
class Sink:
    """A named sink: rows under ``<root>/<name>``, checkpoint under ``<root>/_checkpoints/<name>``.

    Formats ``memory`` (a table called ``name``) and ``console`` keep neither: they are for looking at a
    stream, and begin anew with each start.
    """

    name: str
    fmt: str = "parquet"
    partition_by: tuple[str, ...] = ()
    options: Mapping[str, str] = field(default_factory=dict)

    def path(self, root: str) -> str:
        return f"{root}/{self.name}"

    def checkpoint(self, root: str) -> str:
        return f"{root}/_checkpoints/{self.name}"


class StreamsFailed(RuntimeError):
    """A stream has failed for good; ``errors`` holds the error by stream name.

    ``running`` holds the other streams' queries, which go on unless they were to be stopped.
    """

    def __init__(self, errors: Mapping[str, Exception], running: Mapping[str, StreamingQuery] | None = None):
        super().__init__("; ".join(f"{name}: {error}" for name, error in errors.items()))
        self.errors = dict(errors)
        self.running = dict(running or {})


def start_stream(df: DataFrame, sink: Sink, root: str, trigger: Mapping[str, object] = AVAILABLE_NOW) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").format(sink.fmt).options(**sink.options).trigger(**trigger)
    if sink.fmt in SHOWN:
        return writer.queryName(sink.name).start()
    writer = writer.queryName(f"{sink.name}@{root}").option("checkpointLocation", sink.checkpoint(root))
    if sink.partition_by:
        writer = writer.partitionBy(*sink.partition_by)
    return writer.start(sink.path(root))


def run_stream(df: DataFrame, sink: Sink, root: str) -> str:
    """Take what the source holds now, then stop. Returns the path written to."""
    start_stream(df, sink, root).awaitTermination()
    return sink.path(root)


def supervise(
    starters: Mapping[str, Callable[[], StreamingQuery]],
    restarts: int = 3,
    pause_s: float = PAUSE_S,
    stop_others: bool = False,
) -> None:
    """Run the streams side by side until all have ended.

    A stream that fails, or can't be started again, is started from its checkpoint up to ``restarts``
    times in a row, after a pause that doubles each time; a batch that it commits in between starts the
    count anew. The others go on meanwhile. What still fails is raised at once, as :class:`StreamsFailed`,
    while the others run on, or are stopped with ``stop_others``. If the first start of one fails, those
    started before are stopped.
    """
    running: dict[str, StreamingQuery] = {}
    try:
        for name, start in starters.items():
            running[name] = start()
    except Exception:
        _stop(running)
        raise
    failed = dict.fromkeys(starters, 0)
    waiting: dict[str, float] = {}

    def count(name: str, error: Exception) -> None:
        log.error("stream %s failed: %s", name, error)
        failed[name] += 1
        if failed[name] > restarts:
            if stop_others:
                _stop(running)
                running.clear()
            raise StreamsFailed({name: error}, running) from error
        waiting[name] = time.monotonic() + pause_s * 2 ** (failed[name] - 1)

    while running or waiting:
        for name in [name for name, at in waiting.items() if at <= time.monotonic()]:
            del waiting[name]
            try:
                running[name] = starters[name]()
            except Exception as error:  # noqa: BLE001 - whatever keeps it from starting counts as a failure
                count(name, error)
        time.sleep(POLL_S)
        for name, query in list(running.items()):
            if query.isActive:
                continue
            try:
                query.awaitTermination()  # has ended: returns, or raises, at once
                del running[name]
            except StreamingQueryException as error:
                del running[name]
                if _committed(query):
                    failed[name] = 0
                count(name, error)


def _committed(query: StreamingQuery) -> bool:
    """Whether the query has finished a batch since it was started."""
    return any(p["numInputRows"] for p in query.recentProgress)


def _stop(queries: Mapping[str, StreamingQuery]) -> None:
    for name, query in queries.items():
        try:
            query.stop()
        except Exception:  # noqa: BLE001 - the others have to be stopped all the same
            log.exception("cannot stop stream %s", name)


def fan_out(
    streams: Sequence[tuple[Sink, DataFrame]],
    root: str,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    restarts: int = 3,
    stop_others: bool = False,
) -> dict[str, str]:
    """Write each stream to its own sink, all at once. One stream may feed several sinks.

    Returns the path by sink name. With a processing-time trigger this call serves until the
    queries are stopped.
    """
    def starter(sink: Sink, df: DataFrame) -> Callable[[], StreamingQuery]:
        return lambda: start_stream(df, sink, root, trigger)

    supervise({sink.name: starter(sink, df) for sink, df in streams}, restarts, stop_others=stop_others)
    return {sink.name: sink.path(root) for sink, _ in streams}
