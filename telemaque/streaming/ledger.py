"""One read of a stream for any number of sinks.

A stream is pulled into a log of numbered runs, written once by Spark's exactly-once file sink: the source is
read and parsed once, whatever is made of its rows. Each sink is then served run by run and commits the runs
that it has, by itself. What fails, in a sink or between sinks, is taken up again at that sink's first run
without a commit; the others neither wait for it nor get anything twice.

No callback into Python runs inside a stream, so all of this works from plain jobs that a scheduler starts
every minute or every day.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from telemaque.streaming.runner import Sink, StreamsFailed, run_stream
from telemaque.workspace import get_text, listed, put_text

log = logging.getLogger(__name__)

RUN = "run"

Writer = Callable[[DataFrame, int], None]


class Ledger:
    """The log of one stream under ``root``.

    A run's number is one above the last finished run's. If a pull breaks off, the next one goes on with the
    same number; the checkpoint sees to it that the run holds each row once.
    """

    def __init__(self, root: str):
        self.root = root
        self.sink = Sink("log", partition_by=(RUN,))

    def _committed(self, spark: SparkSession, who: str) -> int:
        return max(map(int, listed(spark, f"{self.root}/_commits/{who}")), default=-1)

    def _commit(self, spark: SparkSession, who: str, run: int, text: str = "") -> None:
        put_text(spark, f"{self.root}/_commits/{who}/{run}", text)

    def finished(self, spark: SparkSession) -> int:
        """The last run that is whole, -1 if there is none."""
        return self._committed(spark, "_pulled")

    def delivered(self, spark: SparkSession, sink: str) -> int:
        """The last run that ``sink`` has, -1 if it has none."""
        return self._committed(spark, sink)

    def pull(self, stream: DataFrame) -> int:
        """Take what the source holds now, as one run. Returns its number."""
        spark = stream.sparkSession
        run = self.finished(spark) + 1
        run_stream(stream.withColumn(RUN, F.lit(run)), self.sink, self.root)
        self._commit(spark, "_pulled", run, stream.schema.json())
        return run

    def rows(self, spark: SparkSession, run: int) -> DataFrame:
        """The rows of a finished run."""
        schema = StructType.fromJson(json.loads(get_text(spark, f"{self.root}/_commits/_pulled/{run}")))
        path = self.sink.path(self.root)
        if not any(name.startswith(f"{RUN}=") for name in listed(spark, path)):
            return spark.createDataFrame([], schema)
        log_schema = StructType([*schema.fields]).add(RUN, "integer")
        return spark.read.schema(log_schema).parquet(path).where(F.col(RUN) == run).drop(RUN)

    def deliver(self, spark: SparkSession, sinks: Mapping[str, Writer]) -> None:
        """Serve each of ``sinks`` with the finished runs that it lacks, in order.

        A writer must replace what an earlier attempt at the same run has left, as
        :func:`telemaque.streaming.batches.batch_writer` and :class:`telemaque.sinks.keyed.KeyedTable` do.
        A sink that fails keeps its place; the others are served, then the errors are raised together.
        """
        errors: dict[str, Exception] = {}
        last = self.finished(spark)
        for name, write in sinks.items():
            try:
                for run in range(self.delivered(spark, name) + 1, last + 1):
                    write(self.rows(spark, run), run)
                    self._commit(spark, name, run)
            except Exception as error:  # noqa: BLE001 - whatever a sink raises must not keep the others from their rows
                log.exception("sink %s failed", name)
                errors[name] = error
        if errors:
            raise StreamsFailed(errors)
