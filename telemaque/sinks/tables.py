"""Append to files, tables and topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemaque.functions.text import ISO_MICROS, JSON_TIMES

#: CSV is written and read with the same options. Texts start with a mark (see :func:`append_csv`), so blanks, the
#: empty text and NULL stay apart.
CSV = {
    "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": ISO_MICROS, "timestampNTZFormat": ISO_MICROS, "header": "true",
}
_MARK = "~"


def append_sink(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    table: bool = False,
    **options: str,
) -> None:
    """Append to the path ``target``, or with ``table`` to the catalog table of that name.

    ``fmt`` is any batch format the session knows; errors are raised. Text formats keep
    microseconds.
    """
    defaults = JSON_TIMES if fmt in ("json", "csv") else {}
    if partition_by and not df.isStreaming:
        # Rows of one partition value come together, in as many tasks as their size needs: else every
        # task opens a file for every value.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("append").format(fmt).options(**{**defaults, **options})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(target) if table else writer.save(target)


def publish(messages: DataFrame, topic: str, servers: str | None = None, replay: str | None = None) -> None:
    """Send messages to a Kafka topic, or append them to its replay folder."""
    if (servers is None) == (replay is None):
        raise ValueError("give either servers or replay")
    if servers is None:
        append_sink(messages, f"{replay}/{topic}")
    else:
        kafka = {"kafka.bootstrap.servers": servers, "topic": topic}
        messages.select("key", "value").write.format("kafka").options(**kafka).save()


def _texts(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def append_csv(df: DataFrame, target: str) -> None:
    """Append as CSV that :func:`read_csv` reads back without loss.

    Texts get a mark in front, so that empty ones and NULLs differ; backslashes and line breaks inside
    are written as ``\\\\``, ``\\n`` and ``\\r``, so a row is a line and files can be split.
    """

    def escaped(name: str):
        plain = F.col(f"`{name}`")
        for raw, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
            plain = F.replace(plain, F.lit(raw), F.lit(shown))
        return F.concat(F.lit(_MARK), plain)

    append_sink(df.withColumns({name: escaped(name) for name in _texts(df.schema)}), target, "csv", **CSV)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What :func:`append_csv` has written with that schema."""

    def plain(name: str):
        text = F.substring(F.col(f"`{name}`"), F.lit(len(_MARK) + 1), F.length(F.col(f"`{name}`")))
        # An even run of backslashes stands for half of it; an odd one ends in an escape.
        pieces = F.split(text, r"\\\\", -1)
        return F.array_join(F.transform(pieces, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))), "\\")

    read = spark.read.schema(schema).options(**CSV).csv(path)
    return read.withColumns({name: plain(name) for name in _texts(schema)})
