"""Packing token sequences by minimum bin slack (operator 7).

Documents become token ids in the tasks; only a longer one than a sequence is cut. What has to be
packed is then known from the number of pieces of each length, and these are as many numbers as a
sequence has places, whatever the table. For one sequence after the other, a subset-sum program
over a bit set finds the fullest combination of the lengths still there, beside the longest of them;
the combination is repeated as often as its lengths last, and removed. The plan has at most as many
combinations as lengths, since each uses up one. The pieces then take their places in it by their
rank among the pieces of their length, counted in two levels: rows per task and length, then rows.

Defined results: a null text counts as empty (the end id alone); ids may repeat, and each row is
packed on its own; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemaque.llm.vocabulary import byte_encoder
from telemaque.workspace import fresh_dir

MAX_TOKENS = 2048
END_ID = 0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all of ``size`` but the first, if shorter."""
    first = n - (n - 1) // size * size
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def pieces(docs: DataFrame, vocabulary: str, size: int = MAX_TOKENS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece: its place in its document's ids, its length and the checksum of its ids."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(vocabulary)
        for batch in batches:
            rows: list[tuple] = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.asarray([*encode(value.as_py() or ""), END_ID], dtype="<u4")
                rows += [
                    (key, i, s, n, zlib.crc32(ids[s : s + n])) for i, (s, n) in enumerate(cuts(len(ids), size))
                ]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(tokenize, PIECES)


def fullest(counts: np.ndarray, size: int) -> dict[int, int]:
    """The fullest combination of at most ``size`` with the longest length in it; ``counts`` by length.

    Lengths are added from the longest down, each as binary multiples, to the set of sums that can be
    reached (bit s: sum s), until ``size`` itself is.
    """
    longest = int(np.flatnonzero(counts)[-1])
    room = size - longest
    reach, steps, full = 1, [], (1 << (room + 1)) - 1
    lengths = np.flatnonzero(counts[: room + 1])[::-1]
    for length in map(int, lengths):
        left = min(int(counts[length]) - (length == longest), room // length)
        times = 1
        while left > 0 and not reach >> room & 1:
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & full
            left -= times
            times *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    out = {longest: 1}
    for length, times, before in reversed(steps):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + times
            at -= length * times
    return out


def plan(counts: np.ndarray, size: int = MAX_TOKENS) -> list[tuple[int, dict[int, int]]]:
    """(times, combination) until all of ``counts`` (pieces by length) is packed."""
    left, out = counts.astype(np.int64).copy(), []
    while left.any():
        combination = fullest(left, size)
        times = min(int(left[length]) // n for length, n in combination.items())
        for length, n in combination.items():
            left[length] -= n * times
        out.append((times, combination))
    return out


def slots(planned: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, pieces, pieces per sequence, first sequence, offset of the first) rows."""
    out, used, sequence = [], {}, 0
    for times, combination in planned:
        offset = 0
        for length, n in combination.items():
            rank = used.get(length, 0)
            out.append((length, rank, n * times, n, sequence, offset))
            used[length] = rank + n * times
            offset += n * length
        sequence += times
    return out


def packed(cut: DataFrame, size: int = MAX_TOKENS) -> DataFrame:
    """``cut`` (a table with ``length``) with the ``sequence_id`` and ``offset`` of each row.

    ``length`` must be 1 to ``size``. At most ``size`` counts come to the driver, and the plan that
    goes back has at most one combination per length (see ``slots``), whatever the table.
    """
    spark = cut.sparkSession
    folder = fresh_dir(spark, "pieces")
    numbered = cut.withColumn("__task", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id())
    numbered.write.parquet(folder)
    stored = spark.read.schema(numbered.schema).parquet(folder)
    per_task = stored.groupBy("length", "__task").agg(F.count("*").alias("__n"))
    found = per_task.groupBy("length").agg(F.sum("__n")).collect()  # at most ``size`` rows
    counts = np.zeros(size + 1, dtype=np.int64)
    for length, n in found:
        counts[length] = n
    places = spark.createDataFrame(
        slots(plan(counts, size)), "length long, first_rank long, n long, each long, first_sequence long, first_offset long"
    )
    before = per_task.withColumn(
        "__before", F.sum("__n").over(Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    ).select("length", "__task", F.coalesce("__before", F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("length", "__task").orderBy("__row")) - 1
    ranked = stored.withColumn("__within", within).join(before, ["length", "__task"]).withColumn("__rank", F.col("__before") + F.col("__within"))
    # One table of at most ``size`` combinations, by length: bounded, so it may be sent to every task.
    by_length = places.groupBy("length").agg(F.collect_list(F.struct("first_rank", "n", "each", "first_sequence", "first_offset")).alias("__places"))
    joined = ranked.join(F.broadcast(by_length), "length").withColumn(
        "__place",
        F.element_at(F.filter("__places", lambda p: (F.col("__rank") >= p.first_rank) & (F.col("__rank") < p.first_rank + p.n)), 1),
    )
    nth = F.col("__rank") - F.col("__place.first_rank")
    return joined.select(
        *cut.columns,
        (F.col("__place.first_sequence") + F.floor(nth / F.col("__place.each"))).cast("long").alias("sequence_id"),
        (F.col("__place.first_offset") + F.col("length") * F.pmod(nth, F.col("__place.each"))).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, size: int = MAX_TOKENS) -> DataFrame:
    """Documents to packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packed(pieces(docs, vocabulary, size), size)
