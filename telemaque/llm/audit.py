"""How filters act on each other, whatever their order (operator 11).

Five filters can be put in 120 orders of five steps. What becomes of a document in all of them follows from
the set of filters that it fails, its mask. So each of the 32 masks is mapped to one big integer with a field
for each of the 600 steps, which is 1 where that step removes a document with this mask. The integers of a
part's documents are simply added up: the sum's fields are the numbers of documents that each step removes.
A second and a third sum take only the documents labelled as good and as toxic. Fields are ``WIDTH`` bits
wide and a field grows by one at most with each document, so no field runs over into the next.

A task adds up the documents that it reads, for each part, and passes on a sum for each part; sums of sums
are made in two steps, so a part that a third of all documents belong to is spread over many tasks. What is
still there after a step, and what fails but was removed before, follow from the fields of a part's sums.

Whether a text is identical to that of a smaller id is settled on digests of texts: the smallest id of each
digest that several rows share is joined back to the rows.

Defined results: a null text counts as empty, a null source as the empty text. Rows of one id are documents
each; rows of one id and one text are not copies of a smaller id. A row without an id comes after all
ids. A document is good, or toxic, if any row of labels says so of its id. An empty table has no parts.
Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemaque.llm import buffers as B
from telemaque.llm.linking import stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)
MASKS = 1 << len(FILTERS)
#: Bits of a field: sums are right below 2**63 documents.
WIDTH = 64

# Thresholds of the contract.
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5
_MARK = np.zeros(256, dtype=bool)
_MARK[[*b"#$%&*|"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True

#: Parts that a task holds sums of at a time, and tasks that share the sums of one part in the first step.
HELD, SALTS = 512, 16

COPY = 1 << FILTERS.index("E")
ROWS = "doc_id long, part string, digest binary, mask int"
SUMS = "part string, counts binary, removed binary, good binary, toxic binary"
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def wide(mask: int) -> int:
    """The outcomes of a document in all steps: field 5 * order + step is 1 where that step removes it."""
    out = 0
    for i, order in enumerate(ORDERS):
        first = next((k for k, f in enumerate(order) if mask >> FILTERS.index(f) & 1), None)
        if first is not None:
            out |= 1 << WIDTH * (len(FILTERS) * i + first)
    return out


WIDE = [wide(mask) for mask in range(MASKS)]
#: The same way, a field for each mask: how many documents have it.
ONE = [1 << WIDTH * mask for mask in range(MASKS)]


def fields(total: bytes) -> np.ndarray:
    return np.frombuffer(total, dtype="<i8")


def text_masks(column: pa.Array) -> np.ndarray:
    """The filters A to D that each text fails, as bits."""
    out = np.zeros(len(column), dtype=np.int32)
    for row, stop, data, at in B.text_chunks(column):
        n = stop - row
        start, end, before = B.words(data, at)
        n_words = np.diff(before)
        doc = np.repeat(np.arange(n), n_words)
        word = B.spans(B.running(data), start, end) + B.mix(doc.astype(np.uint64) * B.GOLDEN + B.GOLDEN)
        distinct = np.bincount(doc[np.unique(word, return_index=True)[1]], minlength=n)

        def within(member: np.ndarray, at: np.ndarray = at) -> np.ndarray:
            total = np.zeros(len(member) + 1, dtype=np.int64)
            np.cumsum(member, out=total[1:])
            return np.diff(total[at])

        fails = (
            n_words < MIN_WORDS,
            100 * distinct < DISTINCT_PERCENT * n_words,
            100 * within(_UPPER[data]) > UPPER_PERCENT * within((data & 0xC0) != 0x80),
            within(_MARK[data]) > 0,
        )
        out[row:stop] = sum(fail.astype(np.int32) << i for i, fail in enumerate(fails))
    return out


def masked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """doc_id, part, mask (all five filters) of each row of ``docs``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = pa.array(text_masks(batch.column(3)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], mask], names=["doc_id", "part", "digest", "mask"])

    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    plain = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"), whole.alias("text"),
    )
    rows = stored(plain.mapInArrow(judge, ROWS), "masks")
    # The smallest id of what is there more than once; null where no row of it has an id.
    shared = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1 and first is not null")
    shared = stored(shared.select("digest", "first"), "shared")
    later = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")))
    mask = F.when(later, F.col("mask").bitwiseOR(COPY)).otherwise(F.col("mask"))
    return rows.join(shared, "digest", "left").select("doc_id", "part", mask.alias("mask"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic`` by the labels of their ids."""
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    said = said.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = rows.join(stored(said, "labels"), "doc_id", "left")
    return joined.select("part", "mask", *[(F.coalesce(c, F.lit(0)) > 0).alias(c) for c in ("good", "toxic")])


def _packed(part: str, sums: list[int]) -> tuple:
    sizes = (MASKS, STEPS, STEPS, STEPS)
    return (part, *[total.to_bytes(n * WIDTH // 8, "little") for total, n in zip(sums, sizes, strict=True)])


def _record(rows: list[tuple]) -> pa.RecordBatch:
    part, *sums = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *[pa.array(s, pa.binary()) for s in sums]], names=["part", "counts", "removed", "good", "toxic"])


def summed(rows: DataFrame) -> DataFrame:
    """A row of ``SUMS`` for each part: big integers, as little-endian bytes. ``rows``: part, mask, good, toxic."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            mask, good, toxic = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[1:])
            code = ((names.indices.to_numpy().astype(np.int64) * MASKS + mask) * 2 + good) * 2 + toxic
            for kind, n in zip(*(x.tolist() for x in np.unique(code, return_counts=True)), strict=True):
                name, mask_, good_, toxic_ = kind >> 2 + len(FILTERS), kind >> 2 & MASKS - 1, kind >> 1 & 1, kind & 1
                sums = held[names.dictionary[name].as_py()]
                sums[0] += n * ONE[mask_]
                sums[1] += n * WIDE[mask_]
                sums[2] += n * WIDE[mask_] * good_
                sums[3] += n * WIDE[mask_] * toxic_
            if len(held) >= HELD:
                yield _record([_packed(*item) for item in held.items()])
                held.clear()
        if held:
            yield _record([_packed(*item) for item in held.items()])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of runs of one part."""
        at, sums = None, [0, 0, 0, 0]
        for batch in batches:
            for part, *parts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if part != at and at is not None:
                    yield _record([_packed(at, sums)])
                    sums = [0, 0, 0, 0]
                at = part
                sums = [s + int.from_bytes(p, "little") for s, p in zip(sums, parts, strict=True)]
        if at is not None:
            yield _record([_packed(at, sums)])

    out = rows.select("part", "mask", "good", "toxic").mapInArrow(add, SUMS)
    salted = out.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))).repartition("part", "salt")
    some = salted.sortWithinPartitions("part").drop("salt").mapInArrow(again, SUMS)
    return some.repartition("part").sortWithinPartitions("part").mapInArrow(again, SUMS)


def unpacked(sums: DataFrame) -> DataFrame:
    """The rows of ``RESULT`` of each part's sums."""
    letter = np.array([FILTERS.index(f) for order in ORDERS for f in order])
    step = np.tile(np.arange(1, len(FILTERS) + 1), len(ORDERS))
    names = [o for o in ORDERS for _ in FILTERS]
    fails = np.array([[mask >> i & 1 for i in range(len(FILTERS))] for mask in range(MASKS)])
    alone = 1 << np.arange(len(FILTERS))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, *totals in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                counts, removed, good, toxic = map(fields, totals)
                gone = removed.reshape(len(ORDERS), len(FILTERS)).cumsum(axis=1).reshape(-1)
                failing = counts @ fails
                shapley = np.zeros(len(FILTERS), dtype=np.int64)
                np.add.at(shapley, letter, removed)
                columns = [
                    counts.sum() - gone, removed, failing[letter] - removed, counts[alone][letter], good, toxic, shapley[letter],
                ]
                arrays = [pa.array([part] * STEPS), pa.array(names), pa.array(step.astype(np.int32)), *[pa.array(c) for c in columns]]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in RESULT.split(", ")])

    return sums.mapInArrow(unpack, RESULT)


def interactions(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """A row of ``RESULT`` for each part of ``docs``, order of the filters, and step."""
    return unpacked(summed(labelled(masked(docs, doc_id, text, part), labels)))
