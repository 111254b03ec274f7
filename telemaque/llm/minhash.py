"""Near duplicates by fast similarity sketching (operator 8).

A text's distinct word shingles are thrown into the coordinates of its sketch in rounds: in each, every
shingle is hashed to one coordinate, which keeps the smallest value of the earliest round that reached
it. A set of many shingles fills all coordinates in one or a few rounds; after as many rounds as there
are coordinates, round i puts all shingles into coordinate i, so every coordinate is filled for sure.
Coordinates of two sketches agree with the sets' similarity as probability, as concentrated as with
independent hashes. Bands of coordinates make buckets, and links are confirmed on the full sets.

A large bucket may hold many sets that are alike but not linked, and pairs of them grow with the square of their
number. There the sets themselves say which pairs are left: with the shingles in one order, the rarest first,
two linked sets have one in common among the first of both, ``prefix`` in number, since all others are too few.
Where shingles that tell them apart are rare, hardly a pair that isn't linked is left. Before a pair becomes a
row there or among the pivots, it must also meet an exact bound: two sets differ in at least as many shingles as the
parities of their hashed places do.

Texts of one shingle set are one class from the start, so copies cost a row each. At a similarity of
0.8, 73 bands of 7 miss a link with probability (1 - 0.8 ** 7) ** 73 = 3e-8. Fewer rows per band would
find as much with fewer bands, but put many texts that share just a passage into one bucket.

Defined results: a null text counts as empty; texts without words have no shingles and are linked with
nothing; a text of fewer words than a shingle is one shingle; ids are whole numbers, repeated ids with
equal text are one class, and a row comes back for each row; other columns are ignored here. A row without an id is
linked with rows of its own shingle set only: its component is the smallest id that these lead to, and where
none of them has an id, null, and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemaque.llm import buffers as B
from telemaque.llm.linking import classes, passing, sent, stored

SHINGLE, SIMILARITY = 5, 80  # words; hundredths
SKETCH, BANDS, ROWS = 512, 73, 7
_VALUE = np.uint64((1 << 54) - 1)

#: Lowest bits of as many coordinates, in words: a similarity s makes (1 + s) / 2 of them agree.
BITS = 256
#: Shingles are dealt to as many places by a hash, each of which keeps whether it has an odd number of them. Two sets differ
#: in at least as many shingles as such places differ.
PARITIES = 512
#: Standard deviations below what a linked pair has on average that a candidate may have.
SLACK = 8

SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, bits array<long>"


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, offsets by row): the sorted distinct shingles of runs of texts."""
    for row, stop, data, at in B.text_chunks(column):
        start, end, before = B.words(data, at)
        word = B.spans(B.running(data, fold=True), start, end)
        full = B.sequences(word, n)
        sets = []
        for lo, hi in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            if hi - lo >= n:
                sets.append(np.unique(full[lo : hi - n + 1]))
            elif hi > lo:  # a domain of its own for each length, apart from full shingles
                sets.append(B.mix(B.sequences(word[lo:hi], hi - lo) + B.GOLDEN * np.uint64(hi - lo)))
            else:
                sets.append(word[:0])
        yield row, np.concatenate(sets) if stop > row else word[:0], np.cumsum([0, *map(len, sets)])


def sketches(hashes: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """A sketch of ``size`` coordinates for each set; all are filled but those of empty sets.

    ``size``: a power of two, 512 at most. A coordinate holds its round in the top bits, then the value.
    """
    n, unfilled = len(offsets) - 1, np.uint64(2**64 - 1)
    out = np.full((n, size), unfilled, dtype=np.uint64)
    flat = out.reshape(-1)
    bits = np.uint64(size.bit_length() - 1)
    seeds = B.seeded(2 * size, 7)
    left = np.flatnonzero(np.diff(offsets) > 0)
    held, owner = hashes, np.repeat(np.arange(n), np.diff(offsets))
    for i in range(2 * size):
        if not len(left):
            break
        value = B.mix(held ^ seeds[i])
        place = value >> (np.uint64(64) - bits) if i < size else np.uint64(i - size)
        np.minimum.at(flat, owner * size + place.astype(np.int64), np.uint64(i) << np.uint64(54) | (value & _VALUE))
        open_ = (out[left] == unfilled).any(axis=1)
        if not open_.all():
            left = left[open_]
            on = np.zeros(n, dtype=bool)
            on[left] = True
            keep = on[owner]
            held, owner = held[keep], owner[keep]
    return out


def parities(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``PARITIES`` bits for each set, as a row of longs."""
    n = len(offsets) - 1
    place = (B.mix(hashes ^ B.seeded(1, 13)[0]) >> np.uint64(64 - (PARITIES.bit_length() - 1))).astype(np.int64)
    odd = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * PARITIES + place, minlength=n * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, PARITIES), axis=1).view(np.int64)


def banded(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A bucket key for each sketch and band."""
    parts = sketch[:, : bands * rows].reshape(len(sketch), bands, rows)
    key = np.broadcast_to(B.seeded(bands, 9), parts.shape[:2]).copy()
    for i in range(rows):
        key = B.mix(key * B.GOLDEN + parts[:, :, i])
    return key


def signatures(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """doc_id, size and identity of the shingle set, and its bucket keys. ``docs``: doc_id, text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, hashes, offsets in shingle_sets(batch.column(1), shingle):
                size = np.diff(offsets)
                sketch = sketches(hashes, offsets, SKETCH)
                keys = banded(sketch, bands, rows)
                low = np.packbits((sketch[:, :BITS] & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)
                filled = size > 0
                sums = [np.zeros(len(size), dtype=np.uint64) for _ in range(2)]
                if len(hashes):
                    for out, seed in zip(sums, B.seeded(2, 11), strict=True):
                        out[filled] = np.add.reduceat(B.mix(hashes ^ seed), offsets[:-1][filled])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(np.where(filled, bands, 0))).astype(np.int32)), pa.array(keys[filled].reshape(-1).view(np.int64))
                )
                odd = parities(hashes, offsets)
                low = np.concatenate([low.reshape(len(size), -1), odd], axis=1)
                words = low.shape[1]
                bits = pa.ListArray.from_arrays(pa.array(np.arange(0, len(size) * words + 1, words, dtype=np.int32)), pa.array(low.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(size)), pa.array(size), *[pa.array(s.view(np.int64)) for s in sums], lists, bits],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "bits"],
                )

    return docs.mapInArrow(sign, SIGNED)


def close_enough(similarity: int):
    """A condition on sizes and on the ``bits`` of two sets that a linked pair meets but with probability 1.5e-12.

    That is the binomial tail below the limit on sketch bits at the default similarity of 0.8: 191 of 256 bits or fewer
    agree. The conditions on sizes and on parities are exact: of all shingles of a linked pair, counted in each set, at
    most (1 - s) / (1 + s) are in one set only.
    """
    share = (1 + similarity / 100) / 2
    least = BITS * share - SLACK * (BITS * share * (1 - share)) ** 0.5
    split = BITS // 64

    def close(a: str, b: str) -> Column:
        def differ(start: int, stop: int) -> Column:
            bits = [F.bit_count(F.get(f"{a}bits", F.lit(i)).bitwiseXOR(F.get(f"{b}bits", F.lit(i)))) for i in range(start, stop)]
            return reduce(Column.__add__, bits)

        one, other = F.col(f"{a}size"), F.col(f"{b}size")
        sizes = 100 * F.least(one, other) >= similarity * F.greatest(one, other)
        odd = (100 + similarity) * differ(split, split + PARITIES // 64) <= (100 - similarity) * (one + other)
        return sizes & odd & (differ(0, split) <= BITS - least)

    return close


def prefix(size: Column, share: int, whole: int) -> Column:
    """Of ``size`` shingles, how many may come before the first that is shared, and one, if ``share`` of ``whole`` are."""
    return size - F.floor((size * share + whole - 1) / whole).cast("long") + 1


def prefix_pairs(sets: DataFrame, similarity: int, close):
    """The pairs of sets that can still be links, by their rarest shingles; for ``linking.classes``.

    Of a linked pair the smaller set has at least 2s / (1 + s) of its shingles in common with the other, and the
    larger one at least s of its own.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                one = np.frombuffer(x.as_buffer(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(one), i)), pa.array(one)], names=["id", "shingle"])

    def rest(left: DataFrame) -> DataFrame:
        shingles = sets.join(left.select("id"), "id", "left_semi").select("id", "set").mapInArrow(spread, "id long, shingle long")
        times = stored(shingles.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1"), "times")
        held = shingles.join(times, "shingle").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("held"))
        held = held.join(left, "id")
        # The shingles that no other set has come first of all, and meet nothing.
        alone = F.col("size") - F.size("held")
        probed = F.greatest(prefix(F.col("size"), similarity, 100) - alone, F.lit(0)).cast("int")
        indexed = prefix(F.col("size"), 2 * similarity, 100 + similarity) - alone
        some = held.where(probed > 0).withColumns({"first": F.slice("held", F.lit(1), probed), "indexed": indexed, "alone": alone}).drop("held")
        rows = some.select("*", F.posexplode("first").alias("place", "found")).withColumn("shingle", F.col("found.shingle"))
        columns = [*left.columns, "place", "after"]
        rows = rows.withColumn("after", F.col("size") - F.col("alone") - F.col("place") - 1)
        rows = stored(rows.select("shingle", *columns, (F.col("place") < F.col("indexed")).alias("indexed")), "prefixes")
        small = rows.where("indexed").drop("indexed")
        small, large = (df.select("shingle", *[F.col(c).alias(f"{side}_{c}") for c in columns]) for df, side in ((small, "a"), (rows.drop("indexed"), "b")))
        # Shared are at most the shingles before this one, itself and those after it.
        most = F.least("a_place", "b_place") + F.least("a_after", "b_after") + 1
        enough = (100 + similarity) * most >= similarity * (F.col("a_size") + F.col("b_size"))
        order = (F.col("a_size") < F.col("b_size")) | ((F.col("a_size") == F.col("b_size")) & (F.col("a_id") < F.col("b_id")))
        apart = order & (F.col("a_class_id") != F.col("b_class_id")) & enough & close("a_", "b_")
        pairs = small.join(large, (small["shingle"] == large["shingle"]) & apart)
        return pairs.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))

    return rest


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(id, set) of the documents in ``wanted`` (doc_id): the sorted shingles as bytes; stored."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, hashes, offsets in shingle_sets(batch.column(1), shingle):
                sets = [hashes[lo:hi].tobytes() for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)), pa.array(sets, pa.binary())], names=["id", "set"])

    some = docs.join(sent(wanted), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(emit, "id long, set binary")
    return stored(some.where(F.length("set") > 0), "sets")


def verifier(sets: DataFrame, similarity: int):
    """The check of candidate pairs on full sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, other = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(one, other, assume_unique=True))
                kept.append(100 * both >= similarity * (len(one) + len(other) - both))
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a")
        return both.select("a", "b", "set_a", "set_b").mapInArrow(check, "a long, b long").distinct()

    return verify


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    signed = stored(signatures(plain, shingle, bands, rows), "signatures")
    by_set = ["set_a", "set_b", "n_shingles"]
    with passing(docs.sparkSession):
        filled = signed.where("n_shingles > 0")
        # One document for each different set goes on.
        heads = stored(filled.groupBy(*by_set).agg(F.min("doc_id").alias("head"), F.min("bands").alias("bands"), F.min("bits").alias("bits")), "heads")
        rows_ = heads.select(F.explode("bands").alias("bucket"), F.col("head").alias("id"))
        shared = rows_.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        members = rows_.join(stored(shared, "buckets"), "bucket").distinct().withColumn("pivot", F.lit(True))
        members = stored(members, "shared")
        labels = None
        if not members.isEmpty():
            # Who shares most buckets is in the middle of its group: near copies are linked through it.
            wanted = stored(members.groupBy("id").agg(F.sum("n").alias("degree")), "wanted")
            bits = heads.select(F.col("head").alias("id"), "bits", F.col("n_shingles").alias("size")).join(wanted, "id").dropDuplicates(["id"])
            bits = stored(bits, "about")
            sets = full_sets(plain, wanted.select(F.col("id").alias("doc_id")), shingle)
            close = close_enough(similarity)
            labels = classes(members.drop("n"), bits, verifier(sets, similarity), close, prefix_pairs(sets, similarity, close))
        of_head = heads.select(*by_set, "head")
        if labels is not None:
            of_head = of_head.join(labels, F.col("head") == F.col("id"), "left").select(*by_set, F.coalesce("class_id", "head").alias("head"))
        of_head = stored(of_head, "classes", keep=True)
    return _labelled(signed, of_head, by_set)


def _labelled(signed: DataFrame, of_head: DataFrame, by_set: list[str]) -> DataFrame:
    out = signed.select("doc_id", *by_set).join(of_head, by_set, "left")
    component: Column = F.coalesce("head", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
