"""Compression of vectors to a few bytes each, with nearest entries found in GNATs (operator 12).

Components become whole numbers, vectors are cut into consecutive parts, and each part position gets a
codebook by a few rounds of assignment and averaging, all in exact integer arithmetic. A vector's code is the
number of the nearest entry for each of its parts; of entries equally near, the first.

The nearest entry is found in a geometric near-neighbour access tree over the codebook's entries. A node
has a few split points, every other entry of the node belongs to the child of the split point nearest to
it, and for each split point and child the node keeps the range of distances between them. If a query is
d from a split point, and its best entry so far is r away, a child whose range lies outside of [d - r, d + r]
can hold nothing better, and its whole subtree is passed over. Bounds are strict, since an entry that is just as far
may come first, and compared with a margin above all rounding errors of the roots. What decides in the
end are exact integer distances, ties by the entry's number. Queries go through the tree in batches, those
of one nearest split point together, that child first.

A round reads the vectors once; each task adds up the parts of each entry and Spark adds up the tasks'
sums. Codebooks hold ``ENTRIES`` vectors at most, whatever the table: they travel with the tasks.

Defined results: a row without a vector, or with a null, infinite or undefined component, is dropped. Vectors
shorter than the longest, or whose length is no multiple of the parts, are filled up with zeros. Rows of
one id are vectors each; the first entries are the rows of the smallest ids, of one id the smaller vector first, rows
without an id last. With fewer rows than entries the codebook is as short; an empty table has no rows.
Components beyond 2**52 count as 2**52, and sums of errors end at the largest long. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemaque.llm.linking import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Split points of a node, and the most entries of a node that is not split.
SPLITS, LEAF = 8, 12
#: Far above the relative error of a few operations on roots.
MARGIN = 2.0**-48
LARGEST = float(1 << 52)
LONG_MAX = (1 << 63) - 1


def squares(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``q`` from those of ``e``: int64, or Python's integers where these may not do."""
    top = max((int(np.abs(x).max()) for x in (q, e) if x.size), default=0)
    bound = 4 * top * top * max(1, q.shape[1])
    if bound < 1 << 52:  # all sums and products are whole numbers that doubles hold
        q, e = q.astype(np.float64), e.astype(np.float64)
        return ((q * q).sum(1)[:, None] + (e * e).sum(1) - 2 * (q @ e.T)).astype(np.int64)
    kind = np.int64 if bound < 1 << 54 else object
    q, e = q.astype(kind), e.astype(kind)
    return np.stack([((q - row) ** 2).sum(axis=1) for row in e], axis=1) if len(e) else np.zeros((len(q), 0), dtype=kind)


def roots(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64))


@dataclass
class Node:
    """``low[i, j]`` and ``high[i, j]``: the least and greatest distance of split point i from child j's entries."""

    entries: np.ndarray  # the split points, or all entries of a node that is not split
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    children: tuple[Node | None, ...] = ()


def grown(entries: np.ndarray, apart: np.ndarray) -> Node:
    """The tree over ``entries`` (numbers, ascending); ``apart``: squared distances of all entries."""
    if len(entries) <= LEAF:
        return Node(entries)
    splits = [int(entries[0])]
    nearest = apart[entries, splits[0]]
    while len(splits) < SPLITS:  # the next is the one farthest from those so far
        far = np.where(np.isin(entries, splits), -1, nearest)
        splits.append(int(entries[int(np.argmax(far))]))
        nearest = np.minimum(nearest, apart[entries, splits[-1]])
    own = entries[~np.isin(entries, splits)]
    child_of = np.argmin(apart[np.ix_(own, splits)], axis=1)
    low, high = (np.zeros((SPLITS, SPLITS)) for _ in range(2))
    children: list[Node | None] = []
    for j in range(SPLITS):
        members = own[child_of == j]
        if len(members):
            distance = roots(apart[np.ix_(splits, members)])
            low[:, j], high[:, j] = distance.min(axis=1), distance.max(axis=1)
        children.append(grown(members, apart) if len(members) else None)
    return Node(np.array(splits), low, high, tuple(children))


class Tree:
    """A codebook's entries and the tree over them."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = grown(np.arange(len(entries)), squares(entries, entries)) if len(entries) else None

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of the nearest entry for each query, and how many distances that took."""
        # Distance and number in one integer: its minimum settles ties.
        top = max((int(np.abs(x).max()) for x in (queries, self.entries) if x.size), default=0)
        small = 4 * top * top * max(1, queries.shape[1]) < 1 << 54
        best = np.full(len(queries), LONG_MAX if small else 1 << 200, dtype=np.int64 if small else object)
        taken = 0

        def hold(rows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
            nonlocal taken
            d = squares(queries[rows], self.entries[numbers]).astype(best.dtype)
            taken += d.size
            best[rows] = np.minimum(best[rows], (d * ENTRIES + numbers.astype(best.dtype)).min(axis=1))
            return d

        def visit(node: Node, rows: np.ndarray) -> None:
            d = hold(rows, node.entries)
            if not node.children:
                return
            far, first = roots(d), np.argmin(d, axis=1)
            for own in (True, False):
                for j, child in enumerate(node.children):
                    if child is None:
                        continue
                    which = np.flatnonzero((first == j) == own)
                    r = roots(best[rows[which]] // ENTRIES)[:, None]
                    some, low, high = far[which], node.low[:, j], node.high[:, j]
                    outside = (some - r - high > MARGIN * (some + r + high)) | (low - some - r > MARGIN * (some + r + low))
                    which = which[~outside.any(axis=1)]
                    if len(which):
                        visit(child, rows[which])

        if self.root is not None and len(queries):
            visit(self.root, np.arange(len(queries)))
        return (best % ENTRIES).astype(np.int64), best // ENTRIES, taken


@dataclass
class Codebooks:
    """Trees over the entries of each part position; ``width`` components a part."""

    trees: list[Tree]
    width: int

    @property
    def digest(self) -> str:
        numbers = (str(int(x)) for tree in self.trees for x in tree.entries.reshape(-1))
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, n (components), vec (whole numbers) of the rows whose vector is sound."""
    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("label", vectors.schema[label].dataType), T.StructField("n", T.LongType()), T.StructField("vec", T.ArrayType(T.LongType()))]
    )

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sound = lists.is_valid().to_numpy(zero_copy_only=False)
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null is no number either
            row = np.repeat(np.arange(len(size)), size)
            sound = sound & (np.bincount(row[~np.isfinite(values)], minlength=len(size)) == 0)
            whole = np.floor(np.clip(values[sound[row]], -LARGEST, LARGEST) * SCALE).astype(np.int64)
            size = size[sound]
            mask = pa.array(sound)
            at = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
            arrays = [batch.column(0).filter(mask), batch.column(1).filter(mask), pa.array(size), pa.ListArray.from_arrays(at, pa.array(whole))]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "n", "vec"])

    plain = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vec")
    )
    return plain.mapInArrow(convert, schema)


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """A row of ``width`` components for each list, zeros where it is shorter."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (size == width).all():
        return values.reshape(len(size), width)
    out = np.zeros((len(size), width), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def trained(rows: DataFrame, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks for ``rows`` (vec_id, n, vec). What comes to the driver are sums by entry and place."""
    width = -(-(rows.agg(F.max("n")).first()[0] or 0) // PARTS)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(ENTRIES).select("vec").collect()
    start = np.zeros((len(first), PARTS * width), dtype=np.int64)
    for i, r in enumerate(first):
        start[i, : len(r.vec)] = r.vec
    books = Codebooks([Tree(start[:, p * width : (p + 1) * width]) for p in range(PARTS)], width)
    for _ in range(rounds):
        entries = [tree.entries.astype(object) for tree in books.trees]
        for r in entry_sums(rows, books).collect():
            entries[r.part][r.entry, r.place] = int(r.total) // r.n  # Python's division goes down
        books = Codebooks([Tree(e.astype(np.int64)) for e in entries], width)
    return books


def entry_sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """part, entry, place, total, n: the sums of the parts that are nearest to each entry. At most a number per codebook component."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(t.entries), books.width), dtype=object) for t in books.trees]
        counts = [np.zeros(len(t.entries), dtype=np.int64) for t in books.trees]
        for batch in batches:
            vectors = _matrix(batch.column(0), PARTS * books.width)
            for p, tree in enumerate(books.trees):
                mine = vectors[:, p * books.width : (p + 1) * books.width]
                entry = tree.nearest(mine)[0]
                counts[p] += np.bincount(entry, minlength=len(counts[p]))
                order = np.argsort(entry, kind="stable")
                at = np.flatnonzero(np.diff(entry[order], prepend=-1))
                small = len(mine) and int(np.abs(mine).max(initial=0)) < (1 << 62) // len(mine)
                if len(at):
                    totals[p][entry[order][at]] += np.add.reduceat(mine[order].astype(np.int64 if small else object), at, axis=0)
        for p, (total, n) in enumerate(zip(totals, counts, strict=True)):
            entry, place = np.divmod(np.arange(total.size), max(1, books.width))
            met = n[entry] > 0
            if met.any():
                flat = [Decimal(int(x)) for x in total.reshape(-1)[met]]
                arrays = [pa.array(np.full(met.sum(), p)), pa.array(entry[met]), pa.array(place[met]), pa.array(flat, pa.decimal128(38, 0)), pa.array(n[entry][met])]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "place", "total", "n"])

    sums = rows.select("vec").mapInArrow(add, "part long, entry long, place long, total decimal(38,0), n long")
    return sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def encoded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code, error of each of ``rows``."""
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    hexed = np.array([f"{i:02x}" for i in range(ENTRIES)], dtype=object)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(2), PARTS * books.width)
            code, error = np.full(len(vectors), "", dtype=object), np.zeros(len(vectors), dtype=object)
            for p, tree in enumerate(books.trees):
                entry, d, _ = tree.nearest(vectors[:, p * books.width : (p + 1) * books.width])
                code, error = code + hexed[entry], error + d
            errors = np.minimum(error, LONG_MAX).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(errors)], names=["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "vec").mapInArrow(encode, schema)


def _long(total: Column) -> Column:
    return F.least(total, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")


def compressed(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, code, error, label_error (the errors of one label in all), codebooks_sha256 of each sound vector."""
    rows = stored(whole_vectors(vectors, vec_id, vector, label), "vectors")
    books = trained(rows)
    codes = stored(encoded(rows, books), "codes")
    by_label = codes.groupBy(F.col("label").alias("__label")).agg(_long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    joined = codes.join(stored(by_label, "label-errors"), F.col("label").eqNullSafe(F.col("__label")))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(books.digest).alias("codebooks_sha256"))
