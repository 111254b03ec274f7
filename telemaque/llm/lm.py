"""Interpolated modified Kneser-Ney n-gram scores (operator 1).

Words are counted first. That gives a dictionary, and each word an id by its place there, dense and mostly small
for frequent words, so that n-grams of ids pack tightly.

Counting: each task sums its n-grams in numpy; what leaves a task is packed blocks, dealt out by the top bits of
the n-gram's hash. An n-gram meets its other counts in the one task of its hash range, so no frequent word or
context makes a task large; how many ranges there are follows from the number of tokens. That task writes the
range as a sorted hash array, and passes on partial sums for the n-grams one word shorter: what follows
them as contexts, and how many different words come before them. They are dealt out in the same way. All of these
are sums over different n-grams, so partial sums add up exactly.

Scoring: workers memory-map the arrays. The n-grams of a batch of texts are looked up in the order of
their hashes, so a range's file is read from front to back, once per batch.

A model is a set of files in the session's shared folder, named by a manifest that holds the files of the
attempts that count; its size follows the corpus. Identity of words and n-grams is a 64-bit hash; of that, arrays keep the
range, the group and 40 bits more, so one that isn't there is taken for another with probability 3e-11 at most.

Defined results: a null text counts as empty, which has the end token only; words not met in training
are one unknown word; repeated rows count each time; other columns are ignored; with nothing to learn
from every token has probability 1 (one unknown word and no other).
"""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemaque.llm import buffers as B
from telemaque.workspace import fresh_dir

ORDER = 3
#: Words that a task sums up at a time.
COUNTED = 1 << 22
#: Words that are looked up at a time when texts are scored.
SCORED = 1 << 20
#: N-grams in a hash range, about and at most.
IN_RANGE = 1 << 22
#: The token that ends a text.
END = B.seeded(2, 21)[0]
#: Ids of what stands before a text and of words not met, and the first id of a word.
BEGIN, UNKNOWN, FIRST = 0, 1, 2
#: A hash array has groups of 16 to 32 keys, of which it keeps this many bits beside those that the group has in common.
GROUP, TAIL = 5, 40

BLOCKS = "kind string, shard int, block binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, offsets by row) of the words and the end of each text, A-Z lower-cased."""
    for row, stop, data, at in B.text_chunks(column):
        start, end, before = B.words(data, at)
        word = B.spans(B.running(data, fold=True), start, end)
        n = stop - row
        offsets = before + np.arange(n + 1)
        out = np.empty(offsets[-1], dtype=np.uint64)
        out[np.arange(len(word)) + np.repeat(np.arange(n), np.diff(before))] = word
        out[offsets[1:] - 1] = END
        yield row, out, offsets


def ngrams(word: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """A row for each token: the ids of the ``n`` words that end with it, with ``BEGIN`` before a text's first."""
    place = np.arange(len(word)) - np.repeat(offsets[:-1], np.diff(offsets))
    rows = np.empty((len(word), n), dtype=np.uint64)
    for back in range(n):
        moved = np.roll(word, back)
        rows[:, n - 1 - back] = np.where(place >= back, moved, BEGIN)
    return rows


def key(rows: np.ndarray) -> np.ndarray:
    """The hashes of n-grams, one row each; also of those of no words."""
    out = np.full(len(rows), B.GOLDEN)
    for i in range(rows.shape[1]):
        out = B.mix(out * B.GOLDEN + rows[:, i])
    return out


def _sums(values: np.ndarray | None, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values``, in ``order``, of each run that starts at ``first``; without values, the runs' lengths."""
    if values is None:
        return np.diff(np.append(first, len(order)))[:, None]
    if len(first) == len(order):
        return values[order]
    return np.column_stack([np.add.reduceat(v[order], first) for v in values.T])


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted different keys, sums of the rows of ``values``, a row of each)."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], _sums(values, order, first), order[first]


def merged(rows: np.ndarray, values: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(different n-grams in the order of their words, sums of the rows of ``values`` or how often each is there)."""
    order = _by_words(rows)
    rows = rows[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = rows[1:, 0] != rows[:-1, 0]
    for column in rows.T[1:]:
        new[1:] |= column[1:] != column[:-1]
    first = np.flatnonzero(new)
    return rows[first], _sums(values, order, first)


def unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted different keys, the place among them of each key)."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    back = np.empty(len(keys), dtype=np.int64)
    back[order] = np.cumsum(first) - 1
    return keys[first], back


def _planes(values: np.ndarray) -> tuple[str, tuple[int, ...], bytes]:
    """The bytes of whole numbers, all lowest ones first, then all next: high ones are mostly 0."""
    values = np.ascontiguousarray(values.astype(np.min_scalar_type(int(values.max(initial=0)))))
    return values.dtype.str, values.shape, values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unplaned(dtype: str, shape: tuple[int, ...], data: bytes) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).reshape(shape)


def _by_words(rows: np.ndarray) -> np.ndarray:
    """The order of n-grams by their words: of those ids as many as there is room for are sorted as one word."""
    words, room = [], 0
    for column in rows.T:
        bits = int(column.max(initial=0)).bit_length()
        if words and bits <= room:
            words[-1] = words[-1] << np.uint64(bits) | column
            room -= bits
        else:
            words.append(column)
            room = 64 - bits
    return np.argsort(words[0]) if len(words) == 1 else np.lexsort(words[::-1])


def pack(rows: np.ndarray, values: np.ndarray) -> bytes:
    """N-grams in the order of their words with their numbers, the first word as what it is above the one before; compressed."""
    order = _by_words(rows)
    return _packed(rows[order], values[order])


def _packed(rows: np.ndarray, values: np.ndarray) -> bytes:
    """``pack`` of what is in that order."""
    columns = [np.diff(rows[:, 0], prepend=np.uint64(0)), *rows.T[1:], *values.T]
    raw = pickle.dumps((rows.shape[1], [_planes(c) for c in columns]), protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
    width, columns = pickle.loads(raw)
    head, *rest = [_unplaned(*c).astype(np.uint64) for c in columns]
    rows = np.column_stack([np.cumsum(head, dtype=np.uint64), *rest[: width - 1]])
    return rows, np.column_stack(rest[width - 1 :]).astype(np.int64)


def _shards(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int32)


def _dealt(kind: str, rows: np.ndarray, values: np.ndarray, bits: int) -> Iterator[tuple]:
    """Blocks of ``BLOCKS`` by hash range, of n-grams that are ``merged``."""
    shard = _shards(rows[:, 0] if kind == "raw" else key(rows), bits)
    # Sorting short numbers keeps equal ones in their order, and is quick.
    order = np.argsort(shard.astype(np.min_scalar_type((1 << bits) - 1)), kind="stable")
    shard, rows, values = shard[order], rows[order], values[order]
    for lo, hi in zip(*_runs(shard), strict=True):
        yield kind, int(shard[lo]), _packed(rows[lo:hi], values[lo:hi])


def _runs(x: np.ndarray) -> tuple[list[int], list[int]]:
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
    return first.tolist(), np.append(first[1:], len(x)).tolist() if len(x) else []


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds, shards, blocks = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(shards, pa.int32()), pa.array(blocks, pa.binary())], names=["kind", "shard", "block"])


def counted_words(texts: DataFrame, bits: int) -> DataFrame:
    """Blocks of the words ("raw") of ``texts`` (text)."""

    return texts.mapInArrow(_counter("raw", lambda word, offsets: word[:, None], bits), BLOCKS)


def counted(texts: DataFrame, words: Table, order: int, bits: int) -> DataFrame:
    """Blocks of the n-grams of ``texts`` (text), whose words are numbered by ``words``."""

    return texts.mapInArrow(_counter(f"n{order}", lambda word, offsets: ngrams(words.numbered(word)[0], offsets, order), bits), BLOCKS)


def gathered(chunks: Iterator[tuple[int, np.ndarray, np.ndarray]], least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The chunks of ``tokens``, as many together as have ``least`` tokens."""
    held, size = [], 0
    for chunk in chunks:
        held.append(chunk)
        size += len(chunk[1])
        if size >= least:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(chunks: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    lengths = np.concatenate([np.diff(offsets) for _, _, offsets in chunks])
    return chunks[0][0], np.concatenate([word for _, word, _ in chunks]), np.append(0, np.cumsum(lengths))


def _counter(kind: str, rows_of, bits: int):
    """A task's part of counting: the n-grams of ``COUNTED`` words or more are summed before they leave it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = (chunk for batch in batches for chunk in tokens(batch.column(0)))
        for _, word, offsets in gathered(chunks, COUNTED):
            rows = rows_of(word, offsets)
            for block in _dealt(kind, *merged(rows), bits):
                yield _batch([block])

    return count


def reduced(blocks: DataFrame, folder: str, bits: int) -> DataFrame:
    """Sums each hash range, writes it, and passes on blocks of n-grams one word shorter.

    These come as contexts, with what follows them, and as ends, with what comes before; one row has both.
    Rows of kind "file" (block: the file's description) come beside them; those of earlier rounds pass through.
    """

    def flush(kind: str, shard: int, held: list[bytes], store, root: str) -> Iterator[pa.RecordBatch]:
        parts = [unpack(b) for b in held]
        rows, values = np.concatenate([r for r, _ in parts]), np.concatenate([v for _, v in parts])
        del parts
        keys, values, one = summed(rows[:, 0] if kind == "raw" else key(rows), values)
        yield _batch([("file", shard, pickle.dumps(write(store, root, kind, shard, keys, values, bits)))])
        n = rows.shape[1]
        if kind == "raw" or n == 1:
            return
        met = values[:, 0] > 0
        rows, count = rows[one][met], values[met, 0]
        after = np.column_stack([np.zeros_like(count), count, count == 1, count == 2, count >= 3]).astype(np.int64)
        before = np.zeros_like(after)
        before[:, 0] = 1
        rows, values = np.concatenate([rows[:, :-1], rows[:, 1:]]), np.concatenate([after, before])
        for block in _dealt(f"n{n - 1}", *merged(rows, values), bits):
            yield _batch([block])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        at, held = None, []
        for batch in batches:
            for kind, shard, block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if kind == "file":
                    yield _batch([(kind, shard, block)])
                    continue
                if (kind, shard) != at and held:
                    yield from flush(*at, held, store, root)
                    held = []
                at = (kind, shard)
                held.append(block)
        if held:
            yield from flush(*at, held, store, root)

    dealt = blocks.repartition("kind", "shard").sortWithinPartitions("kind", "shard")
    return dealt.mapInArrow(run, BLOCKS)


#: The numbers most keys have, by how many there are: an n-gram met once; one with a word before it and one after it.
SINGLE = {1: (1,), 5: (1, 1, 1, 0, 0)}


def _split(keys: np.ndarray, bits: int, fanout: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, tail) of keys of a hash range: ``fanout`` bits that follow the range's, and the ``TAIL`` bits that follow those."""
    rest = keys << np.uint64(bits)
    group = (rest >> np.uint64(64 - fanout)).astype(np.int64) if fanout else np.zeros(len(keys), np.int64)
    return group, (rest << np.uint64(fanout)) >> np.uint64(64 - TAIL)


def write(store, root: str, kind: str, shard: int, keys: np.ndarray, values: np.ndarray, bits: int) -> dict:
    """Sorted hash arrays with their numbers: keys with those of ``SINGLE`` come first, without any, then keys with
    numbers of a byte, then the others. An array is the places where its groups start, and the tails of its keys."""
    name = f"{kind}-{shard}-{uuid.uuid4().hex}"
    single = (values == SINGLE[values.shape[1]]).all(axis=1)
    byte = ~single & (values < 256).all(axis=1)
    parts = []
    with store.open_output_stream(f"{root}/{name}") as out:
        for some, dtype in ((single, None), (byte, "|u1"), (~single & ~byte, "<i8")):
            n = int(some.sum())
            fanout = max(0, n.bit_length() - GROUP)
            group, tail = _split(keys[some], bits, fanout)
            starts = np.searchsorted(group, np.arange((1 << fanout) + 1)).astype("<u4")
            sections = [starts, (tail >> np.uint64(8)).astype("<u4"), tail.astype("|u1"), *([values[some].astype(dtype)] if dtype else [])]
            parts.append((n, fanout, dtype))
            for section in sections:
                raw = np.ascontiguousarray(section).tobytes()
                out.write(raw + bytes(-len(raw) % 8))
    counts = values[:, 0]
    return {
        "kind": kind, "shard": shard, "name": name, "parts": parts, "n": int((counts > 0).sum()), "total": int(counts.sum()),
        "times": [int((counts == i).sum()) for i in range(1, 5)],
    }


@dataclass(frozen=True)
class Level:
    """What a level of n-grams has in all: types, tokens, and the discounts for counts of 1, 2 and more."""

    types: int
    total: int
    times: tuple[int, int, int, int]
    three: int

    @property
    def discounts(self) -> tuple[float, float, float]:
        n1, n2, n3, n4 = self.times
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        raw = [i - (i + 1) * y * after / n if n else i * y for i, n, after in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        return tuple(min(max(d, 0.05 * i), 0.95 * i) for i, d in enumerate(raw, 1))


@lru_cache(maxsize=4096)
def mapped(uri: str) -> np.ndarray:
    """The bytes of a file, memory-mapped (as a plain array: slices of ``memmap`` are slow). One that the worker can't open by itself is copied to a file
    that has no name, and goes with the worker."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return np.asarray(np.memmap(unquote(parts.path), dtype=np.uint8, mode="r"))
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(path) as source, tempfile.TemporaryFile() as copy:
        while part := source.read(1 << 24):
            copy.write(part)
        copy.flush()
        return np.asarray(np.memmap(copy, dtype=np.uint8, mode="r"))


class Table:
    """Files of sorted hash arrays, as workers use them."""

    def __init__(self, folder: str, files: list[dict], bits: int):
        self.folder, self.bits = folder, bits
        self.files = {(f["kind"], f["shard"]): f for f in files}

    def level(self, kind: str) -> Level:
        of = [f for f in self.files.values() if f["kind"] == kind]
        times = tuple(sum(f["times"][i] for f in of) for i in range(4))
        types = sum(f["n"] for f in of)
        return Level(types, sum(f["total"] for f in of), times, types - times[0] - times[1])

    def found(self, kind: str, keys: np.ndarray, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Of sorted different ``keys``: their numbers, 0 for those that aren't there, and their ranks in their file, the greatest
        numbers first, or -1."""
        out, rank = np.zeros((len(keys), width), dtype=np.int64), np.full(len(keys), -1, dtype=np.int64)
        shard = _shards(keys, self.bits)
        for lo, hi in zip(*_runs(shard), strict=True):
            file = self.files.get((kind, int(shard[lo])))
            if file is None:
                continue
            data = mapped(f"{self.folder}/{file['name']}")
            start, after, left = 0, sum(n for n, _, _ in file["parts"]), np.arange(lo, hi)
            for n, fanout, dtype in file["parts"]:
                sections = []
                for count, kind_of in ((1 << fanout) + 1, "<u4"), (n, "<u4"), (n, "|u1"), (n * width if dtype else 0, dtype or "|u1"):
                    size = count * np.dtype(kind_of).itemsize
                    sections.append(data[start : start + size].view(kind_of))
                    start += size + -size % 8
                after -= n
                if n and len(left):
                    at = _at(*sections[:3], *_split(keys[left], self.bits, fanout))
                    hit, at = left[at >= 0], at[at >= 0]
                    out[hit] = sections[3].reshape(-1, width)[at] if dtype else SINGLE[width]
                    rank[hit] = after + at
                    left = left[rank[left] < 0]
        return out, rank

    def different(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the different words, their counts, the place among them of each of ``words``).

        Ids are dense, mostly those of frequent words are small, and words that aren't there are ``UNKNOWN``.
        """
        different, back = unique(words)
        counts, rank = self.found("raw", different)
        ids = np.where(rank < 0, UNKNOWN, FIRST + (rank << self.bits) + _shards(different, self.bits))
        return ids.astype(np.uint64), counts[:, 0], back

    def numbered(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of words."""
        ids, counts, back = self.different(words)
        return ids[back], counts[back]


def _at(starts: np.ndarray, high: np.ndarray, low: np.ndarray, group: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted hash array, -1 for those that aren't there: all are searched in their groups at once."""
    at, end = starts[group].astype(np.int64), starts[group + 1].astype(np.int64)
    want, last = (tail >> np.uint64(8)).astype(np.uint32), tail.astype(np.uint8)
    size = end - at
    full = np.flatnonzero(size)
    at, end, want, last, size = at[full], end[full], want[full], last[full], size[full]
    for _ in range(int(size.max(initial=1) - 1).bit_length()):
        half = size >> 1
        at += half * (high[at + half - (half > 0)] < want)
        size -= half
    at += high[at] < want
    out = np.full(len(group), -1, dtype=np.int64)
    # Keys of a group whose high bits are the same follow each other.
    while len(at):
        inside = at < end
        inside[inside] = high[at[inside]] == want[inside]
        at, end, want, last, full = at[inside], end[inside], want[inside], last[inside], full[inside]
        same = low[at] == last
        out[full[same]] = at[same]
        at, end, want, last, full = at[~same] + 1, end[~same], want[~same], last[~same], full[~same]
    return out


class Model:
    """The words of a model, the n-grams of their ids, and what the levels have in all."""

    def __init__(self, words: Table, grams: Table, order: int):
        self.word_table, self.grams, self.order = words, grams, order
        self.levels = {n: grams.level(f"n{n}") for n in range(1, order + 1)}
        raw = words.level("raw")
        self.words, self.tokens = raw.types, raw.total

    def _own(self, numbers: np.ndarray, n: int) -> np.ndarray:
        """What is left of the counts of n-grams."""
        d = np.array([0.0, *self.levels[n].discounts])
        return np.maximum(numbers[:, 0] - d[np.minimum(numbers[:, 0], 3)], 0.0)

    def _after(self, numbers: np.ndarray, n: int) -> np.ndarray:
        """For n-grams as contexts: what follows them in all, and how much of that is taken off. A row of each for all of them."""
        d = self.levels[n + 1].discounts
        return np.stack([numbers[:, 1].astype(float), numbers[:, 2] * d[0] + numbers[:, 3] * d[1] + numbers[:, 4] * d[2]])

    def _read(self, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the different ``keys`` of n-grams, and the place among them of each."""
        different, back = unique(keys)
        return self.grams.found(f"n{n}", different, 1 if n == self.order else 5)[0], back

    def _levels(self, rows: np.ndarray, ids: np.ndarray, back: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """For each n: what is left of the counts of the last n words of ``rows``, and what follows those one place before.

        Within a text, the words one place before are the n-gram that ends there, so that only others are read besides.
        """
        for n in range(1, self.order + 1):
            if n == 1:  # of these there are as many as different words
                numbers, at = self._read(key(np.append(ids, np.uint64(BEGIN))[:, None]), 1)
                own, before = at[back], at[np.append(len(ids), back)[:-1]] if len(back) else at[back]
                before = np.where(rows[:, -2] == BEGIN, at[len(ids)], before) if self.order > 1 else before
            else:
                tail = key(rows[:, self.order - n :])
                if n == self.order:
                    numbers, own = self._read(tail, n)
                    yield self._own(numbers, n)[own], None
                    return
                context = key(rows[:, self.order - n - 1 : -1])
                other = np.flatnonzero(np.append(True, context[1:] != tail[:-1])[: len(rows)])
                numbers, at = self._read(np.concatenate([tail, context[other]]), n)
                own, before = at[: len(rows)], np.roll(at[: len(rows)], 1)
                before[other] = at[len(rows) :]
            yield self._own(numbers, n)[own], self._after(numbers, n)[:, before] if n < self.order else None

    def probabilities(self, rows: np.ndarray, ids: np.ndarray, back: np.ndarray) -> np.ndarray:
        """P(last word | words before it) of each row of ``order`` ids; the last ones are ``ids[back]``."""
        p = np.full(len(rows), 1.0 / (self.words + 1))
        first = self.levels[1]
        if not first.total:
            return p
        kinds, d = (*first.times[:2], first.three), first.discounts
        total, taken = np.array([[float(first.total)], [sum(k * x for k, x in zip(kinds, d, strict=True))]])
        for own, after in self._levels(rows, ids, back):
            met = total > 0
            p = np.where(met, (own + taken * p) / np.where(met, total, 1.0), p)
            if after is not None:
                total, taken = after
        return p


def trained(texts: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """A model of the column ``text``. What comes to the driver are the lists of its files."""
    spark = texts.sparkSession
    folder = fresh_dir(spark, "lm")
    plain = texts.select(F.col(f"`{text}`").alias("text"))

    def files(blocks: DataFrame) -> list[dict]:
        return [pickle.loads(r.block) for r in blocks.select("block").collect()]

    bits = max(4, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    words = Table(folder, files(reduced(counted_words(plain, bits), folder, bits)), bits)
    # There are as many n-grams as tokens at most, and no level has more: so many ranges that one fits into a task.
    bits = max(bits, (words.level("raw").total // IN_RANGE).bit_length())
    blocks = counted(plain, words, order, bits)
    # One job for all rounds: what goes from one to the next is on disk once, as shuffle files.
    for _ in range(order):
        blocks = reduced(blocks, folder, bits)
    return Model(words, Table(folder, files(blocks), bits), order)


def scored(docs: DataFrame, model: Model, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document with the columns of ``RESULT``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = 0.5 * (model.words + 1)
        for batch in batches:
            for row, word, offsets in gathered(tokens(batch.column(2)), SCORED):
                ids, c, back = model.word_table.different(word)
                rows, c = ngrams(ids[back], offsets, model.order), c[back]
                first = offsets[:-1]
                base = np.log10((c + 0.5) / (model.tokens + floor))
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, n),
                        batch.column(1).slice(row, n),
                        pa.array(np.diff(offsets)),
                        pa.array(np.add.reduceat((c > 0).astype(np.int64), first)),
                        pa.array(np.full(n, model.tokens)),
                        pa.array(np.add.reduceat(base, first)),
                        pa.array(np.add.reduceat(np.log10(model.probabilities(rows, ids, back)), first)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(f"`{text}`").alias("text"))
    return plain.mapInArrow(score, RESULT)
