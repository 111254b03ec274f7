"""Text columns as flat byte buffers: words, lines and their 64-bit hashes, computed in numpy.

A chunk of texts is one ``uint8`` array and the texts' offsets in it. Hashes of words and lines
come from one running sum over the chunk, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
#: The multiplier of the splitmix64 generator and the two of its finalizer. Fixed values.
GOLDEN, MIX_A, MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
BASE = 0xD6E8FEB86659FD93

U64 = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit over the output."""
    h = (h ^ (h >> U64(30))) * MIX_A
    h = (h ^ (h >> U64(27))) * MIX_B
    return h ^ (h >> U64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random words."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed << 32)) * GOLDEN)


_BYTE = seeded(256, 1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTE_FOLDED = _BYTE[_FOLD]
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``n``; kept, and grown when a longer chunk comes."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, CHUNK_BYTES + 1), base, dtype=U64)
        out[0] = 1
        have = _powers[base] = np.multiply.accumulate(out)
    return have[:n]


def _inverse(odd: int) -> int:
    x = odd
    for _ in range(6):
        x = x * (2 - odd * x) % 2**64
    return x


_BASE_INVERSE = _inverse(BASE)


def running(data: np.ndarray, fold: bool = False) -> np.ndarray:
    """Running sums from which ``spans`` reads hashes; ``fold`` lower-cases A-Z first."""
    out = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((_BYTE_FOLDED if fold else _BYTE)[data] * _power(BASE, len(data)), out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans ``[start, end)``: equal spans of one length have equal hashes."""
    inner = (sums[end] - sums[start]) * _power(_BASE_INVERSE, len(sums))[start]
    return mix(inner + (end - start).astype(U64) * GOLDEN)


def sequences(h: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hashes of every ``n`` consecutive entries of ``h``."""
    out = h[: max(0, len(h) - n + 1)].copy()
    for i in range(1, n):
        out = mix(out * GOLDEN + h[i : len(h) - n + 1 + i])
    return out


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of about ``chunk_bytes``; nulls are empty.

    A single longer text is a run of its own, whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    raw = column.buffers()
    at = np.frombuffer(raw[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(at, at[row] + chunk_bytes, "right")) - 1)
        yield row, last, data[at[row] : at[last]], at[row : last + 1] - at[row]
        row = last


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of non-space bytes, and the number of words before each text."""
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = at[:-1][at[:-1] < len(data)]
    first[inner] = solid[inner]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    ends = at[1:][at[1:] > 0] - 1
    last[ends] = solid[ends]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, at)


def lines(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces between line breaks, and the number of pieces before each text.

    A text of n line breaks has n + 1 pieces, the empty text one.
    """
    breaks = np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, at)
    n = len(at) - 1
    start = np.empty(len(breaks) + n, dtype=np.int64)
    end = np.empty_like(start)
    first = before[:-1] + np.arange(n)
    owner = np.searchsorted(at[1:], breaks, "right")
    place = np.arange(len(breaks)) + owner
    start[first] = at[:-1]
    start[place + 1] = breaks + 1
    end[place] = breaks
    end[before[1:] + np.arange(n)] = at[1:]
    return start, end, np.append(first, len(start))
