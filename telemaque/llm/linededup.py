"""Line dedup by a segment-partition edit join (operator 3).

Lines within a few edits of each other are one class, of which the corpus keeps the first in the order
of documents and lines. How many edits follows from the shorter line's length (``EDITS``; from ``LONG`` code points on
``PER_CENT`` of them).

A pair with t edits has t // 2 of them at most in one of its halves. So from either end a line is cut into
t // 2 + 1 segments: one of the two ends has, as its i-th segment, one that the other line has unchanged,
displaced by i places at most. Lines are therefore entered in an index by (length class, end, i, segment), and
looked up with those of their own substrings that could be such a segment of a line as long or a little
shorter. An index of every segment at every place of the longer line would need t * t / 2 look-ups; instead
the last ``step - 1`` code points of a segment are spent on ``step`` entries for it, and only every
``step``-th place is looked up. Very long lines (``LOOSE``) have t + 1 segments that may stand anywhere.
Candidates are verified by a banded bit-parallel edit distance, after those have been left out that the reach of the
band's diagonals shows to be too far apart.

Keys leave a task as packed blocks: sorted, truncated and delta-coded, with ``PRINT`` bits of the line's identity. The
blocks of a range of keys meet in one task, and only keys that different lines share become rows.

Equal lines are one entry throughout; a line's identity is a 64-bit hash. Lines are split at line feeds;
lengths and edits count code points.

Defined results: lines of fewer than ``EDITS[0][0]`` code points are linked with exact copies only; lines of
nothing but white space are no rows of the result and stay in their texts. A null text has no lines. Rows are
told apart by id and text: rows of one id and different texts are documents each, in the order of a hash of
theirs, rows without an id come after all ids, and rows alike in both are one document. Other columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemaque.llm import buffers as B
from telemaque.llm.linking import classes_by_home, homes, passing, sent, sized, stored

#: (code points from which it holds, edits); of lines below the first only exact copies are linked.
EDITS = ((20, 1), (60, 2))
#: From LONG code points on, PER_CENT of them are the allowed edits; from LOOSE on, segments may stand anywhere.
LONG, PER_CENT, LOOSE = 100, 3, 2222
#: A length class ends this much above its shortest line.
CLASS_PER_CENT = 10
LONGEST = 1 << 31

#: Characters of a gram, and bits of a line's gram parities.
GRAM, BITS = 2, 256
#: Odd multipliers that spread a gram's code points.
GRAM_A, GRAM_B = 0x9E3779B1, 0x85EBCA77

#: Keys that a task holds before it sends them, look-ups computed at a time, bytes of the blocks of a range of keys.
HELD_KEYS, AT_ONCE, RANGE_BYTES = 1 << 21, 1 << 16, 16 << 20
#: Ranges of keys, at most: a task sends a block for each.
RANGES = 1 << 12
#: Bits of a line's identity beside a key. Two close lines with the same are taken for one line: a link is lost with probability 6e-8.
PRINT = 24
#: Pairs that are compared at a time, and code points of their longer lines; of fewer pairs a word, each is compared by itself.
PAIRS, HELD_CODES, FEW_PAIRS = 2048, 1 << 20, 50
#: The most edits that are counted before a pair is compared in a band of as many.
REACHED = 300
#: Keys have this many bits more than it takes to count them.
SPARE_BITS = 9

OCCURRENCES = "doc_id long, row long, line_no long, line_id long, size long"
BLOCKS = "shard int, chunk long, kind string, block binary"
SHARED = "bucket long, chunk long, print long, pivot boolean, id long"


@cache
def _first_plane() -> np.ndarray:
    return B.mix(np.arange(1 << 16, dtype=np.uint64) + B.GOLDEN)


def _letters(codes: np.ndarray) -> np.ndarray:
    """A random word for each code point."""
    if len(codes) and codes.max() >= 1 << 16:
        return B.mix(codes + B.GOLDEN)
    return _first_plane()[codes]


class Lines:
    """The judged lines of a run of texts, as code points."""

    def __init__(self, data: np.ndarray, at: np.ndarray, edits: tuple = EDITS):
        text = data.tobytes().decode("utf-8", "replace")
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        start, end, first = B.lines(data, at)
        inner, blank = np.flatnonzero((data & 0xC0) == 0x80), np.flatnonzero(B.SPACE[data])
        judged = np.searchsorted(blank, end) - np.searchsorted(blank, start) < end - start
        self.row = np.repeat(np.arange(len(at) - 1), np.diff(first))
        self.number = np.arange(len(start)) - first[self.row]
        self.start, self.end = (x - np.searchsorted(inner, x) for x in (start, end))
        for name in ("row", "number", "start", "end"):
            setattr(self, name, getattr(self, name)[judged])
        self.size = self.end - self.start
        self.sums = np.zeros(len(self.codes) + 1, dtype=np.uint64)
        np.cumsum(_letters(self.codes) * B._power(B.BASE, len(self.codes)), out=self.sums[1:])
        self.id = B.spans(self.sums, self.start, self.end).view(np.int64)

    def about(self, which: np.ndarray) -> np.ndarray:
        """Size and gram parities of some lines: one bit for each class of grams, whether the line has an odd number of them."""
        size = self.size[which]
        n = np.maximum(size - GRAM + 1, 0)
        owner = np.repeat(np.arange(len(which)), n)
        at = self.start[which][owner] + np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
        grams = self.codes[: len(self.codes) - GRAM + 1] * np.uint32(GRAM_A)
        for i in range(1, GRAM):
            grams = (grams ^ self.codes[i : len(self.codes) - GRAM + 1 + i]) * np.uint32(GRAM_B)
        kind = (grams >> np.uint32(32 - (BITS.bit_length() - 1))).astype(np.int64)[at]
        odd = np.bincount(owner * BITS + kind, minlength=len(which) * BITS).reshape(-1, BITS) & 1
        return np.column_stack([size, np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)])

    def text(self, i: int) -> str:
        return self.codes[self.start[i] : self.end[i]].tobytes().decode("utf-32-le", "surrogatepass")


def allowed(size: np.ndarray, edits: tuple = EDITS) -> np.ndarray:
    out = np.zeros(len(size), dtype=np.int64)
    for least, n in edits:
        out[size >= least] = n
    return np.where(size >= LONG, np.asarray(size) * PER_CENT // 100, out)


def allowed_column(size: Column, edits: tuple = EDITS) -> Column:
    out = F.lit(0)
    for least, n in edits:
        out = F.when(size >= least, F.lit(n)).otherwise(out)
    return F.when(size >= LONG, F.floor(size * PER_CENT / 100)).otherwise(out)


@cache
def bounds(edits: tuple = EDITS) -> np.ndarray:
    """The shortest size of each length class; a class has one number of edits below ``LONG``."""
    starts, size = [], edits[0][0]
    marks = sorted({least for least, _ in edits} | {LONG, LOOSE})
    while size < LONGEST:
        starts.append(size)
        after = max(size + 1, size + size * CLASS_PER_CENT // 100)
        size = min([after, *[m for m in marks if size < m < after]])
    return np.array(starts)


@cache
def segments(number: int, edits: tuple = EDITS) -> tuple[int, int, int, int]:
    """(segments of an end, or of the whole line, their length, entries for each, length of a key) of a length class."""
    low, high = (int(x) for x in bounds(edits)[[number, min(number + 1, len(bounds(edits)) - 1)]])
    t = int(allowed(np.array([max(low, high - 1)]), edits)[0])
    parts, room = (t // 2 + 1, low // 2) if low < LOOSE else (t + 1, low)
    length = max(1, room // parts)
    step = round((parts if low < LOOSE else low / parts) ** 0.5)
    step = max(1, min(step, length // 2))
    return parts, length, step, length - step + 1


@cache
def places(number: int, indexed: bool, edits: tuple = EDITS) -> tuple[np.ndarray, np.ndarray]:
    """(distance from the end, segment) of the keys that a line has for a class at either of its ends."""
    parts, length, step, _ = segments(number, edits)
    at, of = [], []
    for i in range(parts):
        first, last = (i * length, i * length + step) if indexed else (max(0, i * length - i), i * length + i + step)
        found = [p for p in range(first, last) if indexed or p % step == 0]
        at += found
        of += [i] * len(found)
    return np.array(at, dtype=np.int64), np.array(of, dtype=np.int64)


def entries(lines: Lines, edits: tuple = EDITS, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, place among the lines, in the index) for the different lines of a run but those whose ids are ``known``."""
    one = np.unique(lines.id, return_index=True)[1]
    one = one[lines.size[one] >= edits[0][0]]
    if known is not None:
        one = one[~np.isin(lines.id[one], known)]
    found: list[tuple] = []
    back = B._power(B._BASE_INVERSE, len(lines.sums))

    def add(which: np.ndarray, lo: np.ndarray, width: int, tag: np.ndarray, indexed: bool) -> None:
        inner = (lines.sums[lo + width] - lines.sums[lo]) * back[lo]
        found.append((B.mix(inner + tag), which, np.full(len(which), indexed)))

    def anchored(number: int, which: np.ndarray, indexed: bool) -> None:
        at, of = places(number, indexed, edits)
        width = segments(number, edits)[3]
        tags = B.seeded(2 * (int(of.max()) + 1), number + 100)
        some = max(1, AT_ONCE // len(at))
        for i in range(0, len(which), some):
            rows = which[i : i + some]
            start, end = lines.start[rows][:, None], lines.end[rows][:, None]
            fits = None if indexed else at <= end - start - width
            for lo, side in ((start + at, 0), (end - at - width, 1)):
                shape = lo.shape
                line, tag = (np.broadcast_to(x, shape) for x in (rows[:, None], tags[2 * of + side]))
                if fits is None or fits.all():
                    add(line.reshape(-1), lo.reshape(-1), width, tag.reshape(-1), indexed)
                else:
                    add(line[fits], lo[fits], width, tag[fits], indexed)

    def anywhere(number: int, which: np.ndarray, indexed: bool) -> None:
        step, width = segments(number, edits)[2:]
        tag = B.seeded(1, number + 100)
        for line in which.tolist():
            at = places(number, True, edits)[0] if indexed else np.arange(0, int(lines.size[line]) - width + 1, step)
            add(np.full(len(at), line), lines.start[line] + at, width, tag, indexed)

    size = lines.size[one]
    own = np.searchsorted(bounds(edits), size, "right") - 1
    least = np.maximum(size - allowed(size, edits), edits[0][0])
    lowest = np.searchsorted(bounds(edits), least, "right") - 1
    for number in np.unique(np.concatenate([own, lowest])).tolist():
        keys = anchored if bounds(edits)[number] < LOOSE else anywhere
        keys(number, one[own == number], True)
        keys(number, one[(lowest <= number) & (number <= own)], False)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def within(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance is at most ``limit``: bit-parallel, in a band of 2 * limit + 1 diagonals.

    Bit k of a word stands for row j - limit + k of column j. The vertical differences along the band
    give those of the next column in a few word operations; the lowest diagonal's value is kept.
    """
    if a == b:
        return True
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > limit:
        return False
    lo, least = 0, len(b)
    step = 256
    while lo < least and a[lo : lo + step] == b[lo : lo + step] and lo + step <= least:
        lo += step
    while lo < least and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < least - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    if not b:
        return len(a) <= limit
    rows, cols = a, b  # rows: the longer
    width = 2 * limit + 1
    full = (1 << width) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(rows):
        where[c] = where.get(c, 0) | 1 << (i + limit)
    # Column 0: row r has value r; bits stand for the step into rows 1 - limit .. limit + 1 of column 1.
    up, down, value = full & ~((1 << limit) - 1), 0, limit
    m, n = len(rows), len(cols)
    lowest = 1 << (width - 1)
    for j, c in enumerate(cols):
        match = (where.get(c, 0) >> j) & full
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        right_up = (down | ~(diagonal | up)) & full
        right_down = diagonal & up
        if j + limit < m:  # along the lowest diagonal
            value += 0 if diagonal & lowest else 1
        else:  # along the last row
            bit = 1 << (width - 1 - (j + limit + 1 - m))
            value += (1 if right_up & bit else 0) - (1 if right_down & bit else 0)
        if value > 2 * limit + 1:
            return False
        up = (right_down | ~((diagonal >> 1) | right_up)) & full
        down = (diagonal >> 1) & right_up
    return value <= limit


def all_within(pairs: list[tuple[str, str]], limits: np.ndarray) -> np.ndarray:
    """``within`` of many pairs at once, column by column, a few words for each pair."""
    out = np.zeros(len(pairs), dtype=bool)
    size = np.array([(max(len(a), len(b)), min(len(a), len(b))) for a, b in pairs], dtype=np.int64).reshape(-1, 2)
    found = np.zeros(len(pairs), dtype=np.int64) + limits
    rest = np.flatnonzero(size[:, 0] - size[:, 1] <= limits)
    rest = rest[np.lexsort((size[rest, 1], limits[rest]))]
    i = 0
    while i < len(rest) and limits[rest[i]] <= REACHED:
        some = rest[i : i + max(1, HELD_CODES // (int(size[rest[i : i + PAIRS], 0].max()) + 8))][:PAIRS]
        some = some[limits[some] <= REACHED]
        found[some] = _reached([max(pairs[k], key=len) for k in some], [min(pairs[k][::-1], key=len) for k in some], limits[some])
        i += len(some)
    # What is left is compared within the band that its edits need.
    rest = rest[found[rest] <= limits[rest]]
    limits = np.minimum(found, limits)
    words = 2 * limits // 64 + 1
    rest = rest[np.lexsort((size[rest, 1], limits[rest]))]
    while len(rest):
        n, most = int(words[rest[0]]), max(1, HELD_CODES // (int(size[rest[0], 0]) + 1))
        some = rest[: min(PAIRS, most)]
        some, rest = some[words[some] == n], rest[int((words[rest[: min(PAIRS, most)]] == n).sum()) :]
        if n > 1 and len(some) < FEW_PAIRS * n:
            out[some] = [within(*pairs[k], int(limits[k])) for k in some.tolist()]
        else:
            out[some] = _banded([max(pairs[k], key=len) for k in some], [min(pairs[k][::-1], key=len) for k in some], limits[some])
    return out


def _dense(flat: np.ndarray) -> np.ndarray:
    """Code points numbered from 2 on, in as few bytes as they need."""
    most = int(flat.max(initial=0))
    if most > 0xFD:
        there = np.zeros(most + 1, dtype=bool)
        there[flat] = True
        number = np.cumsum(there)
        flat, most = number[flat], int(number[-1])
    return (flat + 2).astype(np.min_scalar_type(most + 2))


def _codes(texts: list[str], flat: np.ndarray, before: int, after: int, fill: int) -> np.ndarray:
    """A row of codes for each text, with ``fill`` around them."""
    size = np.array(list(map(len, texts)))
    out = np.full((len(texts), before + int(size.max(initial=0)) + after), fill, dtype=flat.dtype)
    at = np.cumsum(size) - size
    for row, (lo, n) in enumerate(zip(at.tolist(), size.tolist(), strict=True)):
        out[row, before : before + n] = flat[lo : lo + n]
    return out


def _windows(texts: np.ndarray, size: np.ndarray, fill: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of texts with ``fill`` between them, the eight bytes from each on as a word, and where the texts begin."""
    per = 8 // texts.itemsize
    start = np.cumsum(size + per) - size - per
    codes = np.full(int(size.sum()) + per * (len(size) + 1), fill, dtype=texts.dtype)
    codes[np.arange(len(texts)) + np.repeat(start - (np.cumsum(size) - size), size)] = texts
    return codes, np.ndarray(len(codes) - per + 1, "<u8", codes, strides=(texts.itemsize,)).copy(), start


def _alike(left: tuple, right: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many codes are the same from each two places on, a word at a time."""
    (a, a_words, _), (b, b_words, _) = left, right
    one, bits = np.uint64(1), a.itemsize.bit_length() + 2
    out, active, step = np.zeros(len(i), dtype=np.int64), np.arange(len(i)), 0
    while len(active):
        if step >= 8 and len(active) <= 32:
            for k in active.tolist():
                x, y, n = int(i[k] + out[k]), int(j[k] + out[k]), 256
                while not (differ := a[x : x + min(n, len(b) - y)] != b[y : y + min(n, len(a) - x)]).any():
                    x, y, n = x + n, y + n, 4 * n
                out[k] = x - i[k] + differ.argmax()
            break
        word = a_words[i[active] + out[active]] ^ b_words[j[active] + out[active]]
        out[active] += np.bitwise_count((word & (~word + one)) - one) >> bits
        active, step = active[word == 0], step + 1
    return out


def _reached(long: list[str], short: list[str], limits: np.ndarray) -> np.ndarray:
    """The edits of each pair, or one more than its limit: how far each diagonal of the band is reached with none, one, two...

    Only diagonals count from which the rest of the edits leads back to the last one.
    """
    m, n = (np.array(list(map(len, x)), dtype=np.int64) for x in (long, short))
    flat, gap = _dense(np.frombuffer("".join([*long, *short]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)), m - n
    a, b = _windows(flat[: int(m.sum())], m, 0), _windows(flat[int(m.sum()) :], n, 1)
    wide = int(((limits - gap) // 2).max(initial=0))
    diagonal = np.arange(-wide, int(gap.max(initial=0)) + wide + 1)
    most = np.minimum(n[:, None], m[:, None] - diagonal).astype(np.int32)
    back, least = np.abs(gap[:, None] - diagonal), np.maximum(0, -diagonal)
    far = np.full((len(m), len(diagonal) + 2), -(1 << 30), dtype=np.int32)  # places of the shorter text
    far[:, 1 + wide] = 0
    result, left, each = limits + 1, limits.copy(), np.arange(len(m))
    for e in range(int(limits.max(initial=-1)) + 1):
        lo, hi = max(0, wide - e), min(len(diagonal), wide + e + 1)
        part = far[:, lo + 1 : hi + 1]
        if e:
            best = np.maximum(part + 1, far[:, lo:hi])
            best = np.maximum(best, far[:, lo + 2 : hi + 2] + 1)
            part[:] = np.minimum(best, most[:, lo:hi])
        row, at = np.nonzero((back[:, lo:hi] + e <= left[:, None]) & (part >= least[lo:hi]))
        if not len(row):
            break
        place = part[row, at].astype(np.int64)
        part[row, at] = place + _alike(a, b, a[2][row] + place + diagonal[lo + at], b[2][row] + place)
        ended = (far[each, 1 + wide + gap] >= n) & (left >= e)
        result[ended] = e
        left[ended] = -1
    return result


def _banded(long: list[str], short: list[str], limits: np.ndarray) -> np.ndarray:
    """Whether the distance of each pair is within its limit; the band is as wide as the widest needs.

    As in ``within``, with the band's bits in words of 64, the lowest first: carries go from one to the next.
    """
    band = int(limits.max(initial=0))
    width = 2 * band + 1
    words = (width + 63) // 64
    one, last_bit = np.uint64(1), np.uint64(63)
    full = np.array([(1 << min(64, width - 64 * w)) - 1 for w in range(words)], dtype=np.uint64)
    lowest = one << np.uint64((width - 1) % 64)
    m, n = (np.array(list(map(len, x)), dtype=np.int64) for x in (long, short))
    flat = _dense(np.frombuffer("".join([*long, *short]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
    rows, cols = _codes(long, flat, band, 64 * words, 0), _codes(short, flat[int(m.sum()) :], 0, 1, 1)
    result = np.where(n == 0, m <= limits, False)
    live = np.flatnonzero(n > 0)
    start = np.array([~((1 << band) - 1) >> 64 * w & 0xFFFFFFFFFFFFFFFF for w in range(words)], dtype=np.uint64) & full
    up = np.repeat(start[None, :], len(live), axis=0)
    down, value = np.zeros_like(up), np.minimum(band, m[live])
    rows, cols, m, n, limit = rows[live], cols[live], m[live], n[live], limits[live]
    ends, inner = set(n.tolist()), int(m.min(initial=0)) - band
    for j in range(int(n.max(initial=0))):
        found = rows[:, j : j + 64 * words] == cols[:, j, None]
        match = np.packbits(found.reshape(-1), bitorder="little").view("<u8").reshape(-1, words)
        total = match & up
        if words == 1:
            total += up
        else:
            carry = np.zeros(len(total), dtype=np.uint64)
            for w in range(words):
                own = total[:, w] + up[:, w]
                over = own < up[:, w]
                own += carry
                carry = (over | (own < carry)).astype(np.uint64)
                total[:, w] = own
        diagonal = ((total ^ up) | match | down) & full
        right_up = (down | ~(diagonal | up)) & full
        right_down = diagonal & up
        # Along the lowest diagonal, then along the last row.
        if j < inner:
            value += (diagonal[:, -1] & lowest) == 0
        else:
            last = j + band - m
            at = np.clip(width - 2 - last, 0, width - 1)
            bit, own = one << (at % 64).astype(np.uint64), at // 64
            each = np.arange(len(at))
            along = ((right_up[each, own] & bit) != 0).astype(np.int64) - ((right_down[each, own] & bit) != 0)
            value += np.where(last < 0, (diagonal[:, -1] & lowest) == 0, along)
        shifted = diagonal >> one
        if words > 1:
            shifted[:, :-1] |= diagonal[:, 1:] << last_bit
        up, down = (right_down | ~(shifted | right_up)) & full, shifted & right_up
        if j + 1 in ends:
            done = n == j + 1
            result[live[done]] = value[done] <= limit[done]
        if j % 16 == 15:
            keep = (n > j + 1) & (value <= limit + band + 1)
            if not keep.any():
                break
            if keep.sum() < len(keep) * 7 // 8:
                live, rows, cols, m, n, limit, up, down, value = (x[keep] for x in (live, rows, cols, m, n, limit, up, down, value))
                inner = int(m.min()) - band
    return result


def row_key(doc_id: Column, text: Column) -> Column:
    """What tells rows apart: a hash of id and text, each of which may be null."""
    return F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text)


def _plain(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    one, other = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    return docs.select(one.alias("doc_id"), row_key(one, other).alias("row"), other.alias("text"))


def occurrences(plain: DataFrame, edits: tuple = EDITS) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, at in B.text_chunks(batch.column(2)):
                lines = Lines(data, at, edits)
                ids, rows = (batch.column(i).take(pa.array(lines.row + row)) for i in (0, 1))
                arrays = [ids, rows, pa.array(lines.number), pa.array(lines.id), pa.array(lines.size)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "row", "line_no", "line_id", "size"])

    return plain.mapInArrow(find, OCCURRENCES)


# -- packed blocks of keys -------------------------------------------------------------------------


def pack(key: np.ndarray, line: np.ndarray, indexed: np.ndarray) -> bytes:
    """Sorted keys with the prints of their lines, as deltas whose low bytes are kept as they are."""
    step = np.diff(key, prepend=np.uint64(0))
    mean = int(key[-1] // np.uint64(len(key))) if len(key) else 0
    low = 1 if mean < 1 << 13 else 2 if mean < 1 << 21 else 4
    rest = zlib.compress(_smallest(step >> np.uint64(8 * low)), 1)
    raw = (step & np.uint64((1 << 8 * low) - 1)).astype(f"<u{low}")
    head = struct.pack("<qBBq", len(key), low, int(_width(step >> np.uint64(8 * low))), len(rest))
    prints = line.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : PRINT // 8]
    return b"".join([head, rest, raw.tobytes(), prints.tobytes(), np.packbits(indexed).tobytes()])


def _width(x: np.ndarray) -> int:
    return np.min_scalar_type(int(x.max(initial=0))).itemsize


def _smallest(x: np.ndarray) -> bytes:
    return x.astype(f"<u{_width(x)}").tobytes()


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, low, high, size = struct.unpack_from("<qBBq", block)
    at = struct.calcsize("<qBBq")
    step = np.frombuffer(zlib.decompress(block[at : at + size]), dtype=f"<u{high}").astype(np.uint64) << np.uint64(8 * low)
    at += size
    step |= np.frombuffer(block, dtype=f"<u{low}", count=n, offset=at)
    width = PRINT // 8
    line = np.zeros((n, 4), dtype=np.uint8)
    line[:, :width] = np.frombuffer(block, dtype=np.uint8, count=n * width, offset=at + n * low).reshape(n, width)
    indexed = np.unpackbits(np.frombuffer(block, dtype=np.uint8, offset=at + n * (low + width)), count=n).astype(bool)
    return np.cumsum(step, dtype=np.uint64), line.view("<u4").reshape(-1), indexed


def _prints(ids: np.ndarray) -> np.ndarray:
    return (ids.view(np.uint64) >> np.uint64(64 - PRINT)).astype(np.uint32)


def _in_order(key: np.ndarray, line: np.ndarray, indexed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By key, line, and the index first; as one word each where ``bits`` of key leave room for the others."""
    if bits + PRINT + 1 <= 64:
        word = key << np.uint64(PRINT + 1)
        word |= line.astype(np.uint64) << np.uint64(1)
        word |= (~indexed).astype(np.uint64)
        word.sort()
        return word >> np.uint64(PRINT + 1), (word >> np.uint64(1)).astype(np.uint32) & np.uint32((1 << PRINT) - 1), (word & np.uint64(1)) == 0
    order = np.lexsort((~indexed, line, key))
    return key[order], line[order], indexed[order]


def key_blocks(plain: DataFrame, edits: tuple, bits: int, shard_bits: int) -> DataFrame:
    """``BLOCKS``: keys by range of their top bits ("keys"), and what each run of lines has: ids, sizes, parities ("lines")."""

    def send(held: list[tuple], known: list[np.ndarray], about: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate(known)
        chunk = int.from_bytes(hashlib.sha256(ids.tobytes()).digest()[:8], "little", signed=True)
        rows = [(chunk & (1 << shard_bits) - 1, chunk, "lines", np.column_stack([ids, np.concatenate(about)]).tobytes())]
        key, line, indexed = (np.concatenate(x) for x in zip(*held, strict=True))
        key, line, indexed = _in_order(key, line, indexed, bits)
        cut = np.searchsorted(key, np.arange(1, 1 << shard_bits).astype(np.uint64) << np.uint64(bits - shard_bits))
        for shard, (lo, hi) in enumerate(zip([0, *cut.tolist()], [*cut.tolist(), len(key)], strict=True)):
            if hi > lo:
                base = np.uint64(shard) << np.uint64(bits - shard_bits)
                rows.append((shard, chunk, "keys", pack(key[lo:hi] - base, line[lo:hi], indexed[lo:hi])))
        for row in rows:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int64(), pa.string(), pa.binary()), strict=True)], names=["shard", "chunk", "kind", "block"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known, about, n = [], [], [], 0
        for batch in batches:
            for _, _, data, at in B.text_chunks(batch.column(0)):
                lines = Lines(data, at, edits)
                ids = np.concatenate(known) if known else None
                key, place, indexed = entries(lines, edits, ids)
                held.append((key >> np.uint64(64 - bits), _prints(lines.id[place]), indexed))
                new = np.unique(place)
                known.append(lines.id[new])
                about.append(lines.about(new))
                n += len(key)
                if n >= HELD_KEYS:
                    yield from send(held, known, about)
                    held, known, about, n = [], [], [], 0
        if n:
            yield from send(held, known, about)

    return plain.select("text").mapInArrow(find, BLOCKS)


def shared_keys(blocks: DataFrame, bits: int, shard_bits: int) -> DataFrame:
    """``SHARED`` and the lines' parities: rows of the keys that different lines share, one of them in the index; and each run's lines."""
    schema = f"{SHARED}, size long, bits array<long>"
    names = [f.split()[0] for f in schema.split(", ")]
    words = BITS // 64

    def meet(shard: int, held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        parts = [unpack(block) for _, block in held]
        key, line, indexed = _in_order(*(np.concatenate([p[i] for p in parts]) for i in range(3)), bits - shard_bits)
        one = np.ones(len(key), dtype=bool)  # of copies of a line, and of its own keys that are alike, the first
        one[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
        key, indexed = key[one], indexed[one]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(first, len(key)))
        wanted = key[first[(size > 1) & np.logical_or.reduceat(indexed, first)]]
        for (chunk, _), (key, line, indexed) in zip(held, parts, strict=True):
            yield from rows_of(shard, chunk, wanted, key, line, indexed)

    def rows_of(shard: int, chunk: int, wanted: np.ndarray, key: np.ndarray, line: np.ndarray, indexed: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The rows of a block whose keys are ``wanted``; both are sorted."""
        first, last = np.searchsorted(key, wanted, "left"), np.searchsorted(key, wanted, "right")
        count = last - first
        at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        bucket = (key[at] + (np.uint64(shard) << np.uint64(bits - shard_bits))).view(np.int64)
        n = len(at)
        if n:
            empty = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.full(n, chunk)), pa.array(line[at].astype(np.int64)), pa.array(indexed[at]), *empty], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for shard, chunk, kind, block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if kind == "lines":
                    table = np.frombuffer(block, dtype=np.int64).reshape(-1, 2 + words)
                    n = len(table)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * words + 1, words, dtype=np.int32)), pa.array(np.ascontiguousarray(table[:, 2:]).reshape(-1)))
                    arrays = [pa.nulls(n, pa.int64()), pa.array(np.full(n, chunk)), pa.array(_prints(np.ascontiguousarray(table[:, 0])).astype(np.int64)), pa.nulls(n, pa.bool_()), pa.array(table[:, 0]), pa.array(table[:, 1]), lists]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                    continue
                if shard != at and held:
                    yield from meet(at, held)
                    held = []
                at = shard
                held.append((chunk, block))
        if held:
            yield from meet(at, held)

    return blocks.repartition(1 << shard_bits, "shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def _texts(plain: DataFrame, edits: tuple) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, at in B.text_chunks(batch.column(0)):
                lines = Lines(data, at, edits)
                one = np.unique(lines.id, return_index=True)[1]
                one = one[lines.size[one] >= edits[0][0]]
                yield pa.RecordBatch.from_arrays([pa.array(lines.id[one]), pa.array([lines.text(i) for i in one], pa.string())], names=["id", "line"])

    return plain.select("text").mapInArrow(find, "id long, line string")


def close_enough(edits: tuple):
    """A condition that every linked pair meets: an edit changes the length by one and ``GRAM`` grams into others at most."""

    def close(a: str, b: str) -> Column:
        differ = F.lit(0)
        for i in range(BITS // 64):
            differ = differ + F.bit_count(F.get(f"{a}bits", F.lit(i)).bitwiseXOR(F.get(f"{b}bits", F.lit(i))))
        limit = allowed_column(F.least(f"{a}size", f"{b}size"), edits)
        return (F.abs(F.col(f"{a}size") - F.col(f"{b}size")) <= limit) & (differ <= 2 * GRAM * limit)

    return close


def holder(edits: tuple):
    """Which pairs of rows (``size``, ``bits``, ``line``) are links: by ``close_enough``, then by their edits."""

    def hold(table: pa.Table, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        size = table.column("size").to_numpy()
        bits = table.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, BITS // 64)  # bits of signed words are counted without their sign
        lines = table.column("line").to_pylist()
        limits = allowed(np.minimum(size[i], size[j]), edits)
        some = np.flatnonzero(np.abs(size[i] - size[j]) <= limits)
        some = some[np.bitwise_count(bits[i[some]] ^ bits[j[some]]).sum(axis=1) <= 2 * GRAM * limits[some]]
        out = np.zeros(len(i), dtype=bool)
        out[some] = all_within([(lines[x], lines[y]) for x, y in zip(i[some].tolist(), j[some].tolist(), strict=True)], limits[some])
        return out

    return hold


def _verifier(texts: DataFrame, edits: tuple):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True))
            limits = allowed(np.array([min(len(x), len(y)) for x, y in texts], dtype=np.int64), edits)
            mask = pa.array(all_within(texts, limits), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(texts.toDF("a", "line_a"), "a").join(texts.toDF("b", "line_b"), "b")
        return both.select("a", "b", "line_a", "line_b").mapInArrow(check, "a long, b long")

    return verify


def line_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: tuple = EDITS) -> DataFrame:
    """A row per judged line: doc_id, row (``row_key``), line_no (from 0), line_id, and the first line of its class:
    class_doc_id, class_row, class_line_no; ``kept`` where it is the first itself."""
    spark, plain = docs.sparkSession, _plain(docs, doc_id, text)
    with passing(spark):
        found = stored(occurrences(plain, edits), "lines")
        judged = found.where(F.col("size") >= edits[0][0]).agg(F.sum("size")).first()[0] or 0
        keys = judged // 3 + 1  # about as many as there are
        bits = min(62, max(30, keys.bit_length() + SPARE_BITS))
        ranges = min(RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), keys * 6 // RANGE_BYTES))
        shard_bits = max(1, (ranges - 1).bit_length())
        shared = stored(shared_keys(key_blocks(plain, edits, bits, shard_bits), bits, shard_bits), "shared")
        rows = shared.where("bucket is not null").select("bucket", "chunk", "print", "pivot")
        about = shared.where("bucket is null").select("chunk", "print", "id", "size", "bits")
        members = rows.join(about.select("chunk", "print", "id"), ["chunk", "print"]).groupBy("bucket", "id").agg(F.max("pivot").alias("pivot"))
        members = sized(members)
        labels = None
        if not members.isEmpty():
            home = homes(members)
            texts = _texts(plain, edits)
            texts = stored(texts.join(sent(home.select("id")), "id", "left_semi").dropDuplicates(["id"]), "texts")
            known = about.dropDuplicates(["id"]).select("id", "size", "bits").join(home.select("id"), "id", "left_semi")
            labels = classes_by_home(members, home, stored(known, "parities"), _verifier(texts, edits), close_enough(edits), texts, holder(edits))
        classed = found.withColumn("class_id", F.col("line_id"))
        if labels is not None:
            classed = found.join(labels.toDF("line_id", "__class"), "line_id", "left").withColumn("class_id", F.coalesce("__class", "line_id")).drop("__class")
        classed = stored(classed, "classed", keep=True)
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row", "line_no")
    first = stored(classed.groupBy("class_id").agg(F.min(order).alias("first")), "first")
    out = classed.join(first, "class_id").select(
        "doc_id", "row", "line_no", "line_id", *[F.col(f"first.{c}").alias(f"class_{c}") for c in ("doc_id", "row", "line_no")]
    )
    return out.withColumn("kept", (F.col("row") == F.col("class_row")) & (F.col("line_no") == F.col("class_line_no")))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: tuple = EDITS) -> DataFrame:
    """``docs`` with texts that keep the first line of each class only.

    A document of which nothing but white space is left is a copy of others, and goes; one that had
    nothing else before stays.
    """
    gone = line_classes(docs, doc_id, text, edits).where("not kept").groupBy(F.col("row").alias("__row")).agg(F.collect_set("line_no").alias("__gone"))
    joined = docs.join(gone, row_key(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")) == F.col("__row"), "left")
    lines = F.split(F.col(f"`{text}`"), "\n", -1)
    numbered = F.transform(lines, lambda line, i: F.when(~F.array_contains("__gone", i.cast("long")), line))
    left = F.when(F.col("__gone").isNull(), F.col(f"`{text}`")).otherwise(F.array_join(F.array_compact(numbered), "\n"))
    cut = joined.withColumn("__left", left).where("__gone is null or __left rlike '[^\\\\s]'")
    return cut.select(*[F.col("__left").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
