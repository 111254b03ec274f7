"""Secret scans with a recursive decoding worklist (operator 13).

A text is searched for assigned secrets, access keys and long hex runs. Then its encodings are undone:
a worklist starts with the text as its first layer, and every layer taken from it yields further ones:

* itself with all percent escapes decoded,
* itself with all Unicode escapes decoded (``\\uXXXX``, ``\\u{X}``, ``\\UXXXXXXXX``, ``\\xXX``, ``&#N;``, ``&#xN;``),
* what each run of base64 (either alphabet, also over wrapped lines) stands for,
* and, where decoded bytes are gzip, zlib, bzip2 or xz data, what these unpack to.

Every layer is searched like the text itself. It carries, for each of its characters, the span of the text
that the character came from, so a finding in any layer is reported as a span of the text. A layer that was
met before (same characters from the same place) is not taken again: that ends data that unpack to
themselves, and the worklist runs until it is empty. Escapes and base64 only ever get shorter. Escapes inside
escapes are undone one layer at a time, those nested deeper than ``DEEP`` layers all at once.

Spans are in code points, the end exclusive. A found span keeps the kind of what was found in the layer.

Defined results: a null text counts as empty and has no findings; other columns are ignored; a row comes
back for each row, whatever its id; bytes that are no UTF-8 are no base64 text, and replacement characters
inside percent escapes. Data that unpack to more than ``most`` bytes (16 MB for each text, unless the caller
says otherwise) are left packed and counted in ``n_unread``.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemaque.llm import buffers as B

# The kinds of the contract, in its order, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
ASSIGNED, HEX_RUN = 8, 32  # least lengths

#: Least length of a run that is tried as base64, and of the lines of a wrapped one.
BASE64_RUN, BASE64_LINE = 16, 60
MOST = 1 << 24
#: Layers of escapes that are undone one by one.
DEEP = 16

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});"
)
# How packed data begin.
MAGIC = ((b"\x1f\x8b\x08", "gzip"), (b"BZh", "bzip2"), (b"\xfd7zXZ\x00", "xz"), (b"\x78\x01", "zlib"), (b"\x78\x5e", "zlib"), (b"\x78\x9c", "zlib"), (b"\x78\xda", "zlib"))

_HEX = np.zeros(256, dtype=bool)
_HEX[[*b"0123456789abcdef"]] = True
_BASE64 = np.zeros(256, dtype=bool)
_BASE64[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True

RESULT = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_spans long, n_decoded long, n_layers long, n_unread long"
)

Span = tuple[int, int, int]  # start, end, kind


class TooLarge(Exception):
    """Packed data have more bytes than may be unpacked."""


def long_runs(member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``least`` or more true entries."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], member, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    wide = end - start >= least
    return start[wide], end[wide]


def findings(text: str) -> list[Span]:
    """The secrets of one layer, leftmost and without overlaps for each kind."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= ASSIGNED]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found += [(a, b, 2) for a, b in zip(*(x.tolist() for x in long_runs(_HEX[np.minimum(codes, 255)], HEX_RUN)), strict=True)]
    return sorted(found)


@dataclass
class Layer:
    """Characters, and where in the text each of them came from."""

    text: str
    start: np.ndarray
    end: np.ndarray
    depth: int = 0

    @classmethod
    def whole(cls, text: str) -> Layer:
        at = np.arange(len(text), dtype=np.int32)
        return cls(text, at, at + 1)

    def key(self) -> tuple:
        content = hashlib.sha256(self.text.encode("utf-8", "surrogatepass")).digest()
        return content, int(self.start[0]), int(self.end[-1]), len(self.text)

    def origin(self, lo: int, hi: int) -> tuple[int, int]:
        return int(self.start[lo:hi].min()), int(self.end[lo:hi].max())


def _replaced(layer: Layer, parts: list[tuple[int, int, str, np.ndarray, np.ndarray]]) -> Layer:
    """``layer`` with the characters of each (from, to) replaced by others of given origins."""
    texts, starts, ends, at = [], [], [], 0
    for lo, hi, text, start, end in parts:
        texts += [layer.text[at:lo], text]
        starts += [layer.start[at:lo], start]
        ends += [layer.end[at:lo], end]
        at = hi
    texts.append(layer.text[at:])
    start, end = np.concatenate([*starts, layer.start[at:]]), np.concatenate([*ends, layer.end[at:]])
    return Layer("".join(texts), start, end, layer.depth + 1)


def _characters(data: bytes) -> tuple[str, np.ndarray, np.ndarray]:
    """The text of ``data``, with the first byte and the byte after each character."""
    text = data.decode("utf-8", "replace")
    if "\ufffd" not in text:
        lead = np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
        return text, lead, np.append(lead[1:], len(data))
    pieces, starts, ends, at = [], [], [], 0
    while at < len(data):
        for width in range(1, 5):
            try:
                pieces.append(data[at : at + width].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            width = 1
            pieces.append("\ufffd")
        starts.append(at)
        at = min(at + width, len(data))
        ends.append(at)
    return "".join(pieces), np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)


def without_percents(layer: Layer) -> Layer | None:
    """``layer`` with percent escapes decoded; None where it has none."""
    if "%" not in layer.text:
        return None
    parts = []
    for m in PERCENT.finditer(layer.text):
        text, first, after = _characters(bytes.fromhex(m.group().replace("%", "")))
        parts.append((m.start(), m.end(), text, layer.start[m.start() + 3 * first], layer.end[m.start() + 3 * after - 1]))
    return _replaced(layer, parts) if parts else None


def without_escapes(layer: Layer) -> Layer | None:
    """``layer`` with Unicode escapes decoded, surrogate pairs as one character; None where it has none."""
    if "\\" not in layer.text and "&#" not in layer.text:
        return None
    codes: list[tuple[int, int, int]] = []
    for m in ESCAPE.finditer(layer.text):
        decimal = m.group(5)
        code = int(decimal) if decimal else int(next(g for g in m.groups() if g), 16)
        if codes and codes[-1][1] == m.start() and 0xD800 <= codes[-1][2] < 0xDC00 <= code < 0xE000:
            lo, _, high = codes.pop()
            codes.append((lo, m.end(), 0x10000 + ((high - 0xD800) << 10) + (code - 0xDC00)))
        elif code <= 0x10FFFF:
            codes.append((m.start(), m.end(), code))
    parts = []
    for lo, hi, code in codes:
        if not 0xD800 <= code < 0xE000:
            start, end = layer.origin(lo, hi)
            parts.append((lo, hi, chr(code), np.array([start]), np.array([end])))
    return _replaced(layer, parts) if parts else None


def settled(layer: Layer) -> Layer | None:
    """``layer`` with all escapes of ASCII characters decoded, also those that decoding brings about; None if none."""
    out: list[str] = []
    start, end = layer.start.tolist(), layer.end.tolist()
    kept: list[tuple[int, int]] = []
    changed = False
    for c, span in zip(layer.text, zip(start, end, strict=True), strict=True):
        out.append(c)
        kept.append(span)
        while out[-1] in _LAST and (m := _TAIL.search("".join(out[-12:]))):
            decimal = m.group(6)
            code = int(decimal) if decimal else int(next(g for g in m.groups() if g), 16)
            if code > 127:
                break
            n = m.end() - m.start()
            merged = min(a for a, _ in kept[-n:]), max(b for _, b in kept[-n:])
            del out[-n:], kept[-n:]
            out.append(chr(code))
            kept.append(merged)
            changed = True
    if not changed:
        return None
    spans = np.array(kept, dtype=layer.start.dtype)
    return Layer("".join(out), spans[:, 0], spans[:, 1], layer.depth + 1)


_LAST = frozenset("0123456789abcdefABCDEF};")
_TAIL = re.compile(rf"(?:%([0-9A-Fa-f]{{2}})|{ESCAPE.pattern})\Z")


def unpacked(data: bytes, most: int) -> bytes | None:
    """What gzip, zlib, bzip2 or xz ``data`` hold; None where they are none of these, or damaged from the start."""
    kind = next((k for magic, k in MAGIC if data.startswith(magic)), None)
    if kind is None:
        return None
    make = {"gzip": lambda: zlib.decompressobj(31), "zlib": zlib.decompressobj, "bzip2": bz2.BZ2Decompressor, "xz": lzma.LZMADecompressor}[kind]
    out, rest = [], data
    size = 0
    try:
        while rest:
            step = make()
            part = step.decompress(rest, most + 1 - size)
            size += len(part)
            if size > most:
                raise TooLarge
            out.append(part)
            rest = step.unused_data if step.eof else b""  # a further member, or a cut-off end
            if rest and not any(rest.startswith(magic) for magic, k in MAGIC if k == kind):
                break
    except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
        if not size:
            return None
    return b"".join(out)


def readable(data: bytes) -> str | None:
    """``data`` as a text without control characters, else None."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return text if text and not re.search(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", text) else None


def _debased(run: str) -> bytes | None:
    body = re.sub(r"[\r\n]", "", run).rstrip("=").translate(str.maketrans("-_", "+/"))
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


class Scan:
    """The worklist of one text."""

    def __init__(self, text: str, most: int = MOST):
        self.base = findings(text)
        self.spans = set(self.base)
        self.decoded = self.unread = 0
        self.left = most
        self.met: set[tuple] = set()
        self.opened: set[tuple] = set()
        self.work = [Layer.whole(text)] if text else []
        while self.work:
            layer = self.work.pop()
            self.decoded += self.search(layer)
            steps = (without_percents, without_escapes) if layer.depth < DEEP else (settled,)
            for made in (step(layer) for step in steps):
                if made is not None:
                    self.add(made)
            self.open_runs(layer)

    def add(self, layer: Layer) -> None:
        if layer.text and (key := layer.key()) not in self.met:
            self.met.add(key)
            self.work.append(layer)

    def search(self, layer: Layer) -> int:
        """Takes in what ``layer`` shows; the number of spans that are new."""
        before = len(self.spans)
        if self.met:  # the first layer is the text, which has been searched
            self.spans.update((*layer.origin(lo, hi), kind) for lo, hi, kind in findings(layer.text))
        return len(self.spans) - before

    def open_runs(self, layer: Layer) -> None:
        """Layers from runs of base64, and from packed data behind these or behind percent escapes."""
        self.met.add(layer.key())
        text = layer.text
        for m in PERCENT_DATA.finditer(text) if "%" in text else ():
            data = _percent_bytes(m.group())
            if any(data.startswith(magic) for magic, _ in MAGIC):
                self.inside(layer, m.start(), m.end(), data)
        for lo, hi in wrapped_runs(text) if "\n" in text else ():
            if (data := _debased(text[lo:hi])) is not None:
                self.inside(layer, lo, hi, data)
        for lo, hi in zip(*base64_runs(text), strict=True):
            if (data := _debased(text[lo:hi])) is not None:
                self.inside(layer, lo, hi, data)

    def inside(self, layer: Layer, lo: int, hi: int, data: bytes) -> bool:
        """Adds the text that ``data`` from the characters ``lo`` to ``hi`` are, or unpack to; whether there is one."""
        source = hashlib.sha256(data).digest(), *layer.origin(lo, hi)
        if source in self.opened:
            return True
        self.opened.add(source)
        packed = False
        seen: set[bytes] = set()
        while True:
            try:
                more = unpacked(data, self.left)
            except TooLarge:
                self.unread += 1
                return False
            if more is None:
                break
            self.left -= len(more)
            packed = True
            if (digest := hashlib.sha256(more).digest()) in seen:
                return False  # data that unpack to themselves
            seen.add(digest)
            data = more
        text = readable(data)
        if text is None:
            return False
        if packed:
            start, end = layer.origin(lo, hi)
            at = (np.broadcast_to(np.array(x, dtype=layer.start.dtype), len(text)) for x in (start, end))
            self.add(Layer(text, *at, layer.depth))
            return True
        # Byte i comes from two of the characters of its group of four; line breaks belong to no group.
        places = np.flatnonzero([c not in "\r\n=" for c in layer.text[lo:hi]]) + lo
        _, first, after = _characters(data)
        last = after - 1
        begin, stop = places[first // 3 * 4 + first % 3], places[last // 3 * 4 + last % 3 + 1]
        self.add(Layer(text, layer.start[begin], layer.end[stop], layer.depth))
        return True


#: Packed data as a percent-encoded run: the bytes that need no escape stand for themselves.
PERCENT_DATA = re.compile(r"(?:%1[fF]%8[bB]|BZh|%[fF][dD]7zXZ|x%(?:01|9[cC]|[dD][aA])|x%5[eE]|x\^|%78%(?:01|5[eE]|9[cC]|[dD][aA]))[!-~]*")


def _percent_bytes(text: str) -> bytes:
    return re.sub(rb"%([0-9A-Fa-f]{2})", lambda m: bytes.fromhex(m.group(1).decode()), text.encode())


def _base64_members(text: str) -> np.ndarray:
    return _BASE64[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), 255)]


def _padded(text: str, end: int) -> int:
    """``end`` with the padding behind it."""
    hi = end
    while hi < len(text) and hi - end < 2 and text[hi] == "=":
        hi += 1
    return hi


def base64_runs(text: str) -> tuple[list[int], list[int]]:
    """Starts and ends of the maximal runs of the base64 alphabets, with the padding behind."""
    start, end = (x.tolist() for x in long_runs(_base64_members(text), BASE64_RUN))
    return start, [_padded(text, hi) for hi in end]


def wrapped_runs(text: str) -> list[tuple[int, int]]:
    """Starts and ends of base64 over several lines, all but the last of them long."""
    start, end = long_runs(_base64_members(text), 1)
    out, i = [], 0
    for first in np.flatnonzero(end - start >= BASE64_LINE).tolist():
        if first < i:
            continue
        i = first
        while i + 1 < len(start) and end[i] - start[i] >= BASE64_LINE and text[end[i] : start[i + 1]] in ("\n", "\r\n"):
            i += 1
        if i > first:
            out.append((int(start[first]), _padded(text, int(end[i]))))
        i += 1
    return out


def listed(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


_ANY = re.compile(rb"password|passwd|secret|token|api_?key|AKIA|%[0-9a-f]{2}|\\[uUx]|&#|BZh", re.IGNORECASE)


def suspects(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each text of a run can have a finding in any layer: all others need no Python."""
    out = np.zeros(len(at) - 1, dtype=bool)
    for member, least in ((_HEX, HEX_RUN), (_BASE64, BASE64_RUN)):
        start, end = long_runs(member[data], least)
        # A run may go over the end of a text: whoever holds a part of it is looked at.
        lo, hi = np.searchsorted(at, start, "right") - 1, np.searchsorted(at, end - 1, "right") - 1
        for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
            out[a : b + 1] = True
    hits = np.array([m.start() for m in _ANY.finditer(data)], dtype=np.int64)
    out[np.searchsorted(at, hits, "right") - 1] = True
    return out


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """A row per row of ``docs`` with the columns of ``RESULT``: the numbers and the digest are those of the
    text's own findings, ``spans`` holds those of all layers, ``n_decoded`` of them only in decoded ones."""
    nothing = hashlib.sha256(b"").hexdigest()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, at in B.text_chunks(batch.column(1)):
                rows: list[tuple] = [(0, 0, 0, nothing, "", 0, 0, 1, 0)] * (stop - row)
                for i in np.flatnonzero(suspects(data, at)).tolist():
                    one = Scan(data[at[i] : at[i + 1]].tobytes().decode("utf-8", "replace"), most)
                    n = [sum(kind == k for *_, kind in one.base) for k in range(len(KINDS))]
                    digest = hashlib.sha256(listed(one.base).encode()).hexdigest()
                    rows[i] = (*n, digest, listed(one.spans), len(one.spans), one.decoded, max(1, len(one.met)), one.unread)
                columns = zip(*rows, strict=True)
                types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 4
                arrays = [batch.column(0).slice(row, stop - row), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in RESULT.split(", ")])

    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return plain.mapInArrow(scan, RESULT)
