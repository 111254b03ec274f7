"""WARC archives of pages, and their capture index by external merge (operator 5).

Pages are written as gzipped WARC records. Of pages with one payload the one with the largest id holds
it, the others are revisit records that refer to it. Reading an archive back gives its captures, which
are sorted by URL key and timestamp: a run per archive file. The runs are dealt out by ranges of (URL
key, timestamp, page) and merged in each range by a loser tree, so that the partitions in their order,
and the rows in theirs, are the capture histories of all URLs. Ranges cut through a busy URL too.

Archives go to the session's shared folder, under names no other attempt uses; the stored manifest
names those of the attempts that count. Pyarrow has to know the folder's file system.

Defined results: a null payload is empty, a null URL has the key ``""``; pages of one id and payload that
holds it are all responses; a null id is smaller than any; other columns are ignored; an empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemaque.llm.linking import stored
from telemaque.workspace import fresh_dir

SALTS = 16
FILE_BYTES = 1 << 30
#: The profile that the standard names for revisits of an equal payload. Fixed value.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "file string, records long, bytes long"
CAPTURES = (
    "urlkey string, timestamp string, page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, file string, offset long, length long"
)
KEY = ("urlkey", "timestamp", "page_id")


def url_key(url: str) -> str:
    """Host labels from the last to the first, then path and sorted query, in lower case."""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    if host.startswith("www."):
        host = host[4:]
    shown = "" if port in (None, 80, 443) else f":{port}"
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return ",".join(reversed(host.split("."))) + shown + ")" + (parts.path or "/") + (f"?{query}" if query else "")


def _record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str, when: datetime, payload: bytes, refers: dict | None) -> bytes:
    """One WARC record as a gzip member; ``refers``: page_id and url of the response, for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers else 'response'}",
        f"WARC-Record-ID: {_record_id(page)}",
        f"WARC-Date: {when:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]' + chr(39))}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if page is not None:
        head.append(f"X-Page-Id: {page}")
    if refers:  # only of a page with an id, since the holder has the largest
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {_record_id(refers['page_id'])}",
            f"X-Refers-To-Page-Id: {refers['page_id']}",
        ]
        if refers["url"] is not None:
            head.append(f"WARC-Refers-To-Target-URI: {quote(refers['url'], safe='%/:=&?~#+!$,;@()*[]' + chr(39))}")
    block = http if refers else http + payload
    head.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def with_originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, payload, ...) with ``refers``: the page that holds the same payload, or null."""
    hashed = pages.withColumn("__sha", F.sha1("payload"))
    own = F.struct("page_id", "url")
    holders = hashed.where(F.length("payload") >= least_bytes).groupBy("__sha").agg(F.max(own).alias("__holder"), F.count("*").alias("__n"))
    # Only shared payloads are joined; a payload that many pages have meets them in SALTS tasks.
    salted = stored(holders.where("__n > 1"), "holders").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = hashed.withColumn("__salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(salted, ["__sha", "__salt"], "left")
    refers = F.when(F.col("__holder.page_id") != F.col("page_id"), F.col("__holder"))
    return joined.withColumn("refers", refers).drop("__sha", "__salt", "__holder", "__n")


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, captured_at, payload, refers); returns the stored manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, records, size, done = None, "", 0, 0, []
        for batch in batches:
            for page, url, when, payload, refers in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}")
                member = record(page, url or "", when, payload or b"", refers)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    out = None
                    done.append((name, records, size))
        if out is not None:
            out.close()
            done.append((name, records, size))
        if done:
            columns = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["file", "records", "bytes"])

    return stored(pages.select("page_id", "url", "captured_at", "payload", "refers").mapInArrow(write, MANIFEST), "manifest")


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members of a file; one is held at a time."""
    offset, held = 0, b""
    while True:
        inflate, parts, used = zlib.decompressobj(31), [], 0
        while not inflate.eof:
            if not held:
                held = stream.read(1 << 20)
                if not held:
                    if used:
                        raise ValueError("the archive ends inside a record")
                    return
            parts.append(inflate.decompress(held))
            used += len(held) - len(inflate.unused_data)
            held = inflate.unused_data
        yield offset, used, b"".join(parts)
        offset += used


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def capture(name: str, offset: int, length: int, content: bytes) -> tuple:
    """The row of ``CAPTURES`` for one record."""
    head, _, block = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    if kind == "response":
        size, sha = len(payload), digest(payload)
    else:
        size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
        sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    refers = fields.get("X-Refers-To-Page-Id")
    when = datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ")
    url = fields["WARC-Target-URI"]
    key = url_key(url) if url else ""
    return key, f"{when:%Y%m%d%H%M%S}", _number(fields.get("X-Page-Id")), url, size, sha, kind, _number(refers), name, offset, length


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    names, types = zip(*[c.split() for c in CAPTURES.split(", ")], strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0


def runs(manifest: DataFrame, folder: str) -> DataFrame:
    """The captures of all archives, read back; those of one file are a sorted run."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{name}") as stream:
                    found = sorted((capture(name, *m) for m in members(stream)), key=_order)
                for i in range(0, len(found), 10_000):
                    yield _table(found[i : i + 10_000])

    # A task for each archive, which has a bounded size: the number is given, so that they are not put together again.
    files = manifest.select("file")
    return stored(files.repartition(max(1, files.count())).mapInArrow(read, CAPTURES), "runs")


def loser_tree(sources: list[Iterator], key: Callable = lambda x: x) -> Iterator:
    """The items of sorted ``sources`` in one order; equal ones in the order of the sources.

    Each inner node keeps the loser of its match, so an item that leaves costs one match per level.
    """
    n = len(sources)
    if not n:
        return
    heads: list = [next(s, None) for s in sources]
    keys = [None if h is None else key(h) for h in heads]

    def beats(a: int, b: int) -> bool:
        """Whether source a comes before source b; -1 stands for a source before all others."""
        if a < 0 or b < 0:
            return a < 0
        if keys[a] is None or keys[b] is None:
            return keys[a] is not None
        return (keys[a], a) < (keys[b], b)

    losers = [-1] * n

    def climb(i: int) -> int:
        winner, node = i, (i + n) // 2
        while node:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
        return winner

    for i in range(n - 1, -1, -1):
        losers[0] = climb(i)
    while keys[losers[0]] is not None:
        i = losers[0]
        yield heads[i]
        heads[i] = next(sources[i], None)
        keys[i] = None if heads[i] is None else key(heads[i])
        losers[0] = climb(i)


def merged(captures: DataFrame) -> DataFrame:
    """``captures`` (runs) in global order of ``KEY``: by partition, then by row."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = pa.Table.from_batches(batches, schema) if (batches := list(batches)) and (schema := batches[0].schema) else None
        if slices is None:
            return
        file = slices.column("file").combine_chunks()
        names = file.to_pylist()
        cuts = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]] + [len(names)]
        keys = [_order(k) for k in zip(*[slices.column(k).to_pylist() for k in KEY], strict=True)]
        sources = [iter(range(a, b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        order = pa.array(loser_tree(sources, keys.__getitem__), pa.int64())
        yield from slices.take(order).combine_chunks().to_batches(max_chunksize=10_000)

    # Slices of runs, put side by side; what a range holds is bounded by the number of ranges.
    dealt = captures.repartitionByRange(*KEY).sortWithinPartitions("file", *KEY, "offset")
    return dealt.mapInArrow(merge, CAPTURES)


def archive(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", captured_at: Column | None = None, least_bytes: int = 0
) -> DataFrame:
    """Writes pages to archives, reads these back and returns their captures in global order.

    ``payload`` is a text or binary column. ``captured_at``: a timestamp, the start of 2000 by default.
    """
    when = F.lit(datetime(2000, 1, 1, tzinfo=UTC)) if captured_at is None else captured_at
    plain = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        when.alias("captured_at"),
        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"),
    )
    folder = fresh_dir(pages.sparkSession, "warc")
    return merged(runs(write_archives(with_originals(plain, least_bytes), folder), folder))
