"""Chat formatting by columnar byte assembly (operator 9).

A conversation becomes ``<|im_start|>role NEWLINE text<|im_end|>NEWLINE`` for each turn, in the order of
turns. For a run of turns the lengths of all pieces give their offsets by a cumulative sum; marks,
roles and texts are then copied with index arrays into one buffer, which becomes the Arrow column as
it is. The loss mask is a list of byte spans, one for each assistant text, without its marks.

Texts can't forge marks: ``<|`` inside a text is written ``<\\|``, and a run of backslashes between the
two gets one more, so it can be undone. Roles have backslashes and line breaks escaped as well.

A conversation comes back as rows of consecutive whole turns (``part`` 0, 1, ...), one unless it is
long, so that no conversation has to fit into memory.

Defined results: null texts and roles count as empty; turns of one number are ordered by role and text,
null turns come first; a null conv_id is a conversation of its own; repeated rows are repeated turns;
other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemaque.llm import buffers as B

START, END, LEARNT = "<|im_start|>", "<|im_end|>", "assistant"

FORMATTED = "conv_id long, part int, n_turns int, text string, loss array<struct<start: long, end: long>>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\1\\|")


def unescape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<\\(\\*)\|", r"<\1|")


def escape_roles(roles: pa.Array) -> pa.Array:
    return escape(pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n"))


def unescape_role(role: str) -> str:
    plain, i = unescape(pa.array([role]))[0].as_py(), 0
    out = []
    while i < len(plain):
        if plain[i] == "\\":
            out.append("\n" if plain[i + 1] == "n" else plain[i + 1])
            i += 2
        else:
            out.append(plain[i])
            i += 1
    return "".join(out)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the offsets of its values in them."""
    runs = list(B.text_chunks(column, 1 << 62))
    return (runs[0][2], runs[0][3]) if runs else (np.zeros(0, np.uint8), np.zeros(1, np.int64))


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets by turn, start and end of each turn's text) of the formatted turns."""
    role, role_at = _bytes(escape_roles(roles.fill_null("")))
    text, text_at = _bytes(escape(texts.fill_null("")))
    start, end = (np.frombuffer(x.encode(), np.uint8) for x in (START, END + "\n"))
    n = len(roles)
    role_size, text_size = np.diff(role_at), np.diff(text_at)
    offsets = np.append(0, np.cumsum(len(start) + role_size + 1 + text_size + len(end)))
    out = np.empty(offsets[-1], dtype=np.uint8)
    role_to = offsets[:-1] + len(start)
    text_to = role_to + role_size + 1
    end_to = text_to + text_size
    out[offsets[:-1, None] + np.arange(len(start))] = start
    out[np.arange(len(role)) + np.repeat(role_to - role_at[:-1], role_size)] = role
    out[text_to - 1] = 10
    out[np.arange(len(text)) + np.repeat(text_to - text_at[:-1], text_size)] = text
    out[end_to[:, None] + np.arange(len(end))] = end
    return out, offsets, np.stack([text_to, end_to], axis=1).reshape(n, 2)


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learnt: str = LEARNT
) -> DataFrame:
    """Rows of ``FORMATTED``; the parts of a conversation follow one another within a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = (), 0  # the conversation of the row before
        for batch in batches:
            for row, stop, _, _ in B.text_chunks(batch.column(2)):
                ids = batch.column(0).slice(row, stop - row).to_pylist()
                roles, texts = (batch.column(i).slice(row, stop - row) for i in (1, 2))
                data, at, spans = assemble(roles, texts)
                first = [i for i in range(len(ids)) if i == 0 or ids[i] != ids[i - 1]]
                bounds = np.array([*first, len(ids)])
                parts = []
                for i in first:
                    part = part + 1 if held == (ids[i],) else 0
                    held = (ids[i],)
                    parts.append(part)
                learn = pc.fill_null(pc.equal(roles, learnt), False).to_numpy(zero_copy_only=False)
                before = np.append(0, np.cumsum(learn))[bounds]
                of_part = np.repeat(np.arange(len(first)), np.diff(bounds))
                local = (spans - at[bounds[:-1]][of_part][:, None])[learn]
                loss = pa.ListArray.from_arrays(
                    pa.array(before.astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(local[:, 0]), pa.array(local[:, 1])], ["start", "end"]),
                )
                text_column = pa.StringArray.from_buffers(
                    len(first), pa.py_buffer(at[bounds].astype(np.int32)), pa.py_buffer(data)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[i] for i in first], pa.int64()),
                        pa.array(parts, pa.int32()),
                        pa.array(np.diff(bounds).astype(np.int32)),
                        text_column,
                        loss,
                    ],
                    names=["conv_id", "part", "n_turns", "text", "loss"],
                )

    names = {"conv_id": F.col(f"`{conv_id}`").cast("long"), "turn": F.col(f"`{turn}`"), "role": F.col(f"`{role}`"), "text": F.col(f"`{text}`")}
    plain = turns.select(*[c.alias(k) for k, c in names.items()])
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    if not text:
        return []
    pieces = text.split(START)[1:]
    heads = [p.split("\n", 1) for p in pieces]
    bodies = unescape(pa.array([body[: -len(END) - 1] for _, body in heads], pa.string())).to_pylist()
    return [(unescape_role(head), body) for (head, _), body in zip(heads, bodies, strict=True)]


def read_back(formatted: DataFrame) -> DataFrame:
    """A row per conversation of ``format_chats``'s output, read from its bytes: ``DIGESTS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None

        def done(rows: list) -> pa.RecordBatch:
            columns = zip(*[(r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5]) for r in rows], strict=True)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            ready = []
            for conv, part, text, loss in zip(*[batch.column(i).to_pylist() for i in (0, 1, 3, 4)], strict=True):
                if part == 0:
                    if held is not None:
                        ready.append(held)
                    held = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parse(text):
                    held[1] += 1
                    held[2].update(f"{role}\n{body}\n".encode())
                raw = text.encode()
                learnt = unescape(pa.array([raw[s["start"] : s["end"]].decode() for s in loss], pa.string()))
                for body in learnt.to_pylist():
                    held[3] += len(body)
                    held[4].update(body.encode())
                held[5] += len(text)
            if ready:
                yield done(ready)
        if held is not None:
            yield done([held])

    return formatted.mapInArrow(run, DIGESTS)
