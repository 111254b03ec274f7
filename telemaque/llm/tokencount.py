"""Token counts by rank-synchronous merging (operator 4).

Counts the tokens of a byte-pair vocabulary that lower-cases, splits texts by a pattern and marks the
ends of words, without building tokens. Texts are split into pre-tokens; those that a task hasn't met
yet form one batch, held as a flat array of symbols with the pre-token of each. In every round each
pre-token applies its lowest-ranked pair everywhere at once, until no pair is left; the symbols that
survive are its tokens. What is kept between batches is bounded, and dropping it changes no count.

Defined results: a null text counts as empty, which has no tokens; repeated rows are counted row by
row; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemaque.llm import buffers as B
from telemaque.llm.vocabulary import byte_letters, load, tokenizer

MAX_TOKENS = 2048
#: Pre-tokens that a task remembers; a bound on memory only.
REMEMBERED = 400_000
#: Code points on which Unicode tables of different age may differ: those that have no character yet by either table
#: here, blocks that were filled late, and all beyond the first plane. A text with one of them is split by the library itself.
LATE_BLOCKS = ((0x1C80, 0x1C8F), (0xA7C0, 0xA7FF))


@cache
def unsettled() -> np.ndarray:
    """Whether each code point of the first plane is unsettled."""
    out = np.array([unicodedata.category(chr(c)) == "Cn" for c in range(1 << 16)])
    out |= np.array([regex.match(r"\p{Cn}", chr(c)) is not None for c in range(1 << 16)])
    for first, last in LATE_BLOCKS:
        out[first : last + 1] = True
    return out


def is_settled(text: str) -> bool:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return bool(codes.max() < 1 << 16) and not unsettled()[codes].any()

COUNTED = "doc_id long, n_bytes long, n_tokens long"


class Counter:
    """Token counts for one vocabulary file."""

    def __init__(self, path: str):
        file = load(path)
        model = file["model"]
        steps = [n["type"] for n in file["normalizer"]["normalizers"]]
        split, level = file["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or level["type"] != "ByteLevel" or level["use_regex"] or level["add_prefix_space"]:
            raise ValueError("a vocabulary of another kind")
        self.path = path
        self.pattern = regex.compile(split["pattern"]["Regex"])
        special = [t["content"] for t in file["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([vocab[letters[b] + end] for b in range(256)], dtype=np.int64)
        pairs = np.array([[vocab[a], vocab[b]] for a, b in model["merges"]], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in model["merges"]], dtype=np.int64)
        born = np.full(max(vocab.values()) + 1, -1)
        born[made] = np.arange(len(made))
        if (born[pairs].max(axis=1) >= np.arange(len(made))).any() or len(np.unique(made)) < len(made):
            raise ValueError("a pair is ranked before its parts: pairs can't be applied rank by rank")
        self.width = len(born)
        keys = pairs[:, 0] * self.width + pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order, made
        self.known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str]:
        if not text.isascii():
            if not is_settled(text):
                return self._by_library(text)
            text = unicodedata.normalize("NFC", text)
        lower = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        return self.pattern.findall(lower)

    def _by_library(self, text: str) -> list[str]:
        library = tokenizer(self.path)
        value = {c: b for b, c in byte_letters().items()}
        shown = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
        return [bytes(value[c] for c in piece).decode("utf-8", "surrogateescape") for piece, _ in shown]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        split, extra = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            split.append(self.pre_tokens(text) if len(parts) == 1 else [p for part in parts for p in self.pre_tokens(part)])
            extra.append(len(parts) - 1)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*split) - self.known.keys())
        self.known.update(zip(new, self.merge(new).tolist(), strict=True))
        return [sum(map(self.known.__getitem__, pieces)) + n for pieces, n in zip(split, extra, strict=True)]

    def merge(self, pieces: list[str]) -> np.ndarray:
        """Symbols that survive in each pre-token."""
        out = np.zeros(len(pieces), dtype=np.int64)
        raw = [p.encode("utf-8", "surrogateescape") for p in pieces]
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        owner = np.repeat(np.arange(len(raw)), size)
        final = np.zeros(len(data), dtype=bool)
        final[np.cumsum(size)[size > 0] - 1] = True
        symbols = np.where(final, self.last[data], self.inner[data])
        none = len(self.made)
        while len(symbols):
            key = symbols[:-1] * self.width + symbols[1:]
            place = np.minimum(np.searchsorted(self.keys, key), none - 1)
            rank = np.where((self.keys[place] == key) & (owner[:-1] == owner[1:]), self.ranks[place], none)
            rank = np.append(rank, none)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(symbols)))
            done = least == none
            out[owner[first[done]]] = length[done]
            hit = (rank == np.repeat(least, length)) & (rank < none)
            # In a run of overlapping hits (a symbol with itself) every other one counts, from the left.
            starts = hit & ~np.append(False, hit[:-1])
            place = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(starts, place, 0))
            hit &= (place - run) % 2 == 0
            symbols[hit] = self.made[rank[hit]]
            keep = ~np.append(False, hit[:-1]) & ~np.repeat(done, length)
            symbols, owner = symbols[keep], owner[keep]
        return out


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, n_bytes (UTF-8) and n_tokens of its whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            for row, stop, _, at in B.text_chunks(texts):
                part = [t or "" for t in texts.slice(row, stop - row).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, stop - row), pa.array(at[1:] - at[:-1]), pa.array(tokens.count(part), pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(count, COUNTED)
