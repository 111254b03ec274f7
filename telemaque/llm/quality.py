"""Quality rules by document and by host (operator 6).

Each text gets counts of words, symbols, repeated lines and repeated word windows. Hard rules reject
a document by itself. Soft rules have two limits, and its host says which of them holds: the failures
of each soft rule are totalled by host, the hosts' rates are shrunk towards the rate of all hosts with
a beta prior fitted to them (so that hosts of few documents are not judged by these alone), and the
verdicts on hosts (strict or not) are joined back to the documents. A host is strict where it fails more
often than not, or for sure well above the rate of all hosts.

Defined results: a null text counts as empty; an empty one has no words and fails. A null host is a
host of its own. Repeated rows are judged row by row. An empty table gives an empty table. Columns
that the input has beside these come back unchanged; ``RULES`` names a column that is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemaque.llm import buffers as B
from telemaque.llm.linking import stored

RULES = "__rules"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
WINDOW = 3
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[*b"#*$%&|<>"]] = True


@dataclass(frozen=True)
class Limits:
    """Thresholds; rates are of words unless a name says otherwise."""

    min_words: int = 50
    repeat_words: float = 0.5
    #: Soft rules: the limit on strict hosts, and the one elsewhere.
    least_chars: tuple[float, float] = (3.0, 2.0)  # mean length of a word
    most_chars: tuple[float, float] = (10.0, 14.0)
    symbols: tuple[float, float] = (0.1, 0.3)
    dup_lines: tuple[float, float] = (0.3, 0.5)  # of the lines that have a word
    soft_repeat_words: tuple[float, float] = (0.2, 0.4)
    #: A host is strict in a rule from this shrunk rate of failures (of the strict limit) on, whatever the others have,
    host_rate: float = 0.5
    #: or where its rate is, by this many standard deviations of its posterior, above this multiple of the rate of all hosts.
    host_sigmas: float = 3.0
    host_times: float = 2.0


def text_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for each text.

    ``n_dup_lines``: lines with a word that equal an earlier line; ``n_repeat_words``: words inside a
    window of three words that the text has twice or more, the first time included.
    """
    out = {name: np.zeros(len(column), dtype=np.int64) for name in COUNTS}
    for row, stop, data, at in B.text_chunks(column):
        docs = np.arange(stop - row, dtype=np.uint64)
        start, end, before = B.words(data, at)
        sums = B.running(data)
        own = B.mix(docs * B.GOLDEN)
        doc = np.repeat(docs.astype(np.int64), np.diff(before))
        n_words = np.diff(before)

        inside = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(~B.SPACE[data] & ((data & 0xC0) != 0x80), out=inside[1:])
        symbols = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(_SYMBOL[data], out=symbols[1:])

        first, last, lines_before = B.lines(data, at)
        line_doc = np.repeat(docs.astype(np.int64), np.diff(lines_before))
        worded = np.searchsorted(start, last) > np.searchsorted(start, first)
        first, last, line_doc = first[worded], last[worded], line_doc[worded]
        fresh = np.zeros(len(first), dtype=np.int64)
        fresh[np.unique(B.spans(sums, first, last) + own[line_doc], return_index=True)[1]] = 1

        twice = np.zeros(len(start) + 1, dtype=np.int64)
        if len(start) >= WINDOW:
            whole = np.flatnonzero(doc[: len(doc) - WINDOW + 1] == doc[WINDOW - 1 :])
            key = (B.sequences(B.spans(sums, start, end), WINDOW) + own[doc[: len(doc) - WINDOW + 1]])[whole]
            _, kind, times = np.unique(key, return_inverse=True, return_counts=True)
            again = whole[times[kind] > 1]
            cover = np.zeros(len(start) + 1, dtype=np.int64)
            np.add.at(cover, again, 1)
            np.add.at(cover, again + WINDOW, -1)
            np.cumsum(np.cumsum(cover)[:-1] > 0, out=twice[1:])

        n_lines = np.bincount(line_doc, minlength=stop - row)
        for name, value in zip(
            COUNTS,
            (
                n_words,
                np.diff(inside[at]),
                np.diff(symbols[at]),
                n_lines,
                n_lines - np.bincount(line_doc, weights=fresh, minlength=stop - row).astype(np.int64),
                np.diff(twice[before]),
            ),
            strict=True,
        ):
            out[name][row:stop] = value
    return out


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of ``text`` as struct ``RULES``."""
    docs = docs.drop(RULES)
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(RULES, T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))])
    place = names.index(text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = text_counts(batch.column(place))
            struct = pa.StructArray.from_arrays([pa.array(counts[c]) for c in COUNTS], list(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, RULES])

    return docs.mapInArrow(count, schema)


def base_failed(limits: Limits = Limits()) -> Column:
    """The hard rules."""
    n, again = F.col(f"{RULES}.n_words"), F.col(f"{RULES}.n_repeat_words")
    return (n < limits.min_words) | (again > limits.repeat_words * n)


def soft_failures(limits: Limits = Limits(), strict: bool = True) -> dict[str, Column]:
    """The soft rules by name; all false for a text without words."""
    r = {c: F.col(f"{RULES}.{c}").cast("double") for c in COUNTS}
    at = 0 if strict else 1
    mean = r["word_chars"] / F.greatest(r["n_words"], F.lit(1.0))
    return {
        "chars": (r["n_words"] > 0) & ~mean.between(limits.least_chars[at], limits.most_chars[at]),
        "symbols": r["n_symbols"] > limits.symbols[at] * r["n_words"],
        "lines": r["n_dup_lines"] > limits.dup_lines[at] * r["n_lines"],
        "repeats": r["n_repeat_words"] > limits.soft_repeat_words[at] * r["n_words"],
    }


def host_rates(counted: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """A row per host: its documents, and for each soft rule its failures, shrunk rate and verdict (strict).

    The prior of a rule is a beta distribution with the mean of all documents and the strength that
    the spread of the hosts' rates, less what their sizes explain, gives (moments).
    """
    rules = soft_failures(limits)
    hosts = counted.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), *[F.sum(c.cast("long")).alias(f"{k}_failed") for k, c in rules.items()]
    )
    totals = hosts.agg(
        F.sum("n").alias("all_n"),
        F.count("*").alias("n_hosts"),
        *[F.sum(f"{k}_failed").alias(f"{k}_all") for k in rules],
        *[F.sum(F.col(f"{k}_failed") * F.col(f"{k}_failed") / F.col("n")).alias(f"{k}_squares") for k in rules],
    )
    rated = hosts.join(F.broadcast(totals))  # one row
    for k in rules:
        mean = F.col(f"{k}_all") / F.col("all_n")
        noise = mean * (1 - mean)
        spread = F.col(f"{k}_squares") / F.col("all_n") - mean * mean - noise * F.col("n_hosts") / F.col("all_n")
        strength = F.when(spread > 0, F.greatest(noise / spread - 1, F.lit(1.0))).otherwise(F.col("all_n").cast("double"))
        rated = rated.withColumn(f"{k}_rate", (F.col(f"{k}_failed") + strength * mean) / (F.col("n") + strength))
        rate = F.col(f"{k}_rate")
        sigma = F.sqrt(F.greatest(rate * (1 - rate), F.lit(0.0)) / (F.col("n") + strength + 1))
        above = (rate > mean) & (rate - limits.host_sigmas * sigma >= limits.host_times * mean)
        rated = rated.withColumn(f"{k}_strict", (rate >= limits.host_rate) | above)
    return rated.select("host", "n", *[c for k in rules for c in (f"{k}_failed", f"{k}_rate", f"{k}_strict")])


def judged(docs: DataFrame, text: str = "text", host: str = "source", limits: Limits = Limits(), keep_text: bool = True) -> DataFrame:
    """``docs`` with struct ``RULES``: the counts, ``base_failed``, ``soft_failed`` and ``kept``.

    ``soft_failed`` names the soft rules that the document fails at the limits of its host. Texts are counted
    once: the rows are stored with their counts, without the texts unless ``keep_text``.
    """
    docs = docs.drop(RULES)
    counted = with_counts(docs, text)
    if not keep_text:
        docs, counted = docs.drop(text), counted.drop(text)
    counted = stored(counted, "counted")
    rates = stored(host_rates(counted, host, limits), "hosts")
    tight, wide = soft_failures(limits), soft_failures(limits, strict=False)
    verdicts = rates.select(
        F.col("host").alias("__host"), F.struct(*[F.col(f"{k}_strict").alias(k) for k in tight]).alias("__strict")
    )
    joined = counted.join(verdicts, F.col(f"`{host}`").eqNullSafe(F.col("__host")), "left")
    held = [F.when(F.when(F.col(f"__strict.{k}"), tight[k]).otherwise(wide[k]), F.lit(k)) for k in tight]
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.struct(f"{RULES}.*", base_failed(limits).alias("base_failed"), F.array_compact(F.array(*held)).alias("soft_failed")).alias(RULES),
    ).withColumn(RULES, F.col(RULES).withField("kept", ~F.col(f"{RULES}.base_failed") & (F.size(f"{RULES}.soft_failed") == 0)))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    return judged(docs, text, host, limits).where(f"{RULES}.kept").drop(RULES)
