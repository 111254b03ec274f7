from __future__ import annotations

import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from telemaque.llm import buffers, packing, quality, queries, tokencount
from tests.llm.helpers import SMALL, hostile, words

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
WORD, BYTE = (public_tokenizers.path(n) for n in (queries.WORD_VOCABULARY, queries.BYTE_VOCABULARY))


def test_words_and_lines_of_a_buffer():
    rnd = random.Random(1)
    for _ in range(200):
        texts = ["".join(rnd.choice("ab \n\té") for _ in range(rnd.choice([0, 1, 2, 20]))) for _ in range(4)] + [None]
        seen = {}
        for row, stop, data, at in buffers.text_chunks(pa.array(texts), 8):
            raw, sums = data.tobytes(), buffers.running(data)
            for made, split in ((buffers.words, rb"[^\x20\x09-\x0d]+"), (buffers.lines, None)):
                start, end, before = made(data, at)
                for i, text in enumerate(texts[row:stop]):
                    plain = (text or "").encode()
                    part = slice(before[i], before[i + 1])
                    assert [raw[a:b] for a, b in zip(start[part], end[part], strict=True)] == (
                        re.findall(split, plain) if split else plain.split(b"\n")
                    )
                for a, b, h in zip(start, end, buffers.spans(sums, start, end), strict=True):
                    assert seen.setdefault(raw[a:b], h) == h
        assert len(set(seen.values())) == len(seen)


def brute_counts(text):
    w = words(text)
    seen, dup, lines = set(), 0, 0
    for line in (text or "").split("\n"):
        if words(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    times = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, dup, len(again)


def test_rules_equal_brute_force_and_base_decides(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in docs.transform(quality.with_counts).select("doc_id", f"{quality.RULES}.*").collect():
        assert tuple(r[c] for c in quality.COUNTS) == brute_counts(texts[r["doc_id"]])
    rows = queries.op6_quality_rules(spark, SMALL).collect()
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert len(rows) == len(texts) and any(not r["kept"] and not r["base_failed"] for r in rows)


def test_hosts_are_judged_by_shrunk_rates(spark):
    good = " ".join(f"word{i}" for i in range(60))
    some = good + " #" * 10
    rows = [(i, some if host == "bad" else good, host, None) for i, host in enumerate(["bad"] * 40 + ["good"] * 60, 100)]
    rows += [(1000 + i, some, "good", None) for i in range(2)] + [(2000, some, None, None)]
    docs = hostile(spark, rows).where("doc_id >= 0")
    rates = {r["host"]: r for r in quality.host_rates(quality.with_counts(docs)).collect()}
    assert rates["bad"]["symbols_rate"] > 0.5 > rates["good"]["symbols_rate"]
    assert rates[None]["symbols_rate"] < 1  # one document says little
    kept = {r["doc_id"] for r in quality.keep_good(docs).collect()}
    assert kept.isdisjoint(range(100, 140)) and {1000, 1001, *range(140, 200)} <= kept
    assert quality.keep_good(docs).columns == docs.columns


def test_a_host_well_above_the_others_is_strict(spark):
    good = " ".join(f"word{i}" for i in range(60))
    some = good + " #" * 10  # between the two limits
    rows = [(1000 * h + i, some if i < (120 if h == 0 else 8) else good, f"host{h}") for h in range(20) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    strict = {r["host"] for r in quality.host_rates(quality.with_counts(docs)).where("symbols_strict").collect()}
    assert strict == {"host0"}  # 0.3 of its documents, 0.02 of the others'
    kept = {r["doc_id"] for r in quality.keep_good(docs).select("doc_id").collect()}
    assert {i for i, *_ in rows} - kept == set(range(120))


def test_rules_on_hostile_and_empty_tables(spark):
    docs = hostile(spark)
    judged = quality.judged(docs).collect()
    assert len(judged) == docs.count() and [c for c in judged[0].asDict() if c != quality.RULES] == docs.columns
    assert quality.judged(docs.where("false")).count() == 0


def test_token_counts_equal_the_librarys():
    tokenizer, counter, rnd = Tokenizer.from_file(WORD), tokencount.counter(WORD), random.Random(3)
    parts = ["a", "b", "É", "Σ", "İ", " ", "\n", "1", "２", "<|endoftext|>", "<|", "'s", "ll", ".", "漢", "😀", "Ᲊ", "\x1c", "\x85", "a" * 9, "ﬁ", "é"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(3000)] + ["ab" * 5000]
    assert counter.count(texts) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_count_query(spark):
    tokenizer = Tokenizer.from_file(WORD)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op4_token_counts(spark, SMALL).collect():
        text = texts[r["doc_id"]]
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)
    docs = hostile(spark)
    assert [r["n_tokens"] for r in tokencount.token_counts(docs.where("doc_id in (3, 4, 5)"), WORD).collect()] == [0, 0, 0]
    assert tokencount.token_counts(docs, WORD).count() == docs.count()
    assert tokencount.token_counts(docs.where("false"), WORD).count() == 0


def check_packed(rows, size):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by_sequence)


def test_packing_query(spark):
    tokenizer = Tokenizer.from_file(BYTE)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op7_best_fit_packing(spark, SMALL).collect()
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert least <= check_packed(rows, 2048) <= least * 1.02 + 1
    pieces = {}
    for r in sorted(rows, key=lambda r: r["piece"]):
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == texts.keys()
    for doc, parts in pieces.items():
        ids = np.array([*tokenizer.encode(texts[doc], add_special_tokens=False).ids, 0], dtype="<u4")
        assert [p["piece"] for p in parts] == list(range(len(parts))) and sum(p["length"] for p in parts) == len(ids)
        assert all(p["length"] == 2048 for p in parts[1:])
        for p in parts:
            assert zlib.crc32(ids[p["start"] : p["start"] + p["length"]]) == p["ids_crc32"]


def test_fullest_combination_is_the_fullest():
    rnd = random.Random(2)
    for _ in range(200):
        counts = np.zeros(31, dtype=np.int64)
        for _ in range(rnd.randint(1, 6)):
            counts[rnd.randint(1, 30)] += rnd.randint(1, 3)
        chosen = packing.fullest(counts, 30)
        assert all(counts[n] >= k for n, k in chosen.items())
        longest = int(np.flatnonzero(counts)[-1])
        sums = {longest}
        for n in range(1, 31):
            for _ in range(int(counts[n]) - (n == longest)):
                sums |= {s + n for s in sums if s + n <= 30}
        assert sum(n * k for n, k in chosen.items()) == max(sums)


def test_packing_hostile_and_empty_tables(spark):
    docs = hostile(spark)
    rows = packing.pack_documents(docs, BYTE).collect()
    check_packed(rows, 2048)
    assert sum(r["length"] for r in rows if r["doc_id"] in (3, 4)) == 2  # the end ids
    assert packing.pack_documents(docs.where("false"), BYTE).count() == 0


@pytest.mark.parametrize("n,expected", [(1, [(0, 1)]), (4, [(0, 4)]), (5, [(0, 1), (1, 4)]), (9, [(0, 1), (1, 4), (5, 4)])])
def test_cuts(n, expected):
    assert packing.cuts(n, 4) == expected
