"""Brute-force versions and rows with what goes wrong: nulls, empty and long texts, ties, copies, clashing names."""

from __future__ import annotations

import re

SMALL = "/root/testdata/sf0.001"


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def hostile(spark, extra=()):
    """documents with null and empty texts, a long one, copies, a null id and a column with a clashing name."""
    base = " ".join(f"word{i}" for i in range(80))
    rows = [
        (1, base, "h", 9), (1, base, "h", 9), (2, base + " more", "h", 9), (3, None, None, None), (4, "", "h", 1),
        (5, "\n \n\t", "h", 1), (6, "é" * 50_000, "h", 1), (None, "short text", "h", 1), *extra,
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long")
