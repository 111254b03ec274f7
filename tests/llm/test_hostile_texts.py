"""Texts and ids that once broke an operator, and pseudonyms by brute force over a whole table."""

from __future__ import annotations

import hashlib
import re
from datetime import date, timedelta

import public_tokenizers
from tokenizers import Tokenizer

from telemaque.llm import decontam, minhash, packing, pii, queries, tokencount, warc
from tests.llm.helpers import SMALL

SECRET = queries.PSEUDONYM_KEY


def keyed(*parts):
    return int(hashlib.sha256("|".join(map(str, (SECRET, *parts))).encode()).hexdigest()[:15], 16)


def shifted(s, kind):
    a, b = s[: len(s) // 2], s[len(s) // 2 :]

    def moved(mine, other, i):
        out = ""
        for place, c in enumerate(mine):
            for first, n in (("0", 10), ("a", 26), ("A", 26)):
                if c.isascii() and ord(first) <= ord(c) < ord(first) + n:
                    c = chr(ord(first) + (ord(c) - ord(first) + keyed(kind, i, place, other)) % n)
                    break
            out += c
        return out

    for i in range(8):
        a, b = (moved(a, b, i), b) if i % 2 == 0 else (a, moved(b, a, i))
    return a + b


def paired(a, b, n_a, n_b, kind):
    for i in range(8):
        a, b = ((a + keyed(kind, i, b) % n_a) % n_a, b) if i % 2 == 0 else (a, (b + keyed(kind, i, a) % n_b) % n_b)
    return a, b


def filled(form, chars, slot):
    it = iter(chars)
    return "".join(next(it) if re.fullmatch(slot, c) else c for c in form)


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10


def mod97(s):
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def pseudonym(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "email":
        local, domain = m.split("@")
        return f"{shifted(local, kind)}@{domain}" if len(domain) <= 253 else None
    if kind == "ip":
        o = [int(x) for x in m.split(".")]
        a, b = paired(o[0] * 256 + o[1], o[2] * 256 + o[3], 1 << 16, 1 << 16, kind)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if kind == "ssn":
        areas = [x for x in range(1, 900) if x != 666]
        a, b = paired(areas.index(int(m[:3])) * 99 + int(m[4:6]) - 1, int(m[7:]) - 1, 898 * 99, 9999, kind)
        return f"{areas[a // 99]:03}-{a % 99 + 1:02}-{b + 1:04}"
    if kind == "iban":
        s = m.replace(" ", "")
        if not 15 <= len(s) <= 34 or mod97(s) != 1:
            return None
        body = filled(s[4:], shifted(re.sub("[^0-9]", "", s[4:]), kind), "[0-9]")
        return filled(m, f"{s[:2]}{98 - mod97(s[:2] + '00' + body):02}{body}", "[A-Za-z0-9]")
    if kind == "phone":
        return filled(m, digits[:-7] + shifted(digits[-7:], kind), "[0-9]") if 8 <= len(digits) <= 15 else None
    if kind == "card":
        if not 13 <= len(digits) <= 19 or luhn(digits):
            return None
        body = digits[0] + shifted(digits[1:-1], kind)
        return filled(m, body + str(-luhn(body + "0") % 10), "[0-9]")
    order = (0, 1, 2) if "-" in m else (2, 1, 0) if "." in m else (2, 0, 1)
    parts = [int(x) for x in re.split("[-./]", m)]
    try:
        day = date(*(parts[i] for i in order))
    except ValueError:
        return None
    for first, n_a, n_b in ((date(1825, 1, 1), 92, 397), (date(1925, 1, 1), 75, 487), (date(2025, 1, 1), 92, 397)):
        at = (day - first).days
        if 0 <= at < n_a * n_b:
            a, b = paired(at // n_b, at % n_b, n_a, n_b, f"date{first}")
            new = first + timedelta(days=a * n_b + b)
            return f"{new:%Y-%m-%d}" if "-" in m else f"{new:%d.%m.%Y}" if "." in m else f"{new:%m/%d/%Y}"
    return None


def brute_pseudonyms(text):
    counts = dict.fromkeys(pii.KINDS, 0)

    def replace(match):
        m = match.group()
        for kind, pattern in pii.PATTERNS.items():
            if re.match(f"^(?:{pattern})$", m) and (new := pseudonym(kind, m)) is not None:
                counts[kind] += 1
                return new
        return m

    return re.sub(pii.ANY, replace, text or ""), counts


def test_pseudonyms_of_a_whole_table_equal_brute_force(spark):
    for folder in (SMALL, SMALL.replace("0.001", "0.01")):
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
        rows = queries.op2_pii(spark, folder).collect()
        assert len(rows) == len(texts)
        for r in rows:
            text, counts = brute_pseudonyms(texts[r.doc_id])
            assert (r.text or "") == text and {k: r[f"n_{k}"] for k in pii.KINDS} == counts
    assert any(r.n_replaced for r in rows)


def test_long_addresses_and_groups_do_not_break_the_patterns(spark):
    texts = [
        "x@" + "a." * 20_000 + "com", "x@" + "a." * 20_000, "a" * 200_000 + "@b.com", "+4" + " 1234" * 50_000, "1234 " * 100_000, "DE89" + " 3704" * 50_000,
        "1.2.3.4." * 50_000, "(((" * 50_000 + "555) 555-5555", "a@b." * 50_000, "x" * 64 + "@" + ".".join(["a" * 62] * 4) + ".x",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.pseudonymized(docs, SECRET).collect():
        text, counts = brute_pseudonyms(texts[r.doc_id])
        assert r.text == text and r[pii.FOUND].asDict() == counts


def test_very_long_blanks_are_packed(spark):
    path = public_tokenizers.path(queries.BYTE_VOCABULARY)
    texts = {1: " " * 1_000_000, 2: "a" + " \n" * 600_000 + "b", 3: "x" * 200_000}
    rows = packing.pack_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), path).collect()
    library = Tokenizer.from_file(path)
    for doc, text in texts.items():
        assert sum(r.length for r in rows if r.doc_id == doc) == len(library.encode(text, add_special_tokens=False).ids) + 1


def test_token_counts_beside_every_code_point():
    path = public_tokenizers.path(queries.WORD_VOCABULARY)
    library, counter = Tokenizer.from_file(path), tokencount.Counter(path)
    texts = [f"क{chr(c)}b a{chr(c)}1 {chr(c)}" for c in [*range(0xD800), *range(0xE000, 0x10000), *range(0x10000, 0x110000, 97)]]
    brute = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [n for i in range(0, len(texts), 5000) for n in counter.count(texts[i : i + 5000])]
    assert [hex(ord(t[1])) for t, a, b in zip(texts, got, brute, strict=True) if a != b] == []


def test_letters_whose_small_form_depends_on_their_neighbours(spark):
    rest = " ".join(f"w{i}" for i in range(8))
    items = spark.createDataFrame([("i1", f"ΑΣ Β {rest}"), ("i2", f"ΑΣ.Γ {rest}")], "item_id string, text string")
    docs = [(1, f"ΑΣ.Β {rest}"), (2, f"x ΑΣ' Γ {rest} y"), (3, f"ας Β {rest}"), (4, f"ΑΣΒ {rest} z")]
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontam.contamination(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {1: (10, 1), 2: (10, 1), 3: (0, 0), 4: (0, 0)}


def test_page_ids_of_any_size(spark, tmp_path):
    ids = [10**12, -5, 2**62, 0, None]
    spark.createDataFrame([(i, "http://a/b", f"page {i}") for i in ids], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = queries.op5_warc(spark, str(tmp_path)).collect()
    assert sorted((r.page_id for r in rows), key=str) == sorted(ids, key=str) and {r.record_type for r in rows} == {"response"}


def test_archives_are_read_back_by_a_task_each(spark):
    pages = spark.range(400).selectExpr("id as page_id", "concat('http://h', id % 7, '/') as url", "repeat(cast(id as string), 300) as payload", "timestamp'2024-01-01' as captured_at", "cast(null as struct<page_id:bigint,url:string>) as refers")
    pages = pages.withColumn("payload", pages.payload.cast("binary"))
    folder = f"{warc.fresh_dir(spark, 'test-warc')}"
    manifest = warc.write_archives(pages.repartition(6), folder, file_bytes=4000)
    files = manifest.count()
    assert files > 6 and warc.runs(manifest, folder).count() == 400
    read = manifest.select("file").repartition(files)
    assert read.rdd.getNumPartitions() == files


def test_rows_without_an_id_are_kept_or_not(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = spark.createDataFrame([(None, text), (4, text), (None, text + " more"), (None, None), (9, "")], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(rows, shingle=2).collect()}
    assert got == {(None, 29, 4, False), (4, 29, 4, True), (None, 30, None, True), (None, 0, None, True), (9, 0, 9, True)}


def test_texts_are_counted_once(spark):
    plan = queries.op6_quality_rules(spark, SMALL)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan
