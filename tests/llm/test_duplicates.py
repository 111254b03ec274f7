from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from telemaque.llm import buffers, linededup, linking, minhash, queries
from tests.llm.helpers import SMALL, fold, hostile, words


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rnd, text, n):
    out = list(text)
    for _ in range(n):
        i, kind = rnd.randint(0, len(out)), rnd.randint(0, 2)
        if kind == 0 or i == len(out):
            out.insert(i, rnd.choice("abé"))
        elif kind == 1:
            out.pop(i)
        else:
            out[i] = rnd.choice("abé")
    return "".join(out)


def groups(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_edits_along_diagonals_and_in_bands_of_several_words():
    rnd, pairs = random.Random(15), []
    for letters in ("a", "ab", "abcdefgh", "aé漢😀" + "".join(chr(0x4E00 + i) for i in range(300))):
        for size in (0, 1, 20, 60, 150):
            for n in (0, 1, 3, 8, 40, 90):
                a = "".join(rnd.choice(letters) for _ in range(size))
                pairs.append((a, changed(rnd, a, n)))
    pairs.append(("a" * 3000, "b" * 20 + "a" * 2960))
    apart = np.array([edits(a, b) for a, b in pairs])
    long, short = [max(p, key=len) for p in pairs], [min(p[::-1], key=len) for p in pairs]
    gap = np.array([len(a) - len(b) for a, b in zip(long, short, strict=True)])
    for limit in (0, 1, 7, 31, 32, 100):
        limits = np.maximum(gap, limit)
        assert linededup._reached(long, short, limits).tolist() == np.minimum(apart, limits + 1).tolist()
        assert linededup._banded(long, short, limits).tolist() == (apart <= limits).tolist()
        assert linededup.all_within(pairs, np.full(len(pairs), limit)).tolist() == (apart <= limit).tolist()


def test_edit_distance_in_a_band():
    rnd = random.Random(5)
    for _ in range(3000):
        a = "".join(rnd.choice("abé") for _ in range(rnd.randint(0, 14)))
        b = changed(rnd, a, rnd.randint(0, 4))
        for limit in range(4):
            assert linededup.within(a, b, limit) == (edits(a, b) <= limit), (a, b, limit)


def test_many_edit_distances_at_once():
    rnd = random.Random(6)
    pairs, limits = [], []
    for _ in range(4000):
        a = "".join(rnd.choice("abé\U0001f600") for _ in range(rnd.choice([0, 1, 5, 14, 40, 90])))
        pairs.append((a, changed(rnd, a, rnd.randint(0, 9))))
        limits.append(rnd.choice([0, 1, 2, 3, 5, 8, 31, 40]))
    pairs += [(x * 300, y * 290) for x in "ab" for y in "ab"]
    limits += [10] * 4
    got = linededup.all_within(pairs, np.array(limits)).tolist()
    assert got == [edits(a, b) <= n for (a, b), n in zip(pairs, limits, strict=True)]
    assert linededup.all_within([], np.array([], dtype=np.int64)).tolist() == []


def test_every_close_pair_shares_an_indexed_bucket():
    rnd, steps = random.Random(2), ((4, 1), (8, 2))
    for _ in range(60):
        lines = {changed(rnd, base, rnd.randint(0, 3)) for base in ("ab" * rnd.randint(3, 7),) for _ in range(12)}
        ((_, _, data, at),) = buffers.text_chunks(pa.array(["\n".join(sorted(lines))]))
        held = linededup.Lines(data, at, steps)
        bucket, place, indexed = linededup.entries(held, steps)
        inside, index = defaultdict(set), defaultdict(set)
        for b, p, i in zip(bucket, place, indexed, strict=True):
            inside[b].add(held.text(p))
            if i:
                index[b].add(held.text(p))
        found = {frozenset((x, y)) for b in inside for x in index[b] for y in inside[b]}
        judged = sorted({held.text(i) for i in range(len(held.id))})
        for i, x in enumerate(judged):
            for y in judged[:i]:
                if edits(x, y) <= linededup.allowed(np.array([min(len(x), len(y))]), steps)[0]:
                    assert frozenset((x, y)) in found


def test_close_lines_of_any_length_share_an_indexed_key():
    rnd = random.Random(4)
    for _ in range(250):
        size = rnd.choice([rnd.randint(20, 130), rnd.randint(100, 900), rnd.randint(900, 2300), rnd.randint(2200, 5000)])
        base = "".join(rnd.choice("abcdefghij ") for _ in range(size))
        limit = int(linededup.allowed(np.array([size]))[0])
        where = rnd.choice([(0, size), (0, 2 * limit + 2), (size - 2 * limit - 2, size), (size // 2 - limit, size // 2 + limit)])
        other = list(base)
        for _ in range(limit):  # all edits in one region, of one kind or mixed
            at, how = min(max(0, rnd.randint(*where)), len(other) - 1), rnd.choice("ids" if rnd.random() < 0.5 else "i")
            other[at : at + (how != "i")] = [] if how == "d" else ["é"]
        a, b = sorted((base, "".join(other)), key=len)
        if len(a) < 20 or not linededup.within(a, b, int(linededup.allowed(np.array([len(a)]))[0])):
            continue
        ((_, _, data, at),) = buffers.text_chunks(pa.array([f"{a}\n{b}"]))
        held = linededup.Lines(data, at)
        key, place, indexed = linededup.entries(held)
        index, probes = (set(key[(place == p) & (indexed == i)].tolist()) for p, i in ((0, True), (1, False)))
        assert a == b or index & probes, (len(a), len(b))


def test_blocks_of_keys_come_back():
    rnd = np.random.default_rng(1)
    for n, top in ((1, 5), (5, 1 << 40), (5000, 1 << 20), (5000, 1 << 34), (300, 1 << 50), (4, 1 << 61)):
        key = np.sort(rnd.integers(0, top, n, dtype=np.uint64))
        line, indexed = rnd.integers(0, 1 << linededup.PRINT, n, dtype=np.uint32), rnd.random(n) < 0.5
        for was, now in zip((key, line, indexed), linededup.unpack(linededup.pack(key, line, indexed)), strict=True):
            assert (was == now).all()


def test_a_run_of_keys_takes_little_memory():
    rnd = np.random.default_rng(3)
    tracemalloc.start()
    n, bits = linededup.HELD_KEYS, 38
    key, line = rnd.integers(0, 1 << bits, n, dtype=np.uint64), rnd.integers(0, 1 << linededup.PRINT, n, dtype=np.uint32)
    linededup._in_order(key, line, rnd.random(n) < 0.5, bits)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20


def test_rows_of_one_id_and_without_an_id_lose_only_copies(spark):
    rows = [(9, "first of nine, all alone in the world\nsecond own line of nine"), (9, "copied line of some length\nits own line, of some length"), (1, "copied line of some length"),
            (None, "a line that has no id at all\ncopied line of some length"), (None, "another line without any id"), (None, "a line that has no id at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted((str(r.doc_id), r.text) for r in linededup.without_repeats(docs).collect())
    every = Counter(line for _, t in left for line in t.split("\n"))
    assert set(every) == {line for _, t in rows for line in t.split("\n")} and set(every.values()) == {1}
    assert ("9", rows[0][1]) in left and ("9", "its own line, of some length") in left and ("1", "copied line of some length") in left
    twice = spark.createDataFrame([(5, "the very same row of text"), (5, "the very same row of text")], "doc_id long, text string")
    assert linededup.without_repeats(twice).count() == 2


def test_line_classes_equal_brute_force(spark):
    rnd = random.Random(9)
    bases = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.choice([22, 45, 70]))) for _ in range(12)]
    texts = ["\n".join(changed(rnd, rnd.choice(bases), rnd.choice([0, 0, 1, 2])) for _ in range(4)) for _ in range(30)]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, line_no int")
    lines = [(i, n, line) for i, t in enumerate(texts) for n, line in enumerate(t.split("\n")) if len(line) >= 20]
    near = lambda x, y: edits(x, y) <= linededup.allowed(np.array([min(len(x), len(y))]))[0]
    pairs = [(a[:2], b[:2]) for k, a in enumerate(lines) for b in lines[:k] if near(a[2], b[2])]
    expected = groups([x[:2] for x in lines], pairs)
    got = linededup.line_classes(docs).collect()
    assert {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"]) for r in got} == expected
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == (r["class_doc_id"], r["class_line_no"])) for r in got)
    left = {r["doc_id"]: r["text"] for r in linededup.without_repeats(docs).collect()}
    first = set(expected.values())
    for i, text in enumerate(texts):
        kept = [line for n, line in enumerate(text.split("\n")) if len(line) < 20 or (i, n) in first]
        assert left.get(i, "") == "\n".join(kept)


def test_near_copies_of_long_lines_and_copies_of_short_ones(spark):
    rnd = random.Random(8)
    lines = ["Menu", "}"]
    for size in (99, 101, 140, 300, 1000):
        base = "".join(rnd.choice("abcdefgh ") for _ in range(size))
        most = int(linededup.allowed(np.array([size]))[0])
        lines += [base] + [changed(rnd, base, n) for n in (1, most // 2, most, most + 1, 2 * most + 2)]
    docs = spark.createDataFrame([(i, f"{line}\n\nMenu\n}}") for i, line in enumerate(lines)], "doc_id long, text string")
    every = [(i, n, x) for i, line in enumerate(lines) for n, x in ((0, line), (2, "Menu"), (3, "}"))]
    pairs = []
    for k, a in enumerate(every):
        for b in every[:k]:
            limit = linededup.allowed(np.array([min(len(a[2]), len(b[2]))]))[0]
            if a[2] == b[2] or (abs(len(a[2]) - len(b[2])) <= limit and edits(a[2], b[2]) <= limit):
                pairs.append((a[:2], b[:2]))
    got = linededup.line_classes(docs).collect()
    assert {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"]) for r in got} == groups([x[:2] for x in every], pairs)
    assert len({(r["class_doc_id"], r["class_line_no"]) for r in got}) < len(lines) - 5


def test_many_lines_that_are_alike_but_not_linked(spark, monkeypatch):
    """They meet inside the tasks, in blocks: pairs that are no links once became rows."""
    rnd, verified = random.Random(14), []
    monkeypatch.setattr(linking, "FEW", 4)
    monkeypatch.setattr(linking, "BLOCK", 16)
    made = linededup._verifier

    def counted(*args):
        verify = made(*args)

        def check(pairs):
            found = verify(pairs)
            verified.append((pairs.count(), found.count()))
            return found

        return check

    monkeypatch.setattr(linededup, "_verifier", counted)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(200))  # 6 edits are allowed
    lines = sorted({changed(rnd, base, rnd.choice([0, 2, 4, 7, 9, 11])) for _ in range(70)})
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    near = lambda x, y: edits(x, y) <= linededup.allowed(np.array([min(len(x), len(y))]))[0]
    pairs = [(i, j) for i, x in enumerate(lines) for j in range(i) if abs(len(x) - len(lines[j])) <= 6 for y in (lines[j],) if near(x, y)]
    got = {r["doc_id"]: r["class_doc_id"] for r in linededup.line_classes(docs).collect()}
    assert got == groups(range(len(lines)), pairs)
    assert 3 < len(set(got.values())) < len(lines) - 20
    assert sum(n for n, _ in verified) < 8 * len(lines)


def test_blocks_of_homes_meet_in_several_tasks(spark, monkeypatch):
    """They are few bytes and much work: run-time merging of small partitions once left all of them to one task."""
    monkeypatch.setattr(linking, "BLOCK", 4)
    rows = [(home, 100 * home + i, True, 12, 100 * home + i) for home in range(6) for i in range(12)]
    members = spark.createDataFrame(rows, "bucket long, id long, pivot boolean, n long, class_id long")
    about, texts = members.select("id", F.lit(30).cast("long").alias("size")), members.select("id", F.lit("x").alias("line"))
    pairs = linking._of_large(members, about, lambda a, b: F.lit(True), texts, lambda table, i, j: np.ones(len(i), dtype=bool))
    found = pairs.select("a", "b", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in found}) > 1
    assert groups([x[1] for x in rows], [(r.a, r.b) for r in found]) == {x[1]: 100 * x[0] for x in rows}


def test_line_dedup_on_hostile_and_empty_tables(spark):
    docs = hostile(spark)
    out = linededup.without_repeats(docs)
    assert out.columns == docs.columns
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert {(3, None), (4, ""), (5, "\n \n\t"), (6, "é" * 50_000), (None, "short text")} <= texts
    assert linededup.line_classes(docs.where("false")).count() == 0 and linededup.without_repeats(docs.where("false")).count() == 0


def test_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    ids = {x for pair in links if pair[0] != pair[1] for x in pair}
    assert {r["id"]: r["class_id"] for r in linking.components(df).collect()} == groups(ids, [p for p in links if p[0] != p[1]])


def test_sketches_fill_and_agree_like_the_sets():
    rnd = np.random.default_rng(1)
    sizes = (0, 1, 3, 40, 900)
    sets = [np.unique(rnd.integers(0, 2**63, n).astype(np.uint64)) for n in sizes]
    half = np.concatenate([sets[-1][:600], rnd.integers(0, 2**63, 300).astype(np.uint64)])
    sets.append(np.unique(half))
    sketch = minhash.sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), 512)
    empty = np.uint64(2**64 - 1)
    assert (sketch[0] == empty).all() and (sketch[1:] != empty).all()
    assert abs((sketch[4] == sketch[5]).mean() - 600 / 1200) < 0.1


def test_the_condition_on_sketch_bits_loses_less_than_the_bands():
    share = (1 + minhash.SIMILARITY / 100) / 2
    least = math.ceil(minhash.BITS * share - minhash.SLACK * (minhash.BITS * share * (1 - share)) ** 0.5)
    lost = sum(math.comb(minhash.BITS, k) * share**k * (1 - share) ** (minhash.BITS - k) for k in range(least))
    assert lost < 1.6e-12


def brute_groups(docs, n, similarity=80):
    sets = {}
    for doc, text in docs:
        w = words(fold(text))
        sets[doc] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    ids = sorted(sets)
    pairs = []
    for k, a in enumerate(ids):
        for b in ids[:k]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and 100 * small >= similarity * large:
                both = len(sets[a] & sets[b])
                if 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                    pairs.append((a, b))
    return sets, groups(ids, pairs)


def test_near_duplicate_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    sets, expected = brute_groups(docs, 2)
    got = queries.op8_minhash_near_dedup(spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(sets[i]), c) for i, c in expected.items()}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got) and len(got) == len(docs)


def test_chains_of_near_copies_are_one_component(spark):
    rnd = random.Random(6)
    text, rows = [f"w{i}" for i in range(60)], []
    for i in range(40):  # each is near the one before, the ends are not near one another
        rows.append((i, " ".join(text)))
        text[rnd.randrange(60)] = f"x{i}"
    rows += [(100 + i, "a common passage of some words " * 2 + f"own {i} and {i * 7}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (2, 5):
        _, expected = brute_groups(rows, n)
        assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, n).collect()} == expected


def test_near_duplicates_on_hostile_and_empty_tables(spark):
    docs = hostile(spark)
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in minhash.near_duplicates(docs).collect())
    assert len(got) == docs.count()
    assert [g[1:] for g in got if g[0] in "12"] == [(76, "1"), (76, "1"), (77, "1")]
    assert [g[1:] for g in got if g[0] in "345"] == [(0, "3"), (0, "4"), (0, "5")]
    assert minhash.near_duplicates(docs.where("false")).count() == 0


def test_many_sets_that_are_alike_but_not_linked(spark, monkeypatch):
    """Large buckets of near copies below and above the threshold, their pairs found by rare shingles."""
    rnd = random.Random(12)
    monkeypatch.setattr(linking, "FEW", 4)
    rows, base = [], [f"w{i}" for i in range(120)]
    for i in range(150):
        text = list(base)
        for k in rnd.sample(range(120), rnd.choice([2, 5, 8, 11, 14])):
            text[k] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(200 + i, rows[i][1] + " and a few more") for i in range(0, 150, 10)] + [(400, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for shingle in (1, 2):
        _, expected = brute_groups(rows, shingle)
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, shingle=shingle).collect()}
        assert got == expected and len(set(got.values())) > 5


def test_prefixes_hold_a_shared_shingle(spark):
    for small in (1, 2, 3, 10, 57, 400):
        for large in {small, small + 1, small * 5 // 4}:
            need = -(-80 * (small + large) // 180)  # the least overlap of a linked pair
            if 100 * small < 80 * large:
                continue
            row = spark.range(1).select(
                minhash.prefix(F.lit(small).cast("long"), 160, 180).alias("a"), minhash.prefix(F.lit(large).cast("long"), 80, 100).alias("b")
            ).first()
            assert row.a >= small - need + 1 and row.b >= large - need + 1


def test_sets_differ_in_at_least_as_many_shingles_as_their_parities():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, n)) for n in (0, 1, 2, 40, 700, 2500, 2500)]
    sets += [sets[4][:-3], sets[4][5:], sets[0]]
    bits = minhash.parities(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert bits.shape == (len(sets), minhash.PARITIES // 64)
    for one, x in zip(sets, bits, strict=True):
        for other, y in zip(sets, bits, strict=True):
            odd = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
            apart = len(np.setxor1d(one, other))
            assert odd <= apart and odd % 2 == apart % 2
