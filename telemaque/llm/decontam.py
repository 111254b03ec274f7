"""Benchmark decontamination by winnowing (operator 10), in DataFrame functions only.

Every text becomes an array of word hashes. Of the hashes of its ``K`` consecutive words the smallest of
each run of ``WINDOW - K + 1`` is a fingerprint; a shared passage of ``WINDOW`` words has the same run
in both texts, so it shares a fingerprint wherever it stands. Fingerprints of documents are joined with
those of the benchmark; the documents that have one in common are read again, and each hit is extended:
the windows of words around it are looked up among the benchmark's windows. What is hit is the union of
the windows found.

An item of fewer than ``WINDOW`` words is one window; it is found in the same way, with runs as long as
it allows. There are at most ``WINDOW - 1`` such lengths, each looked for only where the benchmark has it.

Defined results: null or word-less texts have no words and no hits; passages of items with a null id are
hits, but not in the list of items; documents are judged row by row, whether or not they have an id, or
another's; items of one id count once; other columns are ignored; an empty table on either side gives no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemaque.llm.linking import sent, stored

WINDOW, K = 10, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

RESULT = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def word_hashes(text: Column) -> Column:
    """The hashes of a text's words, lower-cased in A-Z, in order."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.transform(F.array_remove(F.split(plain, BETWEEN), ""), lambda w: F.xxhash64(w))


def _gram(words: Column, at: Column, n: int) -> Column:
    """The hash of the ``n`` words from place ``at`` (from 0) on."""
    return F.xxhash64(F.lit(n), *[F.get(words, at + i) for i in range(n)])


def _places(words: Column, n: int) -> Column:
    """0 to the last place where ``n`` words begin; none for shorter texts."""
    size = F.size(words)
    return F.when(size >= n, F.sequence(F.lit(0), size - n)).otherwise(F.array().cast("array<int>"))


def fingerprints(words: Column, window: int, k: int) -> Column:
    """The distinct fingerprints: minima of each ``window - k + 1`` consecutive hashes of ``k`` words."""
    k = min(k, window)
    return _once(F.transform(_places(words, k), lambda i: _gram(words, i, k)), lambda grams: _minima(grams, window - k + 1))


def _once(array: Column, made) -> Column:
    """``made`` of an array that is computed once, and not again for each of its elements."""
    return F.get(F.transform(F.array(array), made), F.lit(0))


def _minima(grams: Column, run: int) -> Column:
    if run == 1:
        return F.array_distinct(grams)
    least = lambda i: F.least(*[F.get(grams, i + j) for j in range(run)])
    return F.array_distinct(F.transform(_places(grams, run), least))


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(size, gram, item_id) for every different window of the items."""
    words = items.select("item_id", word_hashes(F.col("text")).alias("words")).where(F.size("words") > 0)
    words = words.select("item_id", "words", F.least(F.size("words"), F.lit(window)).alias("size"))
    return _by_size(words, range(1, window + 1), lambda n: _grams(F.col("words"), n)).select("item_id", "size", F.explode("found").alias("gram")).distinct()


def _by_size(words: DataFrame, sizes, made) -> DataFrame:
    """``words`` with ``made(size)`` as ``found``, each row by the ``size`` it has."""
    found = None
    for n in sizes:
        found = F.when(F.col("size") == n, made(n)) if found is None else found.when(F.col("size") == n, made(n))
    return words.withColumn("found", found)


def _grams(words: Column, n: int) -> Column:
    return F.transform(_places(words, n), lambda i: _gram(words, i, n))


def _overlapped(covered: Column) -> Column:
    """The number of words under any of the (start, size) spans of a sorted array."""
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))

    def add(acc: Column, span: Column) -> Column:
        stop = span["start"] + span["size"]
        more = F.greatest(F.lit(0), stop - F.greatest(acc["end"], span["start"]))
        return F.struct((acc["total"] + more).alias("total"), F.greatest(acc["end"], stop).alias("end"))

    return F.aggregate(covered, start, add, lambda acc: acc["total"])


def row_key(doc_id: Column, text: Column) -> Column:
    """What tells rows apart: a hash of id and text, each of which may be null."""
    return F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text)


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row per row of ``docs`` with the columns ``RESULT``. ``items``: item_id, text."""
    return _judged(docs, items, window, k, doc_id, text).select(*RESULT)


def without_contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the items."""
    hit = _judged(docs, items, window, k, doc_id, text).where("contaminated").select(F.col("key").alias("__key")).distinct()
    hit = stored(hit, "contaminated")
    return docs.join(sent(hit), row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")) == F.col("__key"), "left_anti")


def _judged(docs: DataFrame, items: DataFrame, window: int, k: int, doc_id: str, text: str) -> DataFrame:
    """The columns ``RESULT`` and the ``row_key`` of each row."""
    items = stored(items.select("item_id", "text"), "items")
    windows = stored(benchmark_windows(items, window), "windows")
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())  # ``window`` numbers at most
    item_words = items.select(word_hashes(F.col("text")).alias("words")).where(F.size("words") > 0)
    item_words = item_words.select("words", F.least(F.size("words"), F.lit(window)).alias("size"))
    known = _by_size(item_words, range(1, window + 1), lambda n: fingerprints(F.col("words"), n, k))
    known = stored(known.select("size", F.explode("found").alias("mark")).distinct(), "marks")

    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    keyed = texts.withColumn("key", row_key(F.col("doc_id"), F.col("text")))  # rows of one id and text have one result
    rows = suspected(keyed, stored(loose_marks(items, window, k), "loose"), sizes, k)
    rows = stored(rows, "suspects")
    suspects = rows.where("suspect").select("key")
    found = _hits(keyed, stored(suspects.distinct(), "suspected"), known, windows, sizes, k)
    by_text = found.groupBy("key")
    hit = by_text.agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans"))
    named = found.join(windows, ["size", "gram"]).where("item_id is not null").select("key", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    result = rows.join(hit, "key", "left").join(named, "key", "left")
    none = F.array().cast("array<string>")
    n_hit = F.coalesce(_overlapped(F.col("spans")), F.lit(0)).cast("long")
    result = result.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))  # repeated rows stay
    return result.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", none)), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "key",
    )


def _loose_words(text: Column) -> Column:
    """The words in lower case of every alphabet: texts that share words share these too.

    A capital sigma is the one letter whose small form depends on what stands beside it; it is made small beforehand.
    """
    return F.array_remove(F.split(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("Σ"), F.lit("σ"))), BETWEEN), "")


def suspected(keyed: DataFrame, known: DataFrame, sizes: list[int], k: int) -> DataFrame:
    """(doc_id, key, n_words, suspect, rows): whether a text shares a fingerprint, and how many rows have it.

    ``keyed``: doc_id, text, key.

    ``known``: size, mark, of loose words. A row per word, with the hashes of the words around it: its
    grams and their minimum, which goes on where it is new, are compiled code.
    """
    words = keyed.select("doc_id", "key", F.transform(_loose_words(F.col("text")), lambda w: F.xxhash64(w)).alias("words"))
    none = F.array(F.lit(None).cast("long"))
    marks = None
    for n in sizes or [WINDOW]:
        part = min(k, n)
        run = n - part + 1
        # A row per word: the one before it, itself and those after it; and one for the end.
        shifted = [F.concat(none, "words"), *[F.slice("words", j + 1, F.size("words")) for j in range(n)]]
        around = [f"h{j}" for j in range(-1, n)]
        near = words.select("doc_id", "key", F.size("words").alias("n_words"), F.inline(F.arrays_zip(*shifted)).alias(*around))
        gram = [F.xxhash64(*[F.col(f"h{i + j}") for j in range(part)]) for i in range(-1, run)]
        before, mark = (F.least(*gram[i : i + run]) if run > 1 else gram[i] for i in (0, 1))
        whole, first = F.col(f"h{n - 1}").isNotNull(), F.col("h-1").isNull()
        # The first word stays in any case, so that every text keeps a row.
        new = first | (whole & (mark != before))
        row = F.lit(marks is None) & first
        own = near.where(new).select(
            "doc_id", "key", "n_words", row.cast("int").alias("row"), F.lit(n).alias("size"), F.when(whole, mark).alias("mark")
        )
        marks = own if marks is None else marks.union(own)
    matched = marks.join(known.withColumn("hit", F.lit(True)), ["size", "mark"], "left")
    # All marks of a text come from one task, which reduces them to a row before anything is shuffled.
    return matched.groupBy("doc_id", "key", "n_words").agg(F.coalesce(F.max("hit"), F.lit(False)).alias("suspect"), F.sum("row").alias("rows"))


def loose_marks(items: DataFrame, window: int, k: int) -> DataFrame:
    """(size, mark) of the items' loose words, as ``suspected`` has them."""
    words = items.select(_loose_words(F.col("text")).alias("loose")).where(F.size("loose") > 0)
    words = words.select(F.transform("loose", lambda w: F.xxhash64(w)).alias("words"), F.least(F.size("loose"), F.lit(window)).alias("size"))

    def made(n: int) -> Column:
        part = min(k, n)
        grams = F.transform(_places(F.col("words"), part), lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(part)]))
        return _once(grams, lambda g: _minima(g, n - part + 1))

    return _by_size(words, range(1, window + 1), made).select("size", F.explode("found").alias("mark")).distinct()


def _around(reach: int):
    """For a place: its mark, and the windows from ``reach`` places before it to itself.

    Each place brings its own few windows, so that no whole array is copied per place.
    """

    def about(i: Column) -> Column:
        first = F.greatest(i - reach, F.lit(0))
        return F.struct(F.get("marks", i).alias("mark"), first.alias("from"), F.slice("grams", first + 1, F.lit(reach + 1)).alias("near"))

    return about


def _hits(keyed: DataFrame, suspects: DataFrame, known: DataFrame, windows: DataFrame, sizes: list[int], k: int) -> DataFrame:
    """(key, start, size, gram): the windows of suspected texts that the benchmark has.

    A fingerprint met at word i is extended to the windows that hold it.
    """
    again = keyed.join(sent(suspects), "key", "left_semi").dropDuplicates(["key"])
    words = again.select("key", word_hashes(F.col("text")).alias("words"))
    out = None
    for n in sizes:
        part = min(k, n)
        full = words.select("key", _grams(F.col("words"), part).alias("marks"), _grams(F.col("words"), n).alias("grams"))
        places = F.when(F.size("marks") > 0, F.sequence(F.lit(0), F.size("marks") - 1)).otherwise(F.array().cast("array<int>"))
        around = full.select("key", F.inline(F.transform(places, _around(n - part))))
        marks = known.where(F.col("size") == n).select("mark")
        near = around.join(marks, "mark", "left_semi").select("key", "from", F.posexplode("near").alias("i", "gram"))
        near = near.select("key", (F.col("from") + F.col("i")).alias("start"), F.lit(n).alias("size"), "gram").distinct()
        out = near if out is None else out.union(near)
    if out is None:
        return suspects.select("key", F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit(0).cast("long").alias("gram")).where("false")
    return stored(out.join(windows.select("size", "gram").distinct(), ["size", "gram"], "left_semi").select("key", "start", "size", "gram"), "hits")
