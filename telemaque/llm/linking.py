"""From shared buckets to classes: verified links and connected components, all distributed.

Candidates are pairs of members of one bucket. Emitting all of them would be quadratic in a bucket of
near copies, so first one member of each bucket is held against all others, then a few more, and what is
linked becomes one class. Buckets of one class are done. In the others, pairs of different classes are
left. Small buckets have few of them, and all are tried. In large ones a caller can say which pairs can
still be links (``rest``); without that, all are tried there too. Members of one class need no link between
them, so the classes are those of all pairs. A caller's cheap necessary condition keeps hopeless pairs from
becoming rows.

Where members share many buckets, as lines do, ``classes_by_home`` holds a pair against each other in one of them only.

What is stored on the way goes when the ``passing`` block around it ends, shuffle files with the write that made them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemaque.workspace import fresh_dir, removed

#: With this on, Spark removes the shuffle files of a query when it ends, and not only when the driver's heap is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The folders of the ``passing`` blocks that are open, the innermost last.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())

#: Members of a bucket that are held against the others in the rounds before the last.
PIVOTS = (1, 8)
#: A bucket of at most so many members is small: a member has fewer pairs there than that.
FEW = 32
#: Members of a block, in which the members of a large bucket are held against each other: n of them go out n / BLOCK times each.
BLOCK = 512
#: Tasks in which blocks meet, at most, where there are more than shuffles have.
MEETING_TASKS = 1 << 12
#: Ids that may be sent to every task; more are joined by a shuffle of both sides.
SENT_IDS = 2_000_000


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is ``stored`` inside is removed at the end, but what is to be kept: the block around this one has that, or the caller."""
    folders: list[str] = []
    token = _open.set((*_open.get(), folders))
    try:
        yield
    finally:
        _open.reset(token)
        for folder in folders:
            removed(spark, folder)


def stored(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends, lost executors cost nothing.

    Inside a ``passing`` block it goes with the block, or with the block around that one if it is to be kept (``keep``).
    """
    folder = fresh_dir(df.sparkSession, label)
    blocks = _open.get()[:-1] if keep else _open.get()
    if blocks:
        blocks[-1].append(folder)
    with _cleaned(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def sent(wanted: DataFrame) -> DataFrame:
    """``wanted``, which is stored, to be joined to a larger table: sent to every task where it is small enough."""
    return F.broadcast(wanted) if wanted.count() <= SENT_IDS else wanted


def components(links: DataFrame) -> DataFrame:
    """(id, class_id) for each end of a link: the class is its smallest id. ``links``: a, b (longs).

    Every round each id is mapped to its smallest neighbour or itself and the graph is contracted
    along this map, which keeps what is connected; the smallest id of a class never moves.
    """
    edges = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while True:
        ends = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stored(ends.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("to")), "step")
        if labels is None:
            labels = step.withColumnRenamed("to", "class_id")
        else:
            labels = labels.join(step.withColumnRenamed("id", "class_id"), "class_id", "left").select(
                "id", F.coalesce("to", "class_id").alias("class_id")
            )
        labels = stored(labels, "labels")
        at_a, at_b = step.toDF("a", "to_a"), step.toDF("b", "to_b")
        moved = edges.join(at_a, "a").join(at_b, "b").where("to_a <> to_b")
        edges = stored(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return labels


def _seen(about: DataFrame) -> Callable[[str], DataFrame]:
    return lambda side: about.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in about.columns if c != "id"])


def classes(
    members: DataFrame,
    about: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    close: Callable[[str, str], Column],
    rest: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame | None:
    """(id, class_id) of the ``members`` of buckets that have a link; None where there is none.

    ``members``: bucket, id, pivot (boolean: one end of a pair at least must be one), each (bucket, id) once.
    ``about``: a row per id, with ``degree`` (those with the greatest are held against the others first) and columns for
    ``close``, which gives for two prefixes of column names a condition that every linked pair meets.
    ``verify`` takes pairs (a, b) and returns those that are links. ``rest`` takes the different members of large
    buckets (id, class_id and the columns of ``about``) and returns pairs (a, b), among them all links of
    different classes that share such a bucket. No pair is verified twice.
    """
    extra = [c for c in about.columns if c != "id"]
    seen = _seen(about)
    ranked = members.join(about.select("id", "degree"), "id")
    members = stored(ranked.select("bucket", "id", "pivot", "degree", F.col("id").alias("class_id")), "members")
    by_bucket = Window.partitionBy("bucket").orderBy(F.desc("degree"), "id")
    labels, links, tried = None, None, None

    for take in (*PIVOTS, None):
        if labels is not None:
            members = members.drop("class_id").join(labels, "id", "left")
            members = members.withColumn("class_id", F.coalesce("class_id", "id"))
            # Buckets of one class are done.
            kinds = members.groupBy("bucket").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi"))
            members = members.join(kinds.where("lo < hi").select("bucket"), "bucket", "left_semi")
            members = stored(members.select("bucket", "id", "pivot", "degree", "class_id"), "members")
        if take is not None:
            # A limit by rank is applied in each task before the shuffle: a large bucket sends few rows.
            left = members.where("pivot").withColumn("__rank", F.row_number().over(by_bucket)).where(F.col("__rank") <= take)
            left = left.select("bucket", F.col("id").alias("a"), F.col("class_id").alias("a_class"))
            both = left.join(members.select("bucket", F.col("id").alias("b"), F.col("class_id").alias("b_class")), "bucket")
            both = both.where("a_class <> b_class").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            pairs = both.join(seen("a"), "a").join(seen("b"), "b").where(close("a_", "b_")).select("a", "b")
        else:
            pairs = _remaining(members, about, close, rest)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            continue
        tried = pairs if tried is None else tried.union(pairs)
        found = stored(verify(pairs), "found")
        links = found if links is None else links.union(found)
        if not found.isEmpty():
            labels = components(links)
    return labels


def _remaining(members: DataFrame, about: DataFrame, close, rest) -> DataFrame:
    """The pairs of different classes in buckets that still have several."""
    more = None
    if rest is not None:
        large = stored(members.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > FEW).select("bucket"), "large")
        if not large.isEmpty():
            unresolved = members.join(large, "bucket", "left_semi").select("id", "class_id").dropDuplicates(["id"]).join(about, "id")
            more = rest(stored(unresolved, "unresolved"))
            members = members.join(large, "bucket", "left_anti")
    pairs = _pairs(members.drop("degree"), about, close)
    return (pairs if more is None else pairs.union(more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))).distinct()


def _pairs(members: DataFrame, about: DataFrame, close, apart: Column | None = None) -> DataFrame:
    """(a, b): the pairs of different classes in the buckets of ``members`` (bucket, id, pivot, class_id) that are ``close``, and ``apart``."""
    extra = [c for c in about.columns if c != "id"]
    known = stored(members.join(about, "id"), "known")
    left = known.where("pivot").select("bucket", *[F.col(c).alias(f"a_{c}") for c in ("id", "class_id", *extra)])
    right = known.select("bucket", *[F.col(c).alias(f"b_{c}") for c in ("id", "pivot", "class_id", *extra)])
    # Of two pivots the smaller one is the left end.
    wanted = (F.col("a_class_id") != F.col("b_class_id")) & ((F.col("a_id") < F.col("b_id")) | ~F.col("b_pivot")) & close("a_", "b_")
    pairs = left.join(right, (left["bucket"] == right["bucket"]) & (wanted if apart is None else wanted & apart))
    return pairs.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"))


def sized(members: DataFrame) -> DataFrame:
    """``members`` (bucket, id, pivot) of buckets of several, and the number ``n`` in each; stored."""
    counted = members.withColumn("n", F.count("*").over(Window.partitionBy("bucket")))
    return stored(counted.where("n > 1"), "sized")


def homes(members: DataFrame) -> DataFrame:
    """(id, degree, bucket): in how many buckets of ``sized`` a member is, and the largest of them, its home; stored."""
    largest = members.groupBy("id").agg(F.count("*").alias("degree"), F.max(F.struct("n", "bucket")).alias("home"))
    return stored(largest.select("id", "degree", F.col("home.bucket").alias("bucket")), "homes")


def classes_by_home(
    members: DataFrame,
    home: DataFrame,
    about: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    close: Callable[[str, str], Column],
    texts: DataFrame,
    hold: Callable[[pa.Table, np.ndarray, np.ndarray], np.ndarray],
) -> DataFrame | None:
    """(id, class_id) as from ``classes``, for members that share many buckets with each other.

    The pivots of a bucket are held only against those whose home it is: a row for each member, and not for each of its
    buckets. In the large buckets that still have several classes, the homes of their members come first: two members of
    one home are held against each other in the largest they share, block by block inside the tasks, so that only links
    become rows. The comparisons are still as many as there are such pairs. Pairs that share no home are left to their buckets.

    ``members`` as from ``sized``, ``home`` as from ``homes``; ``about``, ``verify`` and ``close`` as for ``classes``. ``hold`` tells which
    of the pairs (i, j) of a table's rows are links; its columns are those of ``about`` and of ``texts``, a row per id.
    """
    seen = _seen(about)
    by_bucket = Window.partitionBy("bucket").orderBy(F.desc("degree"), "id")
    # A limit by rank is applied in each task before the shuffle.
    ranked = stored(home.withColumn("rank", F.row_number().over(by_bucket)).where(F.col("rank") <= max(PIVOTS)), "ranked")
    labels, links, tried = None, None, None

    def classed(df: DataFrame) -> DataFrame:
        if labels is None:
            return df.withColumn("class_id", F.col("id"))
        return df.join(sent(labels), "id", "left").withColumn("class_id", F.coalesce("class_id", "id"))

    for take in (*PIVOTS, None):
        if take is not None:
            rows, left = classed(home), classed(ranked)
            left = left.where(F.col("rank") <= take).select("bucket", F.col("id").alias("a"), F.col("class_id").alias("a_class"))
            both = left.join(rows.select("bucket", F.col("id").alias("b"), F.col("class_id").alias("b_class")), "bucket")
            both = both.where("a_class <> b_class").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            pairs = both.join(seen("a"), "a").join(seen("b"), "b").where(close("a_", "b_")).select("a", "b")
        else:
            whole = Window.partitionBy("bucket")
            left = classed(members).withColumns({"lo": F.min("class_id").over(whole), "hi": F.max("class_id").over(whole)})
            left = stored(left.where("lo < hi").select("bucket", "id", "pivot", "n", "class_id"), "unresolved")  # buckets of one class are done
            pairs = _pairs(left.where(F.col("n") <= FEW).drop("n"), about, close).union(_of_large(left.where(F.col("n") > FEW), about, close, texts, hold))
            pairs = pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            continue
        tried = pairs if tried is None else tried.union(pairs)
        found = stored(verify(pairs), "found")
        links = found if links is None else links.union(found)
        if not found.isEmpty():
            labels = components(links)
    return labels


def _blocks(hold: Callable[[pa.Table, np.ndarray, np.ndarray], np.ndarray]):
    """Links between the members of two blocks of a home, or of one, that have not met in an earlier home: enough for their classes."""

    def meet(table: pa.Table) -> pa.Table:
        bucket, lo, hi = (table.column(c)[0].as_py() for c in ("bucket", "lo", "hi"))
        block, kind, ids = (table.column(c).to_numpy() for c in ("block", "class_id", "id"))
        lists = table.column("homes").to_pylist()
        earlier = {h: i for i, h in enumerate({h for x in lists for h in x[: x.index(bucket)]})}
        met = np.zeros((len(ids), len(earlier)), dtype=np.float32)
        for row, x in zip(met, lists, strict=True):
            row[[earlier[h] for h in x[: x.index(bucket)]]] = 1
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        new = (kind[left][:, None] != kind[right][None, :]) & (met[left] @ met[right].T == 0)
        if lo == hi:
            new &= ids[left][:, None] < ids[right][None, :]
        i, j = np.nonzero(new)
        i, j = left[i], right[j]
        kind, found = np.unique(kind, return_inverse=True)[1], [np.zeros((2, 0), dtype=np.int64)]
        mixed = np.random.default_rng(0).permutation(len(i))
        i, j = i[mixed], j[mixed]
        for by_class, take in ((False, 4), (False, 8), (True, 1), (True, 8), (True, None)):
            # So many pairs of each member, then of each two classes, then what is still of two.
            key = np.minimum(kind[i], kind[j]) * len(kind) + np.maximum(kind[i], kind[j]) if by_class else i
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            place = np.empty(len(i), dtype=np.int64)
            place[order] = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
            now = np.full(len(i), True) if take is None else place < take
            linked = np.flatnonzero(now)[hold(table, i[now], j[now])]
            for n in linked.tolist():
                x, y = kind[i[n]], kind[j[n]]
                if x != y:  # the links that join two classes are enough
                    kind[kind == y] = x
                    found.append(ids[[[i[n]], [j[n]]]])
            left_over = ~now & (kind[i] != kind[j])
            i, j = i[left_over], j[left_over]
        a, b = np.concatenate(found, axis=1)
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    return meet


def _of_large(members: DataFrame, about: DataFrame, close, texts: DataFrame, hold) -> DataFrame:
    """(a, b): the pairs of different classes in large buckets, one of them a pivot there, that can be links."""
    largest = members.groupBy("id").agg(F.max(F.struct("n", "bucket")).alias("home"))
    at_home = stored(largest.select("home.bucket").distinct(), "homes")
    listed = stored(members.join(sent(at_home), "bucket", "left_semi").select("bucket", "id", "n", "class_id"), "listed")
    # The homes that a member is in, in one order for all; the first is its own.
    found = listed.groupBy("id", "class_id").agg(F.sort_array(F.collect_list(F.struct("n", "bucket")), False).alias("found"))
    found = stored(found.select("id", "class_id", F.col("found.bucket").alias("homes")), "found")
    known = stored(found.join(about, "id").join(texts, "id"), "texts")
    extra = [c for c in known.columns if c != "id"]
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = listed.select("bucket", "id", blocks.alias("blocks")).join(known, "id").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    rows = rows.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other")
    # Few bytes, but much work: run-time merging of small partitions would leave all to one task.
    homes_of, by = listed.groupBy("bucket").agg(F.first(blocks).alias("blocks")), F.col("blocks").cast("long")
    meetings = homes_of.agg(F.sum(by * (by + 1) / 2)).first()[0] or 0
    wide = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(max(1, min(MEETING_TASKS, max(wide, int(meetings) // 4))), "bucket", "lo", "hi")
    pairs = rows.groupBy("bucket", "lo", "hi").applyInArrow(_blocks(hold), "a long, b long")
    strangers = (F.get("a_homes", F.lit(0)) != F.get("b_homes", F.lit(0))) & ~F.arrays_overlap("a_homes", "b_homes")
    slim = known.select("id", "homes", *[c for c in about.columns if c != "id"])
    return pairs.union(_pairs(members.drop("n"), slim, close, strangers))
