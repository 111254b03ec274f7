"""Time-bounded joins by key, made so that one key with very many rows still spreads out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from telemaque.operators.codec import Transform

HOUR_S = 3600
SALTS = 16
#: Bounds in a slot of time: wide slots make fewer copies of right rows, narrow ones spread a busy key further.
SLOT_BOUNDS = 4


def micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def interval_join(
    right: DataFrame, keys: tuple[str, str], times: tuple[str, str], within_s: int
) -> Transform:
    """Rows of equal key whose times lie at most ``within_s`` seconds apart.

    Time is cut into slots ``SLOT_BOUNDS`` times as wide as the bound (a second at least); each right row is put into
    the slots that its bound reaches, one or two, so the equality join runs on key and slot and a busy key is spread
    over its slots. Every pair meets in exactly one slot, the left row's. On streams, set watermarks on both sides:
    the bound lets Spark drop state.
    """
    (left_key, right_key), (left_time, right_time) = keys, times

    def slot(time: str, shift_s: int = 0) -> Column:
        return F.call_function("floor", (F.unix_seconds(F.col(time).cast("timestamp")) + shift_s) / F.lit(max(within_s, 1) * SLOT_BOUNDS))

    # A second more on either side: times have parts of seconds.
    reached = F.array_distinct(F.array(slot(right_time, -within_s - 1), slot(right_time, within_s + 1)))
    spread = right.withColumn("_slot_r", F.explode(reached))
    bound = F.expr(f"interval '{within_s}' second")
    near = F.col(left_time).between(F.col(right_time) - bound, F.col(right_time) + bound)

    def apply(left: DataFrame) -> DataFrame:
        same = (F.col(left_key) == F.col(right_key)) & (F.col("_slot_l") == F.col("_slot_r"))
        return left.withColumn("_slot_l", slot(left_time)).join(spread, same & near).drop("_slot_l", "_slot_r")

    return apply


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[Column, str]], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Batch. ``left`` joined with at most one row of ``right`` per key, whose key columns are dropped.

    ``on`` gives the left expression of each key column of ``right``. A key with very many left rows is
    spread over ``salts`` tasks, to which its right row is copied. Runtime splitting of skewed joins can't
    do that where the right side is an aggregate by the same key, as it then has no exchange of its own.
    """
    copies = right.withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Names of their own, so that no column of the left side clashes.
    names = {name: f"_{i}_r" for i, (_, name) in enumerate(on)}
    copies = copies.withColumnsRenamed(names)
    salted = left.withColumn("_salt_l", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    same = F.col("_salt_l") == F.col("_salt_r")
    for expression, name in on:
        same = same & (expression == F.col(names[name]))
    return salted.join(copies, same, how).drop("_salt_l", "_salt_r", *names.values())


def interval_totals(
    marks: DataFrame,
    keys: tuple[str, str],
    times: tuple[str, str],
    within_s: int,
    measures: Mapping[str, Column],
) -> Transform:
    """Batch. Add to each left row the sums of ``measures`` over the marks within the bound.

    The same sums as grouping :func:`interval_join` by left row (0 where it has none, or no key or
    time), at a cost that grows with the rows and not with the pairs. A running sum over the marks of
    a key is read at both ends of the bound and the two readings subtracted.

    The running sum has three levels: instants within a second, seconds within an hour, hours within
    a key, each starting from the total of what came before. Copies, that is marks or left rows of one
    key and instant, are first made one. So no task sorts more than the instants of one second, 3600
    seconds, or the hours of a key's history, whatever the tables.
    """
    (left_key, right_key), (left_time, right_time) = keys, times
    names = list(measures)
    bound = within_s * 1_000_000

    def instants(df: DataFrame, key: str, time: str, *more: Column) -> DataFrame:
        placed = df.where(F.col(key).isNotNull() & F.col(time).isNotNull())
        return placed.select(F.col(key).alias("key"), micros(time).alias("at"), *more)

    def summed(df: DataFrame, *group: str) -> DataFrame:
        return df.groupBy(*group).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])

    def start(seconds: int) -> Column:
        return F.col("at") - F.pmod(F.col("at"), F.lit(seconds * 1_000_000).cast("bigint"))

    def before(group: Sequence[str], order: str) -> list[Column]:
        earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}") for n in names]

    values = [F.coalesce(value, F.lit(0)).cast("bigint").alias(name) for name, value in measures.items()]
    entries = instants(marks, right_key, right_time, *values)

    def readings(at: DataFrame) -> DataFrame:
        # side orders equal times: what is carried over, the lower reading, the marks, the upper reading.
        lower = F.struct((F.col("read_at") - bound).alias("at"), F.lit(0).alias("side"))
        upper = F.struct((F.col("read_at") + bound).alias("at"), F.lit(2).alias("side"))
        return at.withColumnRenamed("at", "read_at").select("key", "read_at", F.inline(F.array(lower, upper)))

    def apply(left: DataFrame) -> DataFrame:
        wanted = instants(left, left_key, left_time)
        line = readings(wanted.distinct()).unionByName(
            summed(entries, "key", "at").withColumn("side", F.lit(1)), allowMissingColumns=True
        )
        line = line.withColumns({"hour": start(HOUR_S), "second": start(1)})
        seconds = summed(line, "key", "hour", "second")
        hours = summed(seconds, "key", "hour")
        of_hours = hours.select("key", "hour", *before(["key"], "hour"))
        of_seconds = seconds.select("key", "hour", "second", *before(["key", "hour"], "second"))
        carried = of_seconds.join(of_hours.withColumnsRenamed({f"_{n}": f"_{n}_h" for n in names}), ["key", "hour"]).select(
            "key",
            "hour",
            "second",
            F.col("second").alias("at"),
            F.lit(-1).alias("side"),
            *[(F.col(f"_{n}") + F.col(f"_{n}_h")).alias(n) for n in names],
        )
        so_far = (
            Window.partitionBy("key", "second")
            .orderBy("at", "side")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        sign = F.when(F.col("side") == 2, 1).otherwise(-1)
        read = (
            line.unionByName(carried, allowMissingColumns=True)
            .select("key", "read_at", "side", *[F.sum(n).over(so_far).alias(n) for n in names])
            .where(F.col("side").isin(0, 2))
            .select("key", "read_at", *[(sign * F.col(n)).alias(n) for n in names])
        )
        sums = summed(read, "key", "read_at")
        joined = salted_join(left, sums, [(F.col(left_key), "key"), (micros(left_time), "read_at")], "left")
        return joined.select(*left.columns, *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names])

    return apply
