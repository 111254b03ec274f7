"""Text rendering helpers that fix how values look once they leave the engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_TIMES = {"timestampFormat": ISO_MICROS, "timestampNTZFormat": ISO_MICROS}
JSON_MESSAGE = {**JSON_TIMES, "ignoreNullFields": "false"}


def float_text(value: Column) -> Column:
    """A double as text, with plain digits from 1e-4 up to 1e16 (Spark's own text: from 1e-3 up to 1e7).

    The digits in between go through a decimal, whose digits are those of the double's own text. The
    rest stays in Spark's notation until :func:`short_exponents` goes over the finished text: done
    per number, several numbers would make a compiled method larger than the JVM optimizes.
    """
    size = F.abs(value)
    plain = F.regexp_replace(value.try_cast("decimal(38,20)").cast("string"), r"(\.\d+?)0*$", "$1")
    wide = size.between(1e-4, 1e-3) | size.between(1e7, 1e16 - 2)
    return F.when(wide, plain).otherwise(value.cast("string"))


def short_exponents(text: Column) -> Column:
    """Numbers inside a text in the short notation: ``5.0E-5`` as ``5e-05``, ``NaN`` as ``nan``.

    The text must have no other upper-case E.
    """
    short = text
    for pattern, replacement in (
        (r"(\.0)?E", "e"),
        (r"e(\d)", "e+$1"),
        (r"(e[+-])(\d)(?!\d)", "$10$2"),
        (r"NaN", "nan"),
        (r"Infinity", "inf"),
    ):
        short = F.regexp_replace(short, pattern, replacement)
    # Plain searches decide: a pattern match on every text would cost more than all the rest.
    wordy = text.contains("E") | text.contains("NaN") | text.contains("Inf")
    return F.when(wordy, short).otherwise(text)


def bool_text(flag: Column) -> Column:
    """Lower-case boolean text; an unknown flag prints ``none``."""
    return F.coalesce(flag.cast("string"), F.lit("none"))


def or_none(text: Column) -> Column:
    return F.coalesce(text, F.lit("None"))


def epoch_seconds(time: Column) -> Column:
    """Whole seconds since 1970, cut towards zero (also before 1970)."""
    return F.call_function("div", F.unix_micros(time), F.lit(1_000_000).cast("bigint"))
