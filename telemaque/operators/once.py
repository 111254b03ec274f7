"""Keep an expensive expression from being evaluated more than once per row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expand_once(struct: Column, keep: Sequence[str] = ()) -> Callable[[DataFrame], DataFrame]:
    """``keep`` next to the fields of ``struct``, which is evaluated exactly once per row.

    The optimizer moves a filter (also the not-null filter of a join key) below the projection that
    computes its column by copying the expression, so a JSON parse would run once for the filter
    and once more for the rows. It does not move filters below a generator; a one-element array
    makes the struct one. A NULL struct gives a row of NULLs.
    """
    return lambda df: df.select(*keep, F.array(struct).alias("_once")).select(*keep, F.inline_outer("_once"))
