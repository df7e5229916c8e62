"""Array helpers for token columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate(ids: Column, n: int) -> Column:
    return F.slice(ids, 1, n)


def pad_right(ids: Column, value: Column | int, length: Column | int) -> Column:
    """Append ``value`` until the array has ``length`` entries; longer ones stay."""
    value = value if isinstance(value, Column) else F.lit(value)
    length = length if isinstance(length, Column) else F.lit(length)
    missing = F.greatest(length - F.size(ids), F.lit(0)).cast("int")
    return F.concat(ids, F.array_repeat(value, missing))


def positions_of(ids: Column, value: Column | int) -> Column:
    """Zero-based positions at which ``value`` stands."""
    value = value if isinstance(value, Column) else F.lit(value)
    hits = F.transform(ids, lambda x, i: F.when(x == value, i).otherwise(F.lit(-1)))
    return F.filter(hits, lambda i: i >= 0)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def ones_like(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))
