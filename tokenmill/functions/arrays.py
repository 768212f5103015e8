"""Expressions on token arrays: shift, truncate, pad, mask."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmill import constants as C


def repeat(value: int, n: Column) -> Column:
    return F.array_repeat(F.lit(value), n.cast("int"))


def head(array: Column, n: int | Column) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.slice(array, F.lit(1), n)


def last(array: Column, n: int | Column) -> Column:
    """The last ``n`` entries, all of them when there are fewer."""
    size, n = F.size(array), F.lit(n) if isinstance(n, int) else n
    return F.slice(array, F.greatest(size - n, F.lit(0)) + 1, F.least(size, n))


def inputs(array: Column) -> Column:
    return F.slice(array, F.lit(1), F.greatest(F.size(array) - 1, F.lit(0)))


def targets(array: Column) -> Column:
    return F.slice(array, F.lit(2), F.greatest(F.size(array) - 1, F.lit(0)))


def pad(array: Column, size: int, value: int) -> Column:
    return F.concat(array, repeat(value, F.greatest(F.lit(size) - F.size(array), F.lit(0))))


def ignore_masked(target: Column, mask: Column) -> Column:
    """Targets whose mask is 0 become the ignore index."""
    return F.zip_with(target, mask, lambda y, m: F.when(m == 0, F.lit(C.IGNORE_INDEX)).otherwise(y))


def digest(array: Column) -> Column:
    """md5 of the entries written as a JSON array, to compare long arrays."""
    return F.md5(F.to_json(array))
