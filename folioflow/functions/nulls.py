"""Missing values: null and the empty string both count as missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (c == "")


def first_match(value: Column, rules: list[tuple[str, object]], default: object = None) -> Column:
    """The result of the first rule whose key is a substring; order matters."""
    out = None
    for key, result in rules:
        hit = value.contains(key)
        out = F.when(hit, F.lit(result)) if out is None else out.when(hit, F.lit(result))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def all_of(conditions: list[Column]) -> Column:
    """Conjunction; no condition is always true."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is 0."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def count_if(c: Column) -> Column:
    """Rows for which the condition holds (0, never null)."""
    return F.count(F.when(c, F.lit(1)))
