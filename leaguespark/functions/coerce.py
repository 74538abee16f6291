"""Coercions of loosely typed captures, with null where a value can't be read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefix_int(text: Column) -> Column:
    """The whole number a text starts with: ``12abc`` is 12, ``FO`` is null."""
    return F.regexp_extract(text, r"^\s*([+-]?[0-9]+)", 1).try_cast("int")


def loose_bool(text: Column) -> Column:
    return F.when(F.lower(text).isin("1", "true"), True).when(F.lower(text).isin("0", "false"), False)


def sum_known(*columns: Column) -> Column:
    """The sum of what is known; null where nothing is."""
    known = F.lit(False)
    for c in columns:
        known = known | c.isNotNull()
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(c, F.lit(0))
    return F.when(known, total)


def ratio(part: Column, whole: Column) -> Column:
    """A quotient that is null instead of failing on a zero."""
    return part / F.nullif(whole, F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas or an explode would ask for it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
