"""Salary expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.text import PLACEHOLDERS, text


def coerce(c: Column) -> Column:
    """Lower bound of a published salary: a ``k`` amount first, else the first number; null unless positive."""
    t = F.trim(text(c))
    k = F.regexp_extract(t, r"(\d+(?:\.\d+)?)\s*[kK]\b", 1).try_cast("double") * 1000
    number = F.regexp_replace(F.regexp_extract(t, r"(-?\d+(?:[\d,]*)(?:\.\d+)?)", 1), ",", "").try_cast("double")
    plain = t.try_cast("double")
    value = F.when(F.lower(t).isin(*PLACEHOLDERS, "true", "false"), F.lit(None).cast("double")).otherwise(F.coalesce(plain, k, number))
    return F.when((value > 0) & ~F.isnan(value) & (value < float("inf")), value)


def number(c: Column) -> Column:
    return F.regexp_replace(F.trim(text(c)), ",", "").try_cast("double")


def high(low: Column, top: Column) -> Column:
    """Top of a range; its bottom if the top is missing or zero."""
    t = number(top)
    return F.coalesce(F.when(t != 0, t), number(low))


def truthy(c: Column) -> Column:
    return F.lower(F.trim(text(c))).isin("1", "true", "yes", "y")


def truthy_plain(c: Column) -> Column:
    """As :func:`truthy`, without the short form."""
    return F.lower(text(c)).isin("true", "1", "yes")


def finite(c: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def pay_range(mins: Column, maxs: Column) -> tuple[Column, Column]:
    """Whole units of the least minimum and largest maximum of arrays of cents; zeros and nulls don't count."""
    units = lambda a: F.filter(F.transform(a, lambda x: F.floor(x / 100)), lambda x: x.isNotNull() & (x != 0))
    return F.array_min(units(mins)), F.array_max(units(maxs))
