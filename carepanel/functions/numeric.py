"""Rounding, banding and ratio expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def rounded(value: Column | str, digits: int) -> Column:
    """Round half to even at ``digits`` decimals (``round`` in Spark is half up)."""
    scale = float(10**digits)
    return F.rint(as_col(value).cast("double") * scale) / scale


# What counts as a number: no type suffixes, hexadecimals, NaN or Infinity, which a plain cast would take.
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
WHOLE_NUMBER = r"^[+-]?\d+(\.0*)?$"


def plain_number(text: Column | str) -> Column:
    """Text that reads as a finite decimal number as double, else null; white space around it is allowed."""
    trimmed = F.trim(as_col(text))
    number = F.when(trimmed.rlike(PLAIN_NUMBER), trimmed.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def whole_number(text: Column | str) -> Column:
    """Text that reads as a whole number as bigint, so that long ids stay exact; else null."""
    trimmed = F.trim(as_col(text))
    return F.when(trimmed.rlike(WHOLE_NUMBER), F.substring_index(trimmed, ".", 1).try_cast("bigint"))


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, null when the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent(num: Column, den: Column, digits: int = 1) -> Column:
    return rounded(ratio(num, den) * 100.0, digits)


def flag(condition: Column) -> Column:
    """0/1 integer that stays null when the condition is unknown."""
    return condition.cast("int")


def sure_flag(condition: Column) -> Column:
    """0/1 integer; unknown counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def weighted_sum(terms: list[tuple[Column, float]]) -> Column:
    return reduce(lambda a, b: a + b, [value * F.lit(weight) for value, weight in terms])


def right_closed_band(
    value: Column | str,
    edges: list[float],
    labels: list[str],
    include_lowest: bool = False,
) -> Column:
    """Label of the band ``(edges[i], edges[i+1]]`` holding the value, null outside all bands.

    ``include_lowest`` also puts ``edges[0]`` itself in the first band.
    """
    v = as_col(value)
    band = F.when(v < edges[0] if include_lowest else v <= edges[0], F.lit(None))
    for upper, label in zip(edges[1:], labels):
        band = band.when(v <= upper, F.lit(label))
    return band


def any_true(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
