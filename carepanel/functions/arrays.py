"""Turning arrays into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, value: Column, alias: str) -> DataFrame:
    """Adds a costly column that later filters use without computing it again.

    Filters on a plain derived column are pushed below it with its expression copied in; they cannot
    pass a generator.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(alias))


def to_rows(df: DataFrame, array: Column, *keep: str, alias: str = "item", position: str | None = None) -> DataFrame:
    """One row per array element; rows with an empty array disappear.

    A plain ``explode`` makes the optimizer add a ``size(array) > 0`` filter below it, which computes a
    costly array a second time. The outer form with a filter on its output computes it once.
    """
    if position:
        out = df.select(*keep, F.posexplode_outer(array).alias(position, alias))
    else:
        out = df.select(*keep, F.explode_outer(array).alias(alias))
    return out.where(F.col(alias).isNotNull())
