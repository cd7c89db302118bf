"""String expressions that follow Python's text rules where Spark's defaults differ."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from carepanel.functions.numeric import as_col

# The characters Python's str.strip() treats as white space.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# d: only \n ends a line, so "." and "$" mean what they mean in Python. U: \b, \s and \d know Unicode.
LINE_RULE = "(?dU)"


def strip(value: Column | str) -> Column:
    return F.btrim(as_col(value), F.lit(WHITE_SPACE))


def matches(value: Column, pattern: str) -> Column:
    return value.rlike(LINE_RULE + pattern)


def matches_any(value: Column, patterns: list[str]) -> Column:
    """One alternation instead of one scan of the text per pattern."""
    return matches(value, "|".join(f"(?:{p})" for p in patterns))


def find_all(value: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(value, F.lit(LINE_RULE + pattern), F.lit(group))


def title_case(value: Column) -> Column:
    """Upper-case every letter that follows a non-letter; ``initcap`` only looks at spaces."""
    runs = find_all(value, r"\p{L}+|\P{L}+")
    return F.array_join(F.transform(runs, F.initcap), "")


def window_before(text: Column, position: Column, width: int) -> Column:
    """Up to ``width`` characters of ``text`` just before the 1-based ``position``."""
    start = F.greatest(F.lit(1), position - F.lit(width))
    length = F.least(F.lit(width), position - F.lit(1))
    return F.substring(text, start, length)


def compact(items: list[Column]) -> Column:
    """Array of the non-null items, in order."""
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A one-element ``transform`` binds it to a lambda variable. Referring to a column instead would let
    the optimizer inline its expression into inner lambdas, where it would run once per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
