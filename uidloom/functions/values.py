"""Column functions on values: text, flags, percents, column lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

from uidloom.functions.fixed import TRUE_WORDS

_SPACE_RANGES = ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                 (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
WHITE_SPACE = "".join(chr(c) for low, high in _SPACE_RANGES for c in range(low, high + 1))


def collapse_spaces(text: Column) -> Column:
    """Strip white space at both ends and turn each inner run of it into one blank.

    White space is what Unicode calls so, and the four separators 1C to 1F of ASCII. All of it becomes blanks in
    one pass over a table of characters; the pattern then looks for two blanks only, which is rare in most texts.
    """
    blanks = F.translate(text, WHITE_SPACE, " " * len(WHITE_SPACE))
    return F.trim(F.regexp_replace(blanks, "  +", " "))


def to_bool(text: Column) -> Column:
    """True for yes, true, t and 1 in any case; a cast would also take ``y``."""
    return F.lower(text).isin(*TRUE_WORDS)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, 0.0 if ``whole`` is 0."""
    return F.when(whole > 0, part.cast("double") * 100 / whole).otherwise(F.lit(0.0))


def thousands(n: Column) -> Column:
    """``1234`` to ``1,234``; for reports only."""
    return F.format_number(n, 0)


def join_columns(columns: Column) -> Column:
    """An array of column names to ``a-b-c`` in sorted order."""
    return F.array_join(F.array_sort(columns), "-")


def split_columns(joined: Column) -> Column:
    return F.split(joined, "-")


def append_column(columns: Column, name: str | Column) -> Column:
    return F.array_append(columns, F.lit(name) if isinstance(name, str) else name)


def is_empty_list(values: Column) -> Column:
    """True for a null or empty array."""
    return F.coalesce(F.size(values), F.lit(0)) <= 0


def all_equal(columns: Sequence[Column]) -> Column:
    """True where all columns hold one value; null counts as no value."""
    first, *others = columns
    return reduce(and_, [first == other for other in others])
