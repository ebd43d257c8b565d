"""Column functions on table names, query names and report labels."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from uidloom.functions.fixed import PUBLIC_PREFIX


def encode_table(name: Column, prefix: str = PUBLIC_PREFIX) -> Column:
    """``A.B.C`` to ``A__B__C``; the public prefix is removed wherever it occurs."""
    return F.replace(F.replace(name, F.lit(prefix), F.lit("")), F.lit("."), F.lit("__"))


def decode_table(name: Column, prefix: str = PUBLIC_PREFIX) -> Column:
    """``A__B__C`` to ``A.B.C``; a name of one part gets the public prefix."""
    dotted = F.replace(name, F.lit("__"), F.lit("."))
    return F.when(F.contains(dotted, F.lit(".")), dotted).otherwise(F.concat(F.lit(prefix), dotted))


def uuid_column_of(query_name: Column) -> Column:
    """``user_id_query`` to ``USER_ID_UUID``."""
    return F.replace(F.upper(F.concat(query_name, F.lit("_uuid"))), F.lit("_QUERY"), F.lit(""))


def query_name_of(uuid_column: Column) -> Column:
    """``USER_ID_UUID`` to ``user_id_query``."""
    return F.lower(F.replace(F.upper(uuid_column), F.lit("UUID"), F.lit("QUERY")))


def contains_any(name: Column, parts: Iterable[str]) -> Column:
    """True where the name contains one of the parts, case-sensitive."""
    return reduce(or_, [F.contains(name, F.lit(part)) for part in parts], F.lit(False))


def contains_none(name: Column, parts: Iterable[str]) -> Column:
    return ~contains_any(name, parts)


def combo_label(table: Column, combo: Column) -> Column:
    """``table@A-B``."""
    return F.concat_ws("@", table, F.upper(combo))


def column_label(table: Column, column: Column) -> Column:
    """``table @ COLUMN``."""
    return F.concat_ws(" @ ", table, F.upper(column))


def label_table(label: Column) -> Column:
    return F.trim(F.split_part(label, F.lit("@"), F.lit(1)))


def label_columns(label: Column) -> Column:
    """The column names of either kind of label, lower case."""
    return F.split(F.lower(F.trim(F.split_part(label, F.lit("@"), F.lit(2)))), "-")
