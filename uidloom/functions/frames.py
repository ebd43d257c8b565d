"""Projections and filters of a whole frame."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def has_column(df: DataFrame, name: str) -> bool:
    return name.lower() in {c.lower() for c in df.columns}


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of the names that the frame has, in the given order."""
    return [name for name in names if has_column(df, name)]


def select_tracked(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*present(df, columns))


def complete_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows in which none of the columns is null."""
    return df.dropna(how="any", subset=present(df, columns))


def rows_with(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def rows_without(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def add_string_column(df: DataFrame, name: str, default: str | None = None) -> DataFrame:
    """Add a nullable string column if the frame lacks it; all rows get the default."""
    return df if has_column(df, name) else df.withColumn(name, F.lit(default).cast("string"))


def reset_column(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.lit(None).cast("string"))


def stamp(df: DataFrame, name: str, at: datetime | str | Column) -> DataFrame:
    """Add the time of a run, given by the caller so that a second run gives the same rows."""
    return df.withColumn(name, at if isinstance(at, Column) else F.lit(at).cast("timestamp"))


def as_records(df: DataFrame, name: str = "record") -> DataFrame:
    """Each row as one struct; the rows stay on the executors."""
    return df.select(F.struct(*df.columns).alias(name))


def is_empty(df: DataFrame | None) -> bool:
    return df is None or df.isEmpty()


def frame_length(df: DataFrame | None) -> int:
    return 0 if df is None else df.count()


def hashable(df: DataFrame) -> list[str]:
    """The quoted names of the columns that a hash can take."""
    return [f"`{name}`" for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
