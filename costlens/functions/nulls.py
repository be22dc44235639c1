"""Missing-value expressions: NaN and null are both "missing" for measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.DoubleType, T.FloatType)


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _FLOATING)


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the column type can hold one."""
    column = F.col(name)
    return column.isNull() | F.isnan(column) if is_floating(df, name) else column.isNull()


def clean(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null; other types pass through."""
    column = F.col(name)
    return nan_to_null(column) if is_floating(df, name) else column


def nan_to_null(column: Column) -> Column:
    return F.nanvl(column, F.lit(None).cast("double"))


def is_finite(column: Column) -> Column:
    return column.isNotNull() & ~F.isnan(column) & (F.abs(column) != F.lit(float("inf")))


def present(names, df: DataFrame) -> list[str]:
    """The optional columns that this frame really has."""
    return [name for name in names if name in df.columns]
