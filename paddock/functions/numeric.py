"""Numeric coercion that yields NULL where a value has no number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def to_double(column: Column) -> Column:
    """Number in ``column`` as double; NULL for text without one and for NaN."""
    value = column.try_cast("double")
    return F.when(~F.isnan(value), value)


def finite(column: Column) -> Column:
    """NULL for NaN and both infinities."""
    return F.when(~(F.isnan(column) | (F.abs(column) == float("inf"))), column)


def sanitize_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and infinities to NULL in every floating column, nested ones included."""
    return df.select(
        *[_sanitized(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def _sanitized(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return finite(column)
    if isinstance(dtype, T.ArrayType) and _has_float(dtype):
        return F.transform(column, lambda item: _sanitized(item, dtype.elementType))
    if isinstance(dtype, T.MapType) and _has_float(dtype.valueType):
        return F.transform_values(column, lambda _, item: _sanitized(item, dtype.valueType))
    if isinstance(dtype, T.StructType) and _has_float(dtype):
        fields = [_sanitized(column[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def _has_float(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_float(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_float(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_has_float(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as double, NULL where it holds no number."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.StringType):
        # the cast would read a trailing type letter ("12d") as part of a number
        column = F.when(~column.rlike(r"\d\s*[dDfF]\s*$"), column)
    return to_double(column)
