"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Only these types can render as an all-space string, so only they need the blank test.
_CAN_BE_BLANK = (T.StringType, T.CharType, T.VarcharType, T.BinaryType)


def c(name: str) -> Column:
    """A top-level column by its exact name, dots and slashes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def blank_as_null(name: str) -> Column:
    return F.when(F.trim(c(name)) != "", c(name)).alias(name)


def is_missing(field: T.StructField, blank_is_missing: bool) -> Column:
    column = c(field.name)
    if blank_is_missing and isinstance(field.dataType, _CAN_BE_BLANK):
        return column.isNull() | (F.trim(column.cast("string")) == "")
    return column.isNull()


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole * 100``; 0.0 when there is nothing to divide by."""
    share = F.coalesce(F.try_divide(part, whole) * F.lit(100.0), F.lit(0.0))
    return share if digits is None else F.round(share, digits)


def sprintf(template: str, *values: Column) -> Column:
    return F.format_string(template, *values)
