"""Casts, ratios and sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# What a text must look like to be taken as a number, or as a timestamp without zone: a date, with or
# without a time. Zone offsets are refused, as the raw times have no zone.
NUMBER_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"


def checked_text(df: DataFrame, name: str, pattern: str) -> Column:
    """A column whose texts must match; others raise, as Spark casts some that the loader refuses.

    Columns of other types come as they are.
    """
    value = F.col(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        return value
    text = F.trim(value)
    bad = F.raise_error(F.concat(F.lit(f"{name}: bad value: "), text)).cast("string")
    return F.when(text.isNull() | text.rlike(pattern), text).otherwise(bad)


def whole_number(df: DataFrame, name: str) -> Column:
    """Cast a column to int, rounding fractions half away from zero; bad text raises."""
    kind = df.schema[name].dataType
    value = checked_text(df, name, NUMBER_TEXT)
    if isinstance(kind, T.StringType):
        value = value.cast("double")
    if isinstance(kind, (T.StringType, T.DoubleType, T.FloatType, T.DecimalType)):
        value = F.round(value)
    return value.cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives null for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))


def total(value: Column, exact: bool = False) -> Column:
    """Sum as double. ``exact`` adds in decimals of 6 digits, so row order has no effect.

    With ``exact`` every value is rounded to 6 decimals first, and one of 10^12 or more raises.
    """
    if exact:
        return F.sum(value.cast("decimal(18,6)")).cast("double")
    return F.sum(value.cast("double"))


def mean(value: Column, exact: bool = False) -> Column:
    """Average of the non-null values as double; see ``total`` for ``exact``."""
    if exact:
        return ratio(total(value, exact=True), F.count(value))
    return F.avg(value.cast("double"))
