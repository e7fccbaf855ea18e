"""Numeric column expressions. All are native and null-preserving."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what counts as a number in text. Type suffixes such as 1.0d do not.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def clean_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def coerce_numeric(c: Column, dtype: T.DataType | None = None) -> Column:
    """Text to double; anything that is not a number becomes null, never NaN."""
    if dtype is not None and isinstance(dtype, (T.FloatType, T.DoubleType)):
        return clean_nan(c.cast("double"))
    if dtype is not None and isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def mixed_label(raw: Column, number: Column) -> Column:
    """The text of a mixed column where it holds no number."""
    return F.when(number.isNull(), raw.cast("string"))


def nonnegative_or_null(c: Column) -> Column:
    return F.when(c >= 0, c)


def in_range_or_null(c: Column, low: float, high: float) -> Column:
    return F.when(c.between(low, high), c)


def clip(c: Column, low: Column, high: Column) -> Column:
    """Clamp to [low, high]; a null stays null (least/greatest would replace it).
    A null bound leaves the value as it is."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, high), low))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio where both sides are positive, else null."""
    return F.when((numerator > 0) & (denominator > 0), F.try_divide(numerator, denominator))


def residual(actual: Column, predicted: Column) -> Column:
    return actual - predicted


def is_infinite(c: Column) -> Column:
    return c.isin(float("inf"), float("-inf"))


def z_score(c: Column, mean: Column, sd: Column) -> Column:
    """(c - mean) / sd; null for a constant column."""
    return F.when(sd != 0, (c - mean) / sd)
