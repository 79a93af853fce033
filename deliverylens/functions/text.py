"""Text and number clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(value: Column) -> Column:
    """Text without outer blanks, in lower case."""
    return F.lower(F.trim(value))


def to_number(value: Column) -> Column:
    """Double; text that is no number, and NaN, become null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def finite(number: Column) -> Column:
    """The number, or null when it is NaN or infinite."""
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number)
