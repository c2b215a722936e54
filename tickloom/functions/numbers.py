"""Tolerant numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_double(text: Column | str) -> Column:
    """Number or NULL; never an error."""
    return (F.col(text) if isinstance(text, str) else text).try_cast("double")


def ratio(numerator: Column, denominator: Column, round_to: int | None = None) -> Column:
    """Quotient, NULL for a zero divisor, rounded half up when asked."""
    value = F.try_divide(numerator, denominator)
    return value if round_to is None else F.round(value, round_to)
