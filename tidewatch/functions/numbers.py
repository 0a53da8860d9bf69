"""Guarded arithmetic; ANSI mode raises on division by zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_of(value: Column, base: Column) -> Column:
    """How far ``value`` lies from ``base`` in percent; NULL for a zero or unknown base."""
    return (value - base) / F.nullif(base, F.lit(0.0)) * F.lit(100.0)


def not_nan(value: Column) -> Column:
    """NULL instead of NaN."""
    return F.when(~F.isnan(value), value)
