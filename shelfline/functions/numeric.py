"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_scaled(value: Column, digits: int) -> Column:
    """Round a double half away from zero on its scaled binary value.

    `F.round(x, 2)` rounds the shortest decimal form of the double instead, and the two differ on values
    such as 1507/40, which is stored slightly below the tie.
    """
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL where the denominator is 0 (ANSI mode would raise)."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def missing(df, name: str) -> Column:
    """True where a column holds NULL, or NaN if it is a floating column."""
    column = F.col(name)
    if dict(df.dtypes)[name] in ("float", "double"):
        return column.isNull() | F.isnan(column)
    return column.isNull()
