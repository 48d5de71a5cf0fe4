"""Exact sums of money that is stored as a double with two decimals.

Turning each double into a decimal goes through text, and multiplying decimals
through arbitrary-precision numbers. Whole hundredths are exact and far cheaper;
their sums are decimals, so they cannot overflow at any volume.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def hundredths(value: Column) -> Column:
    """A two-decimal double as a whole number of hundredths."""
    return F.rint(value * 100).cast("bigint")


def summable(units: Column) -> Column:
    """Whole units as a type whose sum has 28 digits."""
    return units.cast("decimal(18,0)")


def to_double(units: Column, decimals: int) -> Column:
    """Whole units of ``10 ** -decimals`` (a sum, say) as the nearest double."""
    return (units * F.lit(Decimal(1).scaleb(-decimals))).cast("double")
