"""Numeric helpers on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_decimal(text: str, kind: T.DecimalType) -> str:
    """SQL that reads a decimal as a bulk load does: surplus fraction digits are cut. NULL when unreadable."""
    if kind.scale:
        cut = rf"regexp_replace({text}, r'(\.\d{{{kind.scale}}})\d+$', '$1')"
    else:
        cut = rf"regexp_replace({text}, r'\.\d+$', '.0')"
    return f"try_cast({cut} AS {kind.simpleString()})"


def occupancy_ratio(census: Column, beds: Column) -> Column:
    """Census over beds as a decimal; NULL without beds, so an average skips the row."""
    return census.cast(T.DecimalType(10, 2)) / F.nullif(beds, F.lit(0))


def mean_percent_half_up(total: Column, count: Column, beds: Column) -> Column:
    """`100 * total / (count * beds)` to two places, half away from zero, in whole-number arithmetic.

    Exact where a chain of decimal divisions is not: it never rounds an intermediate quotient. NULL when `count` or
    `beds` is 0.
    """
    n, divisor = total.cast(T.DecimalType(28, 0)), (count.cast("decimal(18,0)") * beds.cast("decimal(10,0)"))
    divisor = F.nullif(F.abs(divisor), F.lit(0).cast(T.DecimalType(29, 0)))
    hundredths = F.call_function("div", F.abs(n) * F.lit(20000) + divisor, divisor * F.lit(2))
    sign = F.when((n < 0) != (beds < 0), -1).otherwise(1)
    return (sign * hundredths.cast(T.DecimalType(20, 0)) / F.lit(100)).cast(T.DecimalType(10, 2))
