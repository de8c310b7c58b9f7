"""Date helpers on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_date(text: Column) -> Column:
    """`yyyyMMdd` text as a date, blanks trimmed; unreadable text stops the job, whatever the ANSI setting."""
    parsed = F.try_to_date(F.trim(text), "yyyyMMdd")
    bad = text.isNotNull() & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a yyyyMMdd date: "), text)).cast("date")).otherwise(parsed)


def padded_month_name(date: Column) -> Column:
    """English month name, blank-padded to nine characters."""
    return F.rpad(F.date_format(date, "MMMM"), 9, " ")
