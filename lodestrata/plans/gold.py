"""Gold: monthly staffing hours and bed utilization per provider and staffing type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import mean_percent_half_up, occupancy_ratio
from ..operators.skew import broadcast_if_small
from ..schemas import gold_schema
from .silver import stamped

# Calendar and type dimensions are broadcast up to this many rows (a century of days is 36,525).
BROADCAST_ROWS = 100_000

PROVIDER_ATTRIBUTES = ["ccn", "providername", "city", "state", "longitude", "latitude"]
CALENDAR_ATTRIBUTES = ["month", "monthname", "year"]
TYPE_ATTRIBUTES = ["title", "staffingtype"]
GROUPING = PROVIDER_ATTRIBUTES + TYPE_ATTRIBUTES + CALENDAR_ATTRIBUTES


def with_calendar(fact: DataFrame, work_dates: DataFrame) -> DataFrame:
    """Fact rows with month and year; the fact's date id is text, the calendar's a number."""
    dates = work_dates.select(F.col("workdateid").alias("date_key"), *CALENDAR_ATTRIBUTES)
    return fact.join(broadcast_if_small(dates, BROADCAST_ROWS), fact["workdateid"].cast("int") == F.col("date_key"))


def with_type(fact: DataFrame, staffing_types: DataFrame) -> DataFrame:
    """Fact rows with title and staffing type; the fact's type id is text, the dimension's a number."""
    types = staffing_types.select(F.col("staffingtypeid").alias("type_key"), *TYPE_ATTRIBUTES)
    return fact.join(broadcast_if_small(types, BROADCAST_ROWS), fact["staffingtypeid"].cast("int") == F.col("type_key"))


def with_provider(fact: DataFrame, providers: DataFrame) -> DataFrame:
    """Fact rows with provider attributes and beds."""
    return fact.join(providers.select(*PROVIDER_ATTRIBUTES, "numberofbed"), "ccn")


def star(fact: DataFrame, providers: DataFrame, staffing_types: DataFrame, work_dates: DataFrame) -> DataFrame:
    """All four tables joined row by row; facts without a partner in any dimension drop out."""
    return with_provider(with_type(with_calendar(fact, work_dates), staffing_types), providers)


def bed_utilization(fact: DataFrame, providers: DataFrame, by: str = "staffingtypeid") -> DataFrame:
    """Mean census per bed in percent, per provider and `by`; providers are unique, so sums are taken before the join."""
    sums = fact.groupBy("ccn", by).agg(
        F.sum(F.col("numofpatient").cast("bigint")).alias("census"), F.count("numofpatient").alias("days")
    )
    rate = mean_percent_half_up(F.col("census"), F.col("days"), F.nullif(F.col("numberofbed"), F.lit(0)))
    return with_provider(sums, providers).select("ccn", by, rate.alias("bedutilizationrate"))


def utilization(
    fact: DataFrame,
    providers: DataFrame,
    staffing_types: DataFrame,
    work_dates: DataFrame,
    *,
    mode: str = "exact",
) -> DataFrame:
    """Total hours and mean census per bed in percent, by provider, staffing type and month.

    In "exact" mode the fact is summed by provider, type and month before it meets the providers: the daily rows are
    combined inside the scan's own tasks, so what is shuffled has one row per provider, type and month, and a provider
    with a third of all rows weighs no more than any other. Sums and counts distribute over the joins, so the result
    is that of the row-by-row form. "decimal" averages per-row decimal quotients instead, rounding each of them.
    """
    if mode == "decimal":
        rows = star(fact, providers, staffing_types, work_dates)
        ratio = occupancy_ratio(F.col("numofpatient"), F.col("numberofbed"))
        rate = (F.avg(ratio) * 100).cast(T.DecimalType(10, 2)).alias("bedutilizationrate")
        return rows.groupBy(*GROUPING).agg(F.sum("workhours").alias("totalworkhour"), rate)
    if mode != "exact":
        raise ValueError(f"unknown mode: {mode}")

    by_month = monthly_sums(fact, work_dates).groupBy(*MONTHLY_KEYS).agg(
        F.sum("hours").alias("hours"), F.sum("census").alias("census"), F.count("census").alias("days")
    )
    return from_monthly(by_month, providers, staffing_types)


# What the monthly state holds: a group per provider, type and month, and the values that are summed.
MONTHLY_KEYS = ["ccn", "staffingtypeid", *CALENDAR_ATTRIBUTES]
MONTHLY_VALUES = ["hours", "census"]


def monthly_sums(fact: DataFrame, work_dates: DataFrame) -> DataFrame:
    """The fact's rows with the keys and values of the monthly state."""
    rows = with_calendar(fact, work_dates)
    kept = [c for c in fact.columns if c not in ("workhours", "numofpatient", *MONTHLY_KEYS)]
    return rows.select(*MONTHLY_KEYS, *kept, F.col("workhours").alias("hours"), F.col("numofpatient").cast("bigint").alias("census"))


def from_monthly(by_month: DataFrame, providers: DataFrame, staffing_types: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Gold from sums by provider, type and month (hours, census and the days with a census); `more`: columns that go with them."""
    grouping = [*GROUPING, *more]
    rows = with_provider(with_type(by_month, staffing_types), providers)
    beds = F.nullif(F.col("numberofbed"), F.lit(0))
    counted = beds.isNotNull() & (F.col("days") > 0)
    # A quotient per summed row is only needed for groups whose rows disagree about the beds.
    share = F.when(counted, F.col("census").cast("decimal(20,0)") / beds)
    sums = rows.groupBy(*grouping).agg(
        F.sum("hours").alias("totalworkhour"),
        F.sum(F.when(counted, F.col("census"))).alias("census"),
        F.sum(F.when(counted, F.col("days"))).alias("days"),
        F.min(F.when(counted, beds)).alias("fewest_beds"),
        F.max(F.when(counted, beds)).alias("most_beds"),
        F.sum(share).alias("shares"),
    )
    one_bed_count = mean_percent_half_up(F.col("census"), F.col("days"), F.col("most_beds"))
    several = (F.col("shares") / F.col("days") * 100).cast(T.DecimalType(10, 2))
    rate = F.when(F.col("fewest_beds") == F.col("most_beds"), one_bed_count).otherwise(several)
    return sums.select(*grouping, "totalworkhour", rate.alias("bedutilizationrate"))


def build_utilization(
    fact: DataFrame,
    providers: DataFrame,
    staffing_types: DataFrame,
    work_dates: DataFrame,
    run_ts: Column | None = None,
    *,
    mode: str = "exact",
    strict_scale: bool = False,
) -> DataFrame:
    """The gold table's content, in its column order and types."""
    rows = utilization(fact, providers, staffing_types, work_dates, mode=mode)
    return shaped_gold(rows, run_ts, strict_scale)


def shaped_gold(rows: DataFrame, run_ts: Column | None, strict_scale: bool, more: Sequence[str] = ()) -> DataFrame:
    kinds = [F.col(f.name).cast(f.dataType).alias(f.name) for f in gold_schema(strict_scale).fields]
    return stamped(rows, run_ts).select(*kinds, *more)
