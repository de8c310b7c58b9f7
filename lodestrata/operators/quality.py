"""Data-quality checks. Every check is an aggregate on the cluster; only counts reach the driver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .reshape import literal_rows
from .upsert import any_null

REPORT = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("check", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("violations", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)

# The texts of the findings.
FAILED = "Validation failed"
NO_DATA = "Query returned no data from {}"
MISSING = "Missing expected column {}"
MISSING_ALL = "Missing expected columns: {}"
NULLS = " NULL values in "
REPEATS = " duplicate values in "


class ValidationError(ValueError):
    """One or more checks failed; the message lists them all."""


@dataclass(frozen=True)
class CheckSet:
    """What one relation must satisfy.

    Unique columns are reported right after their own NULL count, keys of several columns after all others.
    """

    name: str
    required: Sequence[str]
    unique: Sequence[str] = ()
    not_null: Sequence[str] = field(default=())
    unique_together: Sequence[Sequence[str]] = ()

    @property
    def null_checked(self) -> list[str]:
        rest = list(self.not_null or self.required)
        return [*self.unique, *[c for c in rest if c not in self.unique]]


def normalized(df: DataFrame) -> DataFrame:
    """Column names trimmed and in lower case."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns that the relation lacks; looks at the schema only, so no job runs."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def column_coverage(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: whether it is there, and how many of the rows fill it."""
    df = normalized(df)
    there = [c for c in required if c in df.columns]
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in there])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(c in there).alias("present"),
            (F.col(c) if c in there else F.lit(0).cast("bigint")).alias("filled"),
        )
        for c in required
    ]
    return counts.select(F.inline(F.array(*rows)))


def row_presence(df: DataFrame) -> DataFrame:
    """A single row with `rows` = 1 when the relation holds any row and 0 when not; one row is read at most."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("rows"))


def null_counts(df: DataFrame, columns: Sequence[str], distinct_rows: bool = False) -> DataFrame:
    """NULLs per column, one row each, from one aggregate.

    Rows without a NULL are dropped first. That reaches the file scan as a filter, and with `distinct_rows` it means
    only offending rows are shuffled to remove their duplicates.
    """
    offending = df.where(any_null(columns))
    if distinct_rows:
        offending = offending.distinct()
    counts = offending.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in columns]
    return counts.select(F.inline(F.array(*pairs)))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A single row: how many rows repeat a key that an earlier row has; NULLs equal each other."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint")).alias("violations"))


def check_results(
    df: DataFrame, checks: CheckSet, distinct_rows: bool = False, suspects: DataFrame | None = None
) -> DataFrame:
    """Every check of the set with its violation count, also those that hold.

    `suspects`, if given, holds every row of `df` that has a NULL, and spares the NULL counts a pass over all of `df`.
    """
    df = normalized(df)
    suspects = df if suspects is None else normalized(suspects)
    absent = missing_columns(df, checks.required)
    if absent:
        rows = [(1, "required_columns", c, 1, MISSING.format(c)) for c in absent]
        return literal_rows(df.sparkSession, rows, REPORT)
    df, suspects = df.select(*checks.required), suspects.select(*checks.required)

    order = {c: 2 + 2 * i for i, c in enumerate(checks.null_checked)}
    position = F.element_at(F.create_map(*[F.lit(x) for pair in order.items() for x in pair]), F.col("column"))
    presence = row_presence(df).select(
        F.lit(0).alias("position"),
        F.lit("not_empty").alias("check"),
        F.lit(None).cast("string").alias("column"),
        (1 - F.col("rows")).alias("violations"),
        F.lit(NO_DATA.format(checks.name)).alias("message"),
    )
    nulls = null_counts(suspects, checks.null_checked, distinct_rows).select(
        position.alias("position"),
        F.lit("not_null").alias("check"),
        "column",
        "violations",
        F.concat(F.col("violations").cast("string"), F.lit(NULLS), F.col("column")).alias("message"),
    )
    parts = [presence, nulls]
    keys = [(order[c] + 1, [c]) for c in checks.unique]
    keys += [(2 + 2 * len(order) + i, list(key)) for i, key in enumerate(checks.unique_together)]
    for place, key in keys:
        rows = df.distinct() if distinct_rows else df
        label = ", ".join(key)
        parts.append(
            duplicate_count(rows, key).select(
                F.lit(place).alias("position"),
                F.lit("unique").alias("check"),
                F.lit(label).alias("column"),
                "violations",
                F.concat(F.col("violations").cast("string"), F.lit(REPEATS + label)).alias("message"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def validation_report(
    df: DataFrame, checks: CheckSet, distinct_rows: bool = False, suspects: DataFrame | None = None
) -> DataFrame:
    """The checks that fail, one row each; empty when the relation is clean."""
    return check_results(df, checks, distinct_rows, suspects).where(F.col("violations") > 0)


def gate_status(results: DataFrame) -> DataFrame:
    """One row over any number of check results: checks run, violations found, and whether the gate opens."""
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.sum("violations").alias("violations"),
        F.coalesce(F.max("violations") == 0, F.lit(False)).alias("passed"),
    )


def validate(
    df: DataFrame, checks: CheckSet, distinct_rows: bool = False, suspects: DataFrame | None = None
) -> None:
    """Run the checks and raise one error that lists all findings; at most a row per check is collected."""
    absent = missing_columns(normalized(df), checks.required)
    if absent and not df.isEmpty():
        raise ValidationError(f"{FAILED}: {MISSING_ALL.format(absent)}")
    report = validation_report(df, checks, distinct_rows, suspects).collect()
    findings = sorted(report, key=lambda row: row["position"])
    if absent or any(row["check"] == "not_empty" for row in findings):
        raise ValidationError(f"{FAILED}: {NO_DATA.format(checks.name)}")
    if findings:
        raise ValidationError(f"{FAILED}:\n" + "\n".join(row["message"] for row in findings))
