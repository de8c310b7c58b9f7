"""Checks taken while rows are written: no pass of their own, and rows that break a rule are set aside instead of lost.

Each row gets a bitmask of the rules that it breaks, and one write parts the clean rows from the others. The counts are
observed on the way: an accumulator of the writing job itself, whatever number of rules. What reads on from here reads the
staged rows; the source is scanned once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import NO_DATA, NULLS, REPORT

BROKEN = "broken_rules"
ASIDE = "set_aside"
MOST_RULES = 63


@dataclass(frozen=True)
class Staged:
    """Rows written with their checks; `quarantined` ones carry the bits of the rules they break."""

    clean: DataFrame
    quarantined: DataFrame
    rows: int
    violations: dict[str, int]

    def report(self, name: str) -> DataFrame:
        """The observed checks, as `check_results` words them: emptiness, then one row per rule."""
        found = [(0, "not_empty", None, int(self.rows == 0), NO_DATA.format(name))]
        for place, (rule, n) in enumerate(self.violations.items(), start=1):
            found.append((2 * place, "not_null", rule, n, f"{n}{NULLS}{rule}"))
        return self.clean.sparkSession.createDataFrame(found, REPORT)


def null_rules(columns: Sequence[str]) -> dict[str, Column]:
    """A rule for each column: it must not be NULL."""
    return {c: F.col(c).isNull() for c in columns}


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """The rules a row breaks, the first rule being the lowest bit; a rule that is NULL for a row is kept by it."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules, but a bitmask holds {MOST_RULES}")
    bits = [F.when(rule, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, rule in enumerate(rules.values())]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long"))


def staged(df: DataFrame, rules: Mapping[str, Column], path: str) -> Staged:
    """Write `df` to `path` in one pass, count what breaks each rule on the way, and part the rows."""
    spark, observed = df.sparkSession, Observation()
    marked = df.withColumn(BROKEN, broken_rules(rules)).withColumn(ASIDE, F.col(BROKEN) != 0)
    counts = [F.count_if(F.col(BROKEN).bitwiseAND(1 << i) != 0).alias(f"rule_{i}") for i in range(len(rules))]
    marked.observe(observed, F.count(F.lit(1)).alias("rows"), *counts).write.partitionBy(ASIDE).parquet(path)
    found = observed.get
    schema = T.StructType([*df.schema.fields, T.StructField(BROKEN, T.LongType()), T.StructField(ASIDE, T.BooleanType())])
    back = spark.read.schema(schema).parquet(path)
    return Staged(
        back.where(~F.col(ASIDE)).drop(BROKEN, ASIDE),
        back.where(ASIDE).drop(ASIDE),
        found["rows"],
        {rule: found[f"rule_{i}"] for i, rule in enumerate(rules)},
    )
