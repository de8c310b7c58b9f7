"""A stored aggregate that follows its input by differences.

The state has one row per group: mergeable sums, and how many input rows stand behind them. A change of the input is told as
the rows before and after, of whatever part of it was rewritten; their signed sums are the delta, in which rows that stayed
cancel out. State and delta add up to the new state; a group without rows is gone. Each side is summed where it lies before
the one shuffle by group, and NULL values add nothing but are told apart from zero by a count beside each sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = "rows"


def counted(name: str) -> str:
    """The column that counts the values behind a sum."""
    return f"{name}_n"


def _sums(values: Sequence[str]) -> list[str]:
    return [*[c for v in values for c in (v, counted(v))], ROWS]


def _signed(df: DataFrame, keys: Sequence[str], values: Sequence[str], sign: int) -> DataFrame:
    picked = [F.col(k) for k in keys]
    for v in values:
        picked += [(F.coalesce(F.col(v), F.lit(0)) * sign).alias(v), F.when(F.col(v).isNull(), 0).otherwise(sign).alias(counted(v))]
    return df.select(*picked, F.lit(sign).alias(ROWS))


def _added(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _sums(values)])


def delta(before: DataFrame, after: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """What replacing the rows of `before` by those of `after` adds to each group; untouched groups do not occur."""
    both = _signed(before, keys, values, -1).unionByName(_signed(after, keys, values, 1))
    changed = F.lit(False)
    for c in _sums(values):
        changed = changed | (F.col(c) != 0)
    return _added(both, keys, values).where(changed)


def state(rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The state of an input from scratch."""
    return _added(_signed(rows, keys, values, 1), keys, values)


def applied(old: DataFrame, change: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The state after a change; groups that have lost their last row are gone. Without an old state it is the change."""
    columns = [*keys, *_sums(values)]
    added = _added(old.select(*columns).unionByName(change.select(*columns)), keys, values)
    if old.isEmpty():
        # A delta has one row per group: nothing is left to add up, and its rows are not shuffled again.
        added = change.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in added.schema.fields])
    return added.where(F.col(ROWS) > 0)


def total(name: str) -> Column:
    """A sum of the state as `sum` would give it: NULL where no value stands behind it."""
    return F.when(F.col(counted(name)) > 0, F.col(name))
