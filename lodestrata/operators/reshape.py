"""Wide to long, set union and literal rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .skew import TASK, is_hot, spread, spread_within


def wide_to_long(
    df: DataFrame, ids: Sequence[str], measures: Mapping[str, str], label: str, value: str
) -> DataFrame:
    """One row per input row and measure, from a single scan; `measures` maps each label to its column.

    NULL measures stay. The result is a bag: add `.distinct()` for the rows of a union of one projection per measure.
    Rows are generated in place, so an input partitioned by some of `ids` stays partitioned that way.
    """
    entries = [F.struct(F.lit(text).alias(label), F.col(column).alias(value)) for text, column in measures.items()]
    return df.select(*ids, F.inline(F.array(*entries)))


def distinct_long(
    df: DataFrame,
    ids: Sequence[str],
    measures: Mapping[str, str],
    label: str,
    value: str,
    keys: Sequence[str],
    hot: Sequence[int] = (),
    part: str | None = None,
) -> DataFrame:
    """The distinct rows of `wide_to_long`, shuffling the wide rows once instead of all the long ones.

    Wide rows are spread by `keys`, a part of `ids`; equal long rows then lie in one partition and are removed there.
    Rows of `hot` keys would overload their partition: they are made long first and spread over all columns.

    With `part`, one of `ids`, the result lies as it is best written by `part`: few parts in a task, few tasks for a part.
    """
    arguments = (measures, label, value)
    cold = df.where(~is_hot(keys, hot)) if hot else df
    if part is None:
        distinct = wide_to_long(spread(cold, keys), ids, *arguments).distinct()
    else:
        wide = spread_within(cold, F.col(part), keys)
        distinct = wide_to_long(wide, [*ids, TASK], *arguments).distinct().drop(TASK)
    if not hot:
        return distinct
    frequent = wide_to_long(df.where(is_hot(keys, hot)), ids, *arguments).distinct()
    return distinct.unionByName(frequent if part is None else frequent.hint("rebalance", part))


def union_distinct(*frames: DataFrame) -> DataFrame:
    """SQL UNION: duplicates removed over all columns, within and across the inputs; columns bind by position."""
    return reduce(DataFrame.union, frames).distinct()


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A distinct set of constant rows that the optimizer knows to be tiny."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields, strict=True)])
        for row in dict.fromkeys(rows)
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def ordered_within_files(df: DataFrame, *columns: str) -> DataFrame:
    """Order for clustering: rows are sorted inside each output file, without a global sort.

    A relation has no order, so a stage's ORDER BY changes no result; sorted files keep the min/max ranges tight.
    """
    return df.sortWithinPartitions(*columns)
