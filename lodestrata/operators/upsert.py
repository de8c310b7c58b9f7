"""Update-then-insert, as joins that return the new content of the target."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import lookup_join


def any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def last_per_key(
    stage: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None, into: str = "picked"
) -> DataFrame:
    """One row per key: the greatest by `order_by`, ties settled by the other columns, so every run agrees.

    A maximum over a struct combines on the map side, so copies and hot keys shrink before the shuffle.
    """
    others = [c for c in stage.columns if c not in keys]
    order = list(order_by or [])
    ranked = F.struct(*[F.col(c) for c in order + [c for c in others if c not in order]])
    return stage.groupBy(*keys).agg(F.max(ranked).alias(into), F.count(F.lit(1)).alias("copies"))


def _value_columns(target: DataFrame, keys: Sequence[str], stamp_column: str | None) -> list[str]:
    return [c for c in target.columns if c not in keys and c != stamp_column]


def _stamped(target: DataFrame, stamp_column: str | None, stamp: Column | None, when: Column | None = None):
    if stamp_column is None or stamp_column not in target.columns:
        return []
    now = (F.current_timestamp() if stamp is None else stamp).cast(target.schema[stamp_column].dataType)
    return [(now if when is None else F.when(when, now).otherwise(F.col(stamp_column))).alias(stamp_column)]


def update_from(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    *,
    stamp: Column | None = None,
    stamp_column: str | None = "updated_at",
    order_by: Sequence[str] | None = None,
    hot: Sequence[int] = (),
) -> DataFrame:
    """The target after UPDATE .. FROM stage: matched rows take the stage's values, NULLs included, and a new stamp.

    NULL keys match nothing and stay out of the join, so they never pile up in one shuffle partition.
    """
    keys = list(keys)
    values = _value_columns(target, keys, stamp_column)
    picked = last_per_key(stage.where(~any_null(keys)).select(*keys, *values), keys, order_by).drop("copies")
    joined = lookup_join(target.where(~any_null(keys)), picked, keys, "left", hot)
    matched = F.col("picked").isNotNull()
    updated = joined.select(
        *keys,
        *[F.when(matched, F.col(f"picked.{c}")).otherwise(F.col(c)).alias(c) for c in values],
        *_stamped(target, stamp_column, stamp, matched),
    ).select(*target.columns)
    return updated.unionByName(target.where(any_null(keys)))


def unmatched(target: DataFrame, stage: DataFrame, keys: Sequence[str], hot: Sequence[int] = ()) -> DataFrame:
    """The stage rows without a partner in the target, duplicates and NULL keys included."""
    keys = list(keys)
    known = target.where(~any_null(keys)).select(*keys).distinct()
    new = lookup_join(stage.where(~any_null(keys)), known, keys, "left_anti", hot)
    return new.unionByName(stage.where(any_null(keys)))


def shaped(
    rows: DataFrame, target: DataFrame, stamp: Column | None = None, stamp_column: str | None = "updated_at"
) -> DataFrame:
    """Stage rows in the target's columns, stamped."""
    return rows.select(
        *[c for c in target.columns if c != stamp_column], *_stamped(target, stamp_column, stamp)
    ).select(*target.columns)


def missing_rows(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    *,
    stamp: Column | None = None,
    stamp_column: str | None = "updated_at",
    hot: Sequence[int] = (),
) -> DataFrame:
    """What the insert after an update adds: the unmatched stage rows, shaped like the target."""
    rows = stage.select(*keys, *_value_columns(target, keys, stamp_column))
    return shaped(unmatched(target, rows, keys, hot), target, stamp, stamp_column)


def upsert(
    target: DataFrame,
    stage: DataFrame,
    keys: Sequence[str],
    *,
    stamp: Column | None = None,
    stamp_column: str | None = "updated_at",
    order_by: Sequence[str] | None = None,
    insert_duplicates: str = "keep",
    target_hot: Sequence[int] = (),
    stage_hot: Sequence[int] = (),
) -> DataFrame:
    """Update matched target rows, then add the unmatched stage rows; nothing is ever removed.

    `insert_duplicates` decides about unmatched stage rows that share a key: "keep" inserts them all, "one" inserts
    the row the update would pick, "error" stops the job.
    """
    keys = list(keys)
    options = {"stamp": stamp, "stamp_column": stamp_column}
    if insert_duplicates == "keep":
        updated = update_from(target, stage, keys, order_by=order_by, hot=target_hot, **options)
        return updated.unionByName(missing_rows(target, stage, keys, hot=stage_hot, **options))
    if insert_duplicates not in ("one", "error"):
        raise ValueError(f"unknown policy for duplicates: {insert_duplicates}")

    # One row per key on the stage side: update and insert come out of a single full outer join.
    values = _value_columns(target, keys, stamp_column)
    rows = stage.select(*keys, *values)
    picked = last_per_key(rows.where(~any_null(keys)), keys, order_by)
    present = target.where(~any_null(keys)).withColumn("present", F.lit(True))
    joined = present.join(picked, keys, "full")
    staged = F.col("picked").isNotNull()
    if insert_duplicates == "error":
        clash = F.col("present").isNull() & (F.col("copies") > 1)
        text = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
        stop = F.raise_error(F.concat(F.lit("several new rows for key "), text)).cast("boolean")
        staged = F.when(clash, stop).otherwise(staged)
    merged = joined.select(
        *keys,
        *[F.when(staged, F.col(f"picked.{c}")).otherwise(F.col(c)).alias(c) for c in values],
        *_stamped(target, stamp_column, stamp, staged),
    ).select(*target.columns)
    keyless = shaped(rows.where(any_null(keys)), target, stamp, stamp_column)
    return merged.unionByName(target.where(any_null(keys))).unionByName(keyless)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows a MERGE without update would insert: source rows whose key the target lacks, one per key."""
    keys = list(keys)
    others = [c for c in source.columns if c not in keys]
    if others:
        single = source.groupBy(*keys).agg(F.min(F.struct(*others)).alias("kept")).select(*keys, "kept.*")
    else:
        single = source.distinct()
    return single.join(target.select(*keys), keys, "left_anti").select(*target.columns)
