"""Joins against a side that holds one row per key, safe when one key holds a large part of the other side."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key counts as hot from this share of all rows on. Below MIN_HOT_ROWS rows a key is
# never worth a plan of its own: one task copes with that many.
HOT_SHARE = 0.001
MIN_HOT_ROWS = 1_000_000
TRACKED_ITEMS = 10_000
# Rows that one task of a spread input holds, whatever the input's size.
ROWS_PER_TASK = 250_000


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def is_hot(keys: Sequence[str], hot: Sequence[int]) -> Column:
    return key_hash(keys).isin(list(hot))


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` spread by `keys` over as many tasks as its rows need; one count of `df` tells how many.

    Left to itself Spark sizes tasks by the compressed bytes of a shuffle, or by a fixed number, and what a task makes of
    its rows then grows with the input until it spills.
    """
    rows = df.count()
    if rows <= ROWS_PER_TASK:
        return df.repartition(*keys)
    tasks = max(math.ceil(rows / ROWS_PER_TASK), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys)


# The column that says which task a row of `spread_within` goes to, and the rows that are not worth a further task.
TASK = "spread_task"
FEWEST_ROWS = 25_000


def tasks_of_parts(rows: Mapping[str | None, int], parallelism: int) -> tuple[list[tuple[str | None, int, int]], int]:
    """Per part its first task and the number of its tasks, and the number of all tasks: small parts that follow each other
    share a task, a large one has several to itself. A task has half of `ROWS_PER_TASK`, as it sorts what it writes, too."""
    share = min(max(math.ceil(sum(rows.values()) / parallelism), FEWEST_ROWS), math.ceil(ROWS_PER_TASK / 2))
    placed, task, held = [], 0, 0
    for part, n in sorted(rows.items(), key=lambda item: (item[0] is not None, item[0])):
        if held and held + n > share:
            task, held = task + 1, 0
        tasks = max(math.ceil(n / share), 1)
        placed.append((part, task, tasks))
        task, held = (task + tasks, 0) if tasks > 1 else (task, held + n)
    return placed, task + 1 if held or not placed else task


def spread_within(df: DataFrame, part: Column, keys: Sequence[str]) -> DataFrame:
    """`df` spread so that a task has few parts and a bounded number of rows; rows of a part that share `keys` meet in one.

    What is then written by part needs no further shuffle. `TASK`, a column that depends on the part and the keys alone, goes
    with the rows: a grouping by it and more columns is done where they lie. The parts are collected with their counts.
    """
    spark, kind = df.sparkSession, T.StringType()
    counts = {r["part"]: r["count"] for r in df.groupBy(part.cast(kind).alias("part")).count().collect()}
    placed, tasks = tasks_of_parts(counts, spark.sparkContext.defaultParallelism)
    schema = "spread_part string, spread_first int, spread_tasks int"
    places = F.broadcast(spark.createDataFrame(placed, schema))
    within = F.pmod(key_hash(keys), F.col("spread_tasks").cast("long")).cast("int")
    task = F.coalesce(F.col("spread_first") + within, F.lit(0)).alias(TASK)
    placed_rows = df.join(places, part.cast(kind).eqNullSafe(F.col("spread_part")), "left").select(*df.columns, task)
    return placed_rows.repartitionById(tasks, F.col(TASK))


def hot_key_hashes(df: DataFrame, keys: Sequence[str], min_rows: int = MIN_HOT_ROWS) -> list[int]:
    """Hashes of the keys that hold a large share of `df`: one scan of the key columns, no shuffle of rows.

    A frequent-items sketch is merged across tasks, so only a few hundred counters reach the driver: at most
    `1 / HOT_SHARE` hashes are returned. They steer the plan alone; no result depends on them.
    """
    total = df.count()
    if total < min_rows:
        return []
    sketch = F.expr(f"approx_top_k(hash, {int(1 / HOT_SHARE)}, {TRACKED_ITEMS})")
    top = df.select(key_hash(keys).alias("hash")).agg(sketch.alias("top")).first()["top"]
    floor = max(min_rows, int(total * HOT_SHARE))
    return [item["item"] for item in top if item["count"] >= floor]


def lookup_join(
    many: DataFrame, one: DataFrame, keys: Sequence[str], how: str, hot: Sequence[int] = ()
) -> DataFrame:
    """Join `many` to `one`, which has at most one row per key.

    Rows of hot keys never enter the shuffle: they meet their few partner rows (one per key, so no more than
    `len(hot)` but for hash collisions) in a broadcast join. All other rows take the ordinary join.
    """
    keys = list(keys)
    if not hot:
        return many.join(one, keys, how)
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"a split join cannot be {how}")
    kinds = [many.schema[k].dataType for k in keys]
    if kinds != [one.schema[k].dataType for k in keys] or any(isinstance(t, T.FractionalType) for t in kinds):
        raise ValueError("a split join needs keys of the same exact type on both sides")
    frequent = is_hot(keys, hot)
    ordinary = many.where(~frequent).join(one.where(~frequent), keys, how)
    return ordinary.unionByName(many.where(frequent).join(F.broadcast(one.where(frequent)), keys, how))


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after a count has shown that `df` holds no more than `max_rows` rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
