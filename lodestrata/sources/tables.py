"""Parquet tables without a catalog: whole-table replacement and partition replacement.

Spark cannot overwrite a Parquet table that the same job reads. A table replaced as a whole is written to a new snapshot
folder, which counts once its `_SUCCESS` marker exists. A partitioned table is written with dynamic partition overwrite,
which stages its files first and swaps the touched partitions at commit. One writer per table at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import filesystem

SNAPSHOT_PREFIX = "snapshot-"
KEPT_SNAPSHOTS = 2


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, folder = filesystem(spark, path)
    if not fs.exists(folder):
        return []
    return [status.getPath().getName() for status in fs.listStatus(folder)]


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    """Every snapshot number, unfinished ones included."""
    names = [n for n in _children(spark, path) if n.startswith(SNAPSHOT_PREFIX)]
    return sorted(int(n[len(SNAPSHOT_PREFIX) :]) for n in names)


def _folder(path: str, number: int) -> str:
    return f"{path}/{SNAPSHOT_PREFIX}{number:08d}"


def _finished(spark: SparkSession, path: str) -> list[int]:
    return [n for n in _snapshots(spark, path) if "_SUCCESS" in _children(spark, _folder(path, n))]


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest finished snapshot; no rows when the table does not exist yet."""
    finished = _finished(spark, path)
    if not finished:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_folder(path, finished[-1]))


def replace_table(df: DataFrame, path: str) -> None:
    """Write `df` as the new content of the table, which `df` may itself read."""
    spark = df.sparkSession
    numbers = _snapshots(spark, path)
    df.write.parquet(_folder(path, numbers[-1] + 1 if numbers else 1))
    for number in _finished(spark, path)[:-KEPT_SNAPSHOTS]:
        fs, folder = filesystem(spark, _folder(path, number))
        fs.delete(folder, True)


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that only grows, or is replaced partition by partition; no rows when it does not exist yet."""
    fs, folder = filesystem(spark, path)
    entries = fs.listStatusIterator(folder) if fs.exists(folder) else None
    while entries is not None and entries.hasNext():
        if not entries.next().getPath().getName().startswith(("_", ".")):
            return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace exactly the partitions that occur in `df`; all others stay as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )
