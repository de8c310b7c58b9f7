"""Small Spark helpers of the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import filesystem, scratch_path


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """`df` computed once, as Parquet in the folder that all executors share; the loss of an executor takes nothing.

    A written table is computed once; `checkpoint()` would compute its input twice. What the driver held for the plan is
    let go: Spark frees the broadcasts and shuffles of finished plans only after a collection of the driver's garbage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    release()
    df.sparkSession._jvm.System.gc()
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.__dict__["stored_at"] = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more, so that rounds don't pile up on disk."""
    for df in tables:
        path = df.__dict__.pop("stored_at", None)
        if path is not None:
            fs, hadoop_path = filesystem(df.sparkSession, path)
            fs.delete(hadoop_path, True)


def row_key(id_col: str, text_col: str) -> Column:
    """What tells rows apart where ids repeat: rows that share it are equal in id and text."""
    return F.struct(F.col(id_col).alias("id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("hash"))


def without_rows(docs: DataFrame, dropped: DataFrame, key: Column) -> DataFrame:
    """`docs` less the rows whose `key` is one of `dropped.key`."""
    marked = docs.withColumn("__key", key)
    return marked.join(dropped.select(F.col("key").alias("__key")).distinct(), "__key", "left_anti").drop("__key")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of text in all rows: it sets how many pieces the work is cut into, never what a row yields."""
    return docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_lodestrata_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="lodestrata-code-")
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    context._lodestrata_shipped = True


def lean(kernel: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The kernel of a `mapInArrow`, after which the Python worker gives its freed memory back to the machine.

    Spark goes on to use the worker for other tasks, and what the allocators hold of each would add up.
    """

    def run(batches: Iterator) -> Iterator:
        yield from kernel(batches)
        release()

    return run


def release() -> None:
    """Give memory that this Python process has freed back to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not the GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def with_field(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """The schema of `df` and one more column."""
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])
