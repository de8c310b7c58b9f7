"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# What the jobs rely on. A cluster session normally sets these itself; `build_session` is for tests and the bench.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "lodestrata", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder; anywhere else a missing setting is an error,
    because a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="lodestrata-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, removed when the driver ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    fs, hadoop_path = filesystem(spark, path)
    fs.deleteOnExit(hadoop_path)
    return path


def settled(df: DataFrame) -> DataFrame:
    """`df` kept in the shared folder, where the loss of an executor cannot take it away.

    It is written and read back, so it is computed once; `checkpoint()` would compute it a second time.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Longer methods are never compiled by the JVM, in bytes.
COMPILED_METHOD = "8000"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Plans executed inside are generated as one method per stage only where the JVM compiles such a method.

    A projection of many long expressions otherwise becomes a method that is interpreted for every row, several times
    slower; beyond the limit Spark generates the same expressions in pieces.
    """
    with _setting(spark, METHOD_LIMIT, COMPILED_METHOD):
        yield


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of plans executed inside are deleted as soon as the plan has ended.

    Spark otherwise keeps them until the driver's garbage is collected, and those of all steps of a run add up on disk.
    """
    with _setting(spark, SHUFFLE_CLEANUP, "true"):
        yield


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system that owns `path`, and `path` as a Hadoop path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_lodestrata_shipped", False):
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lodestrata-code-")
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    context._lodestrata_shipped = True
