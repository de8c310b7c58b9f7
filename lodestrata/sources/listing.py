"""File discovery as DataFrame work: list, filter, compare with what is known, route to a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import base_name, last_segment

# The schema that Spark's file listing source fixes.
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


class NoNewFilesError(ValueError):
    """Discovery found nothing to load."""


class UnroutedFileError(ValueError):
    """A file name that no route accepts."""


@dataclass(frozen=True)
class Route:
    """Files whose name starts with `prefix`, in any case, hold rows of `table`.

    `text_bytes`: the lengths in bytes that its layout declares for text; text without one is never cut.
    """

    prefix: str
    table: str
    schema: T.StructType
    text_bytes: Mapping[str, int | None] = field(default_factory=dict)


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """Every file below `root`. The content column is never selected, so no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.where(F.col("path").endswith(suffix)).select("path", "length", "modificationTime")


def new_files(listing: DataFrame, manifest: DataFrame, suffix: str = ".csv") -> DataFrame:
    """Listed files with the suffix (case matters) whose base name the manifest lacks.

    Only base names are compared: the same name in another folder counts as loaded, while two equal names that arrive
    together are both new.
    """
    named = listing.where(F.col("path").endswith(suffix)).withColumn("filename", last_segment(F.col("path")))
    return named.join(manifest.select("filename"), "filename", "left_anti")


def routed_table(filename: Column, prefixes: Sequence[tuple[str, str]], on_unmatched: str = "null") -> Column:
    """Table of a file name: the first (prefix, table) pair that fits; otherwise NULL, or a stop with "raise"."""
    if on_unmatched == "raise":
        result = F.raise_error(F.concat(F.lit("No matching table for file: "), filename)).cast("string")
    else:
        result = F.lit(None).cast("string")
    for prefix, table in reversed(list(prefixes)):
        pattern = prefix.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
        result = F.when(filename.ilike(pattern), F.lit(table)).otherwise(result)
    return result


def route_files(files: DataFrame, routes: Sequence[Route], on_unmatched: str = "null") -> DataFrame:
    """Adds `table_name` to files that carry a `path`."""
    pairs = [(route.prefix, route.table) for route in routes]
    name = base_name(F.col("path"))
    return files.withColumn("filename", name).withColumn("table_name", routed_table(name, pairs, on_unmatched))


def due_files(
    listing: DataFrame, landed: DataFrame, mime_type: str | None = "text/csv", folder: str | None = None
) -> DataFrame:
    """Landing sync as a difference: source files of the type, and of the folder where one is named, whose name has not
    landed, one row each."""
    if folder is not None:
        listing = listing.where(F.col("folder") == folder)
    if mime_type is not None:
        listing = listing.where(F.col("mime_type") == mime_type)
    return listing.join(landed.select("filename"), "filename", "left_anti")


def sync_summary(due: DataFrame) -> DataFrame:
    """Outcome of a sync in one row. The names stay a distributed relation of their own (`due_files`)."""
    return due.agg(F.count(F.lit(1)).alias("count")).select(F.lit("success").alias("status"), "count")
