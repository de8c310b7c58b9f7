"""Batch ingestion: discover, route, load to bronze, record in the manifest."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import insert_if_absent
from ..schemas import MANIFEST, daily_nurse_staffing_schema, provider_info_schema
from ..session import compiled_methods, settled
from .csv import EVERY_COLUMN, escaped_glob, tolerant_csv
from .listing import NoNewFilesError, Route, UnroutedFileError, list_files, new_files, route_files
from .tables import append_rows, read_appended, replace_partitions

PROVIDER_TABLE = "provider_info"
STAFFING_TABLE = "daily_nurse_staffing"
MANIFEST_TABLE = "ingested_files"
# Bounds what one load job holds on the driver: the paths of its files.
FILES_PER_LOAD = 10_000
# Fixed value: the length in bytes of every text column of the two layouts.
LAYOUT_TEXT = {EVERY_COLUMN: 256}


def default_routes(strict_scale: bool = False) -> list[Route]:
    return [
        Route("DailyNurseStaffing", STAFFING_TABLE, daily_nurse_staffing_schema(strict_scale), LAYOUT_TEXT),
        Route("ProviderInfo", PROVIDER_TABLE, provider_info_schema(strict_scale), LAYOUT_TEXT),
    ]


@dataclass(frozen=True)
class Bronze:
    """Where bronze lives and how files reach it."""

    root: str
    routes: Sequence[Route] = field(default_factory=default_routes)
    csv_options: dict = field(default_factory=dict)

    def table_path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def route_of(self, table: str) -> Route:
        return next(route for route in self.routes if route.table == table)

    def schema_of(self, table: str) -> T.StructType:
        return self.route_of(table).schema

    def manifest(self, spark: SparkSession) -> DataFrame:
        return read_appended(spark, self.table_path(MANIFEST_TABLE), MANIFEST)

    def table(self, spark: SparkSession, table: str, source_files: Sequence[str] | None = None) -> DataFrame:
        """A bronze table; with `source_files` only those files' partitions are read."""
        partitions = [T.StructField(c, T.StringType()) for c in ("source_file", "source_id")]
        schema = T.StructType([*self.schema_of(table).fields, *partitions])
        rows = read_appended(spark, self.table_path(table), schema).drop("source_id")
        if source_files is not None:
            rows = rows.where(F.col("source_file").isin(list(source_files)))
        return rows


def manifest_additions(loaded: DataFrame, manifest: DataFrame, load_time: Column | None = None) -> DataFrame:
    """Manifest rows for loaded files whose name is not recorded yet; a recorded name is left alone."""
    stamp = (F.current_timestamp() if load_time is None else load_time).alias("load_time")
    rows = loaded.select("filename", "table_name", stamp)
    return insert_if_absent(manifest.select(*rows.columns), rows, ["filename"])


def _chunks(files: DataFrame, size: int) -> Iterator[tuple[list, str | None]]:
    """Files in bounded lists, each with the file name that goes on in the next list, if one does."""
    rows = files.toLocalIterator()
    ahead = next(rows, None)
    while ahead is not None:
        chunk = []
        while ahead is not None and len(chunk) < size:
            chunk.append(ahead)
            ahead = next(rows, None)
        yield chunk, ahead["filename"] if ahead is not None else None


def load_files(spark: SparkSession, bronze: Bronze, files: Sequence) -> None:
    """Load routed files (rows of path, filename, table_name), one write per table.

    A file owns its bronze partition, so loading it again rewrites that partition instead of adding to it.
    """
    for table in dict.fromkeys(row["table_name"] for row in files):
        paths = [escaped_glob(row["path"]) for row in files if row["table_name"] == table]
        route = bronze.route_of(table)
        rows = tolerant_csv(spark, paths, route.schema, **{"text_bytes": route.text_bytes, **bronze.csv_options})
        with compiled_methods(spark):
            replace_partitions(rows, bronze.table_path(table), "source_file", "source_id")


def record_files(spark: SparkSession, bronze: Bronze, files: Sequence, load_time: Column | None = None) -> None:
    schema = T.StructType(MANIFEST.fields[:2])
    loaded = spark.createDataFrame([(row["filename"], row["table_name"]) for row in files], schema)
    # At most one list of names: the manifest is cut down to them where it lies, and only the new rows meet in one file.
    known = bronze.manifest(spark).join(F.broadcast(loaded.select("filename")), "filename", "left_semi")
    additions = manifest_additions(loaded, known, load_time)
    append_rows(additions.repartition(1), bronze.table_path(MANIFEST_TABLE))


def ingest_listing(
    spark: SparkSession,
    bronze: Bronze,
    listing: DataFrame,
    *,
    load_time: Column | None = None,
    on_empty: str = "raise",
    files_per_load: int = FILES_PER_LOAD,
) -> int:
    """Load the listed files that are new and return their number.

    All names are routed before anything is loaded, so an unknown name stops the run with nothing half done. Files are
    recorded after they are loaded, a name only once its last file is: a run that dies is simply repeated.
    """
    found = new_files(listing, bronze.manifest(spark))
    routed = route_files(found, bronze.routes).select("path", "filename", "table_name")
    # Fixed before the first load: the loop below changes the manifest that discovery reads.
    routed = settled(routed.sort("table_name", "filename", "path"))
    unknown = routed.where(F.col("table_name").isNull()).first()
    if unknown is not None:
        raise UnroutedFileError(f"No matching table for file: {unknown['filename']}")
    loaded = 0
    for chunk, unfinished in _chunks(routed, files_per_load):
        load_files(spark, bronze, chunk)
        record_files(spark, bronze, [row for row in chunk if row["filename"] != unfinished], load_time)
        loaded += len(chunk)
    if not loaded and on_empty == "raise":
        raise NoNewFilesError("No new files to ingest")
    return loaded


def ingest_folder(spark: SparkSession, bronze: Bronze, landing: str, **options) -> int:
    """Discover and load everything new below `landing`."""
    return ingest_listing(spark, bronze, list_files(spark, landing, ".csv"), **options)
