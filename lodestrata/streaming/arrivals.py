"""Incremental ingestion: a stream of arriving files drives the same load as the batch job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.ingest import Bronze, ingest_listing
from ..sources.listing import LISTING_SCHEMA

# Bounds the files of one micro-batch.
FILES_PER_TRIGGER = 1_000


def arriving_files(spark: SparkSession, landing: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """A stream of file paths below `landing`; the files' content is not read here."""
    return (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(landing)
        .select("path")
    )


def ingest_stream(
    spark: SparkSession,
    bronze: Bronze,
    landing: str,
    checkpoint: str,
    *,
    load_time: Column | None = None,
    files_per_trigger: int = FILES_PER_TRIGGER,
    files: DataFrame | None = None,
) -> StreamingQuery:
    """Load what has arrived since the last run, then end; start it again for the next drop.

    `files` is another stream with a `path`, such as `file_listing.stream_files`, in place of Spark's file stream. The
    stream remembers full paths or a time, the manifest base names. Every micro-batch is compared with the manifest, which
    stays the authority, so a batch that is replayed after a failure loads nothing twice.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        ingest_listing(batch.sparkSession, bronze, batch, load_time=load_time, on_empty="skip")

    arriving = arriving_files(spark, landing, files_per_trigger) if files is None else files.select("path")
    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
