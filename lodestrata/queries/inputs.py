"""The pipeline's inputs, derived from the TPC-H-like tables: suppliers act as facilities, line items as staffing days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import join_path
from ..plans.silver import FACT_MEASURES, PROVIDER_COLUMNS, PROVIDER_KEY, fact_stage, provider_stage, typed_fact
from ..schemas import daily_nurse_staffing_schema, provider_info_schema
from ..session import filesystem, scratch_path

MEASURE_SOURCES = dict(
    zip(FACT_MEASURES.values(), ("l_quantity", "l_extendedprice", "l_discount", "l_tax"), strict=True)
)
OLD_STAMP = "2020-01-01 00:00:00"
RUN_STAMP = "2026-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(text: str = RUN_STAMP) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# Facilities and staffing days -----------------------------------------------------------------------------------------


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bronze provider row per supplier."""
    suppliers = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    coordinate = F.col("s_acctbal") / 100
    values = {
        "ccn": F.col("s_suppkey").cast("string"),
        "providername": F.col("s_name"),
        "provideraddress": join_path(F.col("s_suppkey").cast("string"), " ", F.col("n_name")),
        "city": F.concat(F.lit("City of "), "n_name"),
        "state": F.col("n_name"),
        "zipcode": (F.col("s_nationkey") + 10000).cast("int"),
        "numberofbed": F.col("s_nationkey"),
        "latitude": coordinate.cast("decimal(10,6)"),
        "longitude": (-coordinate).cast("decimal(10,6)"),
    }
    return suppliers.select(*[values[name].alias(source) for name, source in PROVIDER_COLUMNS.items()])


def facility_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facility row once per line item, as if every staffing day came with its facility's master data."""
    days = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias(PROVIDER_COLUMNS["ccn"]), "l_returnflag"
    )
    return days.join(facilities(spark, sf_dir), PROVIDER_COLUMNS["ccn"])


def staffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze staffing rows, as far as the fact and the calendar use them."""
    hours = [F.col(source).cast("decimal(18,2)").alias(name) for name, source in MEASURE_SOURCES.items()]
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("PROVNUM"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("WorkDate"),
        F.col("l_linenumber").cast("string").alias("MDScensus"),
        *hours,
    )


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provider_stage(facilities(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as a first run fills it, spread by provider for what is joined or summed by provider."""
    return typed_fact(fact_stage(staffing(spark, sf_dir), keys=PROVIDER_KEY))


# A customer dimension for the merges ----------------------------------------------------------------------------------


def customer_rows(spark: SparkSession, sf_dir: str, key: Column | None = None) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") if key is None else key).alias("custkey"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
    )


def old_customers(spark: SparkSession, sf_dir: str, key: Column | None = None) -> DataFrame:
    """A target: all segments but one, with outdated names and no balance yet."""
    return customer_rows(spark, sf_dir, key).where(F.col("segment") != "BUILDING").select(
        "custkey",
        F.concat(F.lit("old "), "name").alias("name"),
        "segment",
        F.lit(0).cast("decimal(12,2)").alias("balance"),
        stamp(OLD_STAMP).alias("updated_at"),
    )


def changed_customers(spark: SparkSession, sf_dir: str, key: Column | None = None) -> DataFrame:
    """A stage: the solvent customers; one segment comes without its name, so that a NULL has to overwrite."""
    return customer_rows(spark, sf_dir, key).where(F.col("balance") > 1000).select(
        "custkey",
        F.nullif(F.col("segment"), F.lit("MACHINERY")).alias("segment"),
        "name",
        "balance",
    )


def segment_null_key() -> Column:
    """Customer key that is NULL throughout one segment."""
    return F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_custkey"))


# File listings --------------------------------------------------------------------------------------------------------


def document_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per document, in a folder per source; one language has an upper-case suffix."""
    suffix = F.when(F.col("lang") == "de", ".CSV").otherwise(".csv")
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        join_path("s3://bucket/data/", F.col("source"), "/", F.col("doc_id").cast("string"), suffix).alias("path")
    )


def labelled_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest that knows the labelled documents' files."""
    return table(spark, sf_dir, "labels").select(
        join_path(F.col("doc_id").cast("string"), ".csv").alias("filename"), F.lit("documents").alias("table_name")
    )


# CSV drops ------------------------------------------------------------------------------------------------------------


def write_csv(df: DataFrame, folder: str, **options) -> None:
    df.write.options(**{"header": True, "escape": '"', "emptyValue": '""', **options}).csv(folder)


def drop_named_csv(df: DataFrame, landing: str, prefix: str) -> None:
    """Write CSV files below `landing` whose names start with `prefix`."""
    spark = df.sparkSession
    staging = scratch_path(spark, "csv")
    write_csv(df, staging)
    fs, folder = filesystem(spark, landing)
    fs.mkdirs(folder)
    parts = [s.getPath() for s in fs.listStatus(filesystem(spark, staging)[1]) if s.getPath().getName().endswith(".csv")]
    for number, part in enumerate(parts):
        target = f"{landing}/{prefix}_{number}.csv"
        if not fs.rename(part, filesystem(spark, target)[1]):
            raise OSError(f"could not move a file to {target}")


def as_file_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The full file layout, with NULL in every column that `df` lacks."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def drop_facilities(spark: SparkSession, sf_dir: str, landing: str) -> None:
    drop_named_csv(as_file_rows(facilities(spark, sf_dir), provider_info_schema()), landing, "ProviderInfo")


def drop_staffing(days: DataFrame, landing: str, prefix: str = "DailyNurseStaffing") -> None:
    drop_named_csv(as_file_rows(days, daily_nurse_staffing_schema()), landing, prefix)


def drop_domain_files(spark: SparkSession, sf_dir: str, landing: str) -> None:
    drop_facilities(spark, sf_dir, landing)
    drop_staffing(staffing(spark, sf_dir), landing)
