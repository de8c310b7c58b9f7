"""One query per operator, each over whole test tables, with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import base_name, digest, join_path, last_segment
from ..operators import quality, quarantine, reshape, upsert
from ..plans import gold, medallion, silver
from ..schemas import WORK_DATE_DIM, fact_schema
from ..session import scratch_path, settled
from ..sources import conformance, csv, file_listing, ingest, listing, tables
from ..sources.key_index import KeyIndex
from ..sources.ledger import Ledger
from ..streaming.arrivals import ingest_stream
from . import inputs
from . import oracles as sql
from .inputs import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if oracle is not None:
            ORACLES[key] = oracle
        return function

    return register


def without_stamp(df: DataFrame) -> DataFrame:
    return df.drop("updated_at")


# Sources and sinks ----------------------------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
    CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"""
)
def csv_bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV files, discovered, loaded to bronze and read back."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderpriority",
    )
    landing = scratch_path(spark, "orders-landing")
    inputs.write_csv(orders, landing)
    bronze = ingest.Bronze(scratch_path(spark, "orders-bronze"), [listing.Route("part-", "orders", orders.schema)])
    ingest.ingest_folder(spark, bronze, landing)
    return bronze.table(spark, "orders").drop("source_file")


@query(
    """SELECT c_custkey,
    CASE c_mktsegment WHEN 'BUILDING' THEN substring(repeat(c_name, 20), 1, 256)
      WHEN 'FURNITURE' THEN '??' || c_name WHEN 'HOUSEHOLD' THEN repeat('é', 128)
      WHEN 'MACHINERY' THEN c_name || ', "x"' ELSE c_name END AS name,
    CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_mktsegment END AS segment,
    CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS balance,
    CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN '' END AS remark
    FROM customer"""
)
def csv_tolerant_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in CSV lines of five kinds: short, too long in ASCII and in UTF-8, with stray bytes, and quoted.

    Lines are written byte by byte (Latin-1), so E9 alone is a stray byte and C3 A9 is a two-byte character.
    """
    name = F.col("c_name")
    written = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.repeat(name, F.lit(20)))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("ÿþ"), name))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.repeat(F.lit("Ã©"), F.lit(130)), name))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit('"'), name, F.lit(', ""x"""')))
        .otherwise(name)
    )
    key = F.col("c_custkey").cast("string")
    surplus_digit = F.concat(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.lit("9"))
    full = F.concat_ws(",", key, written, "c_mktsegment", surplus_digit, F.lit(""))
    line = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat_ws(",", key, written)).otherwise(full)
    landing = scratch_path(spark, "tolerant-landing")
    (
        table(spark, sf_dir, "customer")
        .select(line.alias("header"))
        .write.options(header=True, sep="\u0001", quote="", encoding="ISO-8859-1")
        .csv(landing)
    )
    schema = T.StructType.fromDDL(
        "c_custkey bigint, name string, segment string, balance decimal(18,2), remark string"
    )
    return csv.tolerant_csv(spark, [landing], schema, text_bytes={csv.EVERY_COLUMN: 256}).drop("source_file", "source_id")


@query("SELECT doc_id, lang, md5(text) AS text_md5, length(text) AS n_chars FROM documents WHERE text IS NOT NULL")
def csv_multiline_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of many lines in quoted CSV fields, read in byte ranges."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", "lang", "text")
    landing = scratch_path(spark, "lines-landing")
    inputs.write_csv(docs, landing, quoteAll=True)
    read = csv.tolerant_csv(spark, [landing], docs.schema, multi_line=True)
    return read.select("doc_id", "lang", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


@query(
    """WITH named AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'DailyNurseStaffing_'
      WHEN 'error' THEN 'PROVIDERINFO-' WHEN 'view' THEN 'dailynursestaffing' ELSE 'Other_' END
      || CAST(user_id AS VARCHAR) || '.csv' AS filename FROM events)
    SELECT event_id, filename, CASE WHEN filename ILIKE 'DailyNurseStaffing%' THEN 'daily_nurse_staffing'
      WHEN filename ILIKE 'ProviderInfo%' THEN 'provider_info' END AS table_name FROM named"""
)
def file_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = (
        F.when(F.col("event_type") == "click", "DailyNurseStaffing_")
        .when(F.col("event_type") == "error", "PROVIDERINFO-")
        .when(F.col("event_type") == "view", "dailynursestaffing")
        .otherwise("Other_")
    )
    names = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("in/"), prefix, F.col("user_id").cast("string"), F.lit(".csv")).alias("path")
    )
    return listing.route_files(names, ingest.default_routes()).drop("path")


@query(
    """WITH paths AS (SELECT doc_id, 's3://b/' || source || '/' || CASE WHEN lang = 'fr' THEN '' ELSE lang || '.csv' END
      AS path FROM documents)
    SELECT doc_id, path, nullif(regexp_extract(path, '[^/]+$'), '') AS by_pattern,
      split_part(path, '/', -1) AS by_split FROM paths"""
)
def file_name_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ways to take the file name; they differ after a trailing slash."""
    name = F.when(F.col("lang") == "fr", "").otherwise(F.concat("lang", F.lit(".csv")))
    paths = table(spark, sf_dir, "documents").select(
        "doc_id", join_path("s3://b/", F.col("source"), "/", name).alias("path")
    )
    return paths.select(
        "*", base_name(F.col("path")).alias("by_pattern"), last_segment(F.col("path")).alias("by_split")
    )


@query(sql.with_parts(sql.LISTING, select="SELECT filename, path FROM fresh"))
def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.new_files(inputs.document_listing(spark, sf_dir), inputs.labelled_manifest(spark, sf_dir))


@query(
    sql.with_parts(
        sql.LISTING,
        select="""SELECT filename, table_name, TIMESTAMP '2020-01-01 00:00:00' AS load_time FROM manifest
        UNION ALL SELECT DISTINCT regexp_extract(path, '[^/]+$'), 'documents', TIMESTAMP '2026-01-01 00:00:00'
        FROM listing WHERE regexp_extract(path, '[^/]+$') NOT IN (SELECT filename FROM manifest)""",
    )
)
def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed file recorded; those the manifest knows keep their load time."""
    known = inputs.labelled_manifest(spark, sf_dir).distinct()
    manifest = known.withColumn("load_time", inputs.stamp(inputs.OLD_STAMP))
    loaded = inputs.document_listing(spark, sf_dir).select(
        base_name(F.col("path")).alias("filename"), F.lit("documents").alias("table_name")
    )
    return manifest.unionByName(ingest.manifest_additions(loaded, manifest, inputs.stamp()))


DUE = """due AS (SELECT CAST(doc_id AS VARCHAR) AS filename, source AS folder FROM documents
  WHERE lang <> 'es' AND doc_id NOT IN (SELECT doc_id FROM labels))"""


def _due(spark: SparkSession, sf_dir: str) -> DataFrame:
    mime_type = F.when(F.col("lang") == "es", "text/plain").otherwise("text/csv")
    source = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("filename"), F.col("source").alias("folder"), mime_type.alias("mime_type")
    )
    landed = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("filename"))
    return listing.due_files(source, landed).drop("mime_type")


@query(sql.with_parts(DUE, select="SELECT filename, folder FROM due"))
def landing_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _due(spark, sf_dir)


@query(sql.with_parts(DUE, select="""SELECT 'success' AS status, count(*) AS "count" FROM due"""))
def landing_diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.sync_summary(_due(spark, sf_dir))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def incremental_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arriving as CSV files in two drops, each followed by a run of the arrival stream."""
    events = table(spark, sf_dir, "events")
    landing, checkpoint = scratch_path(spark, "events-landing"), scratch_path(spark, "events-checkpoint")
    bronze = ingest.Bronze(scratch_path(spark, "events-bronze"), [listing.Route("part-", "events", events.schema)])
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for number, rows in enumerate((events.where(early), events.where(~early))):
        inputs.write_csv(rows, f"{landing}/drop_{number}", timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")
        ingest_stream(spark, bronze, landing, checkpoint).awaitTermination()
    return bronze.table(spark, "events").drop("source_file")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def prefix_listing_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in one folder per day, listed with a task for each folder and loaded to bronze."""
    events = table(spark, sf_dir, "events")
    landing = scratch_path(spark, "days-landing")
    days = events.withColumn("day", F.col("ts").cast("date")).repartition("day")
    form = {"header": True, "escape": '"', "emptyValue": '""', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    days.write.partitionBy("day").options(**form).csv(landing)
    bronze = ingest.Bronze(scratch_path(spark, "days-bronze"), [listing.Route("part-", "events", events.schema)])
    ingest.ingest_listing(spark, bronze, file_listing.scan_files(spark, landing, ".csv"))
    return bronze.table(spark, "events").drop("source_file")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def prefix_arrival_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arriving in two drops, each followed by a run of the listing stream, which goes on from its stored offset."""
    events = table(spark, sf_dir, "events")
    landing, checkpoint = scratch_path(spark, "events-landing"), scratch_path(spark, "events-checkpoint")
    bronze = ingest.Bronze(scratch_path(spark, "events-bronze"), [listing.Route("part-", "events", events.schema)])
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for number, rows in enumerate((events.where(early), events.where(~early))):
        inputs.write_csv(rows, f"{landing}/drop_{number}", timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")
        files = file_listing.stream_files(spark, landing)
        ingest_stream(spark, bronze, landing, checkpoint, files=files).awaitTermination()
    return bronze.table(spark, "events").drop("source_file")


CONFORMANCE_LAYOUT = (
    "l_orderkey bigint, l_partkey int, l_linenumber smallint, l_extendedprice decimal(6,2), "
    "l_shipdate timestamp_ntz, l_comment string"
)


@query(
    """SELECT 'l_orderkey' AS "column", 'bigint' AS expected, 'bigint' AS actual, true AS ok,
      count(*) - count(l_orderkey) AS unfit_values FROM lineitem
    UNION ALL SELECT 'l_partkey', 'int', 'bigint', false, count(*) - count(TRY_CAST(l_partkey AS INTEGER)) FROM lineitem
    UNION ALL SELECT 'l_linenumber', 'smallint', 'int', false, count(*) - count(TRY_CAST(l_linenumber AS SMALLINT))
      FROM lineitem
    UNION ALL SELECT 'l_extendedprice', 'decimal(6,2)', 'double', false,
      count(*) - count(TRY_CAST(l_extendedprice AS DECIMAL(6,2))) FROM lineitem
    UNION ALL SELECT 'l_shipdate', 'timestamp_ntz', 'timestamp_ntz', true, count(*) - count(l_shipdate) FROM lineitem
    UNION ALL SELECT 'l_comment', 'string', NULL, false, NULL"""
)
def schema_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = T.StructType.fromDDL(CONFORMANCE_LAYOUT)
    return conformance.schema_conformance(table(spark, sf_dir, "lineitem"), declared)


@query(sql.GOLD)
def gold_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table written twice; the second content replaces the first."""
    rows = _gold(spark, sf_dir)
    path = scratch_path(spark, "gold")
    tables.replace_table(rows.where(F.col("month") == 1), path)
    tables.replace_table(rows, path)
    return tables.read_table(spark, path, rows.schema)


# Stages and reshaping -------------------------------------------------------------------------------------------------


@query(
    sql.with_parts(
        sql.FACILITIES, select="SELECT DISTINCT f.* FROM facilities f JOIN lineitem ON CAST(l_suppkey AS VARCHAR) = ccn"
    )
)
def provider_dim_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.provider_stage(inputs.facility_reports(spark, sf_dir))


@query(
    sql.with_parts(
        sql.FACILITIES,
        select="""SELECT ccn, CASE WHEN state = 'NATION_3' THEN providername ELSE 'new ' || providername END AS providername,
          provideraddress, city, state, zipcode, numberofbed, latitude, longitude FROM facilities""",
    )
)
def provider_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the facilities; the second renames all, and lacks one state."""
    name = silver.PROVIDER_COLUMNS["providername"]
    old = inputs.facilities(spark, sf_dir).withColumn("Processing_Date", F.lit("2024-01-01").cast("date"))
    new = old.where(F.col("State") != "NATION_3").withColumns(
        {name: F.concat(F.lit("new "), name), "Processing_Date": F.lit("2024-02-01").cast("date")}
    )
    return silver.provider_stage(silver.latest_providers(new.unionByName(old)))


@query(sql.with_parts(sql.STAFFING, sql.FACT_STAGE, select="SELECT * FROM stage"))
def fact_unpivot_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.fact_stage(inputs.staffing(spark, sf_dir))


@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.union_distinct(
        table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey")),
        table(spark, sf_dir, "supplier").select("s_nationkey"),
    )


@query(
    sql.with_parts(
        sql.STAFFING, sql.FACT_STAGE, sql.TYPES,
        select="""SELECT t.staffingtypeid, t.title, t.staffingtype, count(s.ccn) AS facts FROM types t
        LEFT JOIN stage s ON CAST(s.staffingtypeid AS INTEGER) = t.staffingtypeid GROUP BY ALL""",
    )
)
def literal_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constant staffing types, with the number of fact rows that use each."""
    used = silver.fact_stage(inputs.staffing(spark, sf_dir)).groupBy(F.col("staffingtypeid").cast("int")).count()
    used = used.toDF("staffingtypeid", "facts")
    types = silver.staffing_type_stage(spark)
    return types.join(used, "staffingtypeid", "left").fillna(0, ["facts"])


@query(sql.with_parts(sql.STAFFING, sql.FACT_STAGE, select="SELECT * FROM stage"))
def ordered_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.ordered_within_files(silver.fact_stage(inputs.staffing(spark, sf_dir)), "workdateid")


@query(
    sql.with_parts(
        sql.STAFFING, sql.FACT_STAGE,
        select="""SELECT ccn, workdateid, CAST(numofpatient AS INTEGER) AS numofpatient, staffingtypeid,
        CAST(workhours AS DECIMAL(18,0)) AS workhours FROM stage""",
    )
)
def typed_cast_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.typed_fact(silver.fact_stage(inputs.staffing(spark, sf_dir)), strict_scale=True)


@query(sql.with_parts(sql.STAFFING, sql.CALENDAR, select="SELECT * FROM calendar"))
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.work_date_stage(inputs.staffing(spark, sf_dir))


# Merges ---------------------------------------------------------------------------------------------------------------

CUSTOMERS_SQL = sql.CUSTOMERS.format(key="c_custkey")
NULL_KEY_SQL = sql.CUSTOMERS.format(key="CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_custkey END")


@query(sql.with_parts(CUSTOMERS_SQL, select=sql.UPDATED))
def update_from_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, stage = inputs.old_customers(spark, sf_dir), inputs.changed_customers(spark, sf_dir)
    return upsert.update_from(target, stage, ["custkey"], stamp=inputs.stamp())


@query(sql.with_parts(CUSTOMERS_SQL, select=sql.INSERTED))
def insert_missing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, stage = inputs.old_customers(spark, sf_dir), inputs.changed_customers(spark, sf_dir)
    return upsert.missing_rows(target, stage, ["custkey"], stamp=inputs.stamp())


@query(sql.with_parts(CUSTOMERS_SQL, select=f"{sql.UPDATED} UNION ALL {sql.INSERTED}"))
def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, stage = inputs.old_customers(spark, sf_dir), inputs.changed_customers(spark, sf_dir)
    return upsert.upsert(target, stage, ["custkey"], stamp=inputs.stamp())


@query(sql.with_parts(CUSTOMERS_SQL, select=f"{sql.UPDATED} UNION ALL {sql.INSERTED}"))
def dim_upsert_single_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The policy that admits one row per new key: update and insert from a single full outer join."""
    target, stage = inputs.old_customers(spark, sf_dir), inputs.changed_customers(spark, sf_dir)
    return upsert.upsert(target, stage, ["custkey"], stamp=inputs.stamp(), insert_duplicates="one")


@query(sql.with_parts(NULL_KEY_SQL, select=f"{sql.UPDATED} UNION ALL {sql.INSERTED}"))
def dim_upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole segment without keys: its target rows stay, its stage rows are added again."""
    key = inputs.segment_null_key()
    target, stage = inputs.old_customers(spark, sf_dir, key), inputs.changed_customers(spark, sf_dir, key)
    return upsert.upsert(target, stage, ["custkey"], stamp=inputs.stamp())


@query(
    sql.with_parts(
        sql.TYPES,
        select="""SELECT n.id AS staffingtypeid, coalesce(t.title, 'old title') AS title,
        coalesce(t.staffingtype, 'old type') AS staffingtype
        FROM (SELECT DISTINCT l_linenumber AS id FROM lineitem) n LEFT JOIN types t ON t.staffingtypeid = n.id
        UNION ALL SELECT * FROM types WHERE staffingtypeid NOT IN (SELECT l_linenumber FROM lineitem)""",
    )
)
def literal_dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four types merged into a dimension that holds an outdated row per line number."""
    target = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("staffingtypeid")).distinct().select(
        "staffingtypeid",
        F.lit("old title").alias("title"),
        F.lit("old type").alias("staffingtype"),
        F.lit(inputs.OLD_STAMP).cast("timestamp").alias("updated_at"),
    )
    return without_stamp(silver.build_staffing_type_dim(target))


@query(
    sql.with_parts(
        sql.STAFFING, sql.CALENDAR,
        select="""SELECT workdateid, workdate, month, monthname, year, quarter,
        workdateid < 19980101 AS was_known FROM calendar""",
    )
)
def date_dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar merged into a target that knows the days before 1998 without their attributes."""
    staffing = inputs.staffing(spark, sf_dir)
    known = staffing.where(F.col("WorkDate") < "19980101").select(F.col("WorkDate").cast("int").alias("workdateid"))
    blank = {f.name: F.lit(None).cast(f.dataType) for f in WORK_DATE_DIM.fields[1:]}
    target = known.distinct().withColumns(blank)
    merged = silver.build_work_date_dim(staffing, target)
    return without_stamp(merged).join(known.distinct().withColumn("was_known", F.lit(True)), "workdateid", "left").fillna(
        False, ["was_known"]
    )


@query(
    sql.with_parts(
        sql.STAFFING, sql.FACT_STAGE, sql.FACT,
        """target AS (SELECT DISTINCT ccn, workdateid, staffingtypeid FROM fact WHERE workdateid < '19980101'),
        best AS (SELECT *, row_number() OVER (PARTITION BY ccn, workdateid, staffingtypeid
          ORDER BY numofpatient DESC, workhours DESC) AS place FROM fact)""",
        select="""SELECT ccn, workdateid, numofpatient, staffingtypeid, workhours FROM best
        WHERE place = 1 AND workdateid < '19980101'
        UNION ALL SELECT ccn, workdateid, numofpatient, staffingtypeid, workhours FROM fact f WHERE NOT EXISTS
        (SELECT 1 FROM target t WHERE t.ccn = f.ccn AND t.workdateid = f.workdateid
         AND t.staffingtypeid = f.staffingtypeid)""",
    )
)
def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact merged into a target that knows the keys before 1998 with zero census and hours."""
    staffing = inputs.staffing(spark, sf_dir)
    keys = silver.fact_bag(staffing.where(F.col("WorkDate") < "19980101")).select(*silver.FACT_KEY).distinct()
    zero = {f.name: F.lit(0).cast(f.dataType) for f in fact_schema().fields if f.name in ("numofpatient", "workhours")}
    target = keys.withColumns(zero).withColumn("updated_at", F.lit(inputs.OLD_STAMP).cast("timestamp"))
    return without_stamp(silver.build_fact(staffing, target.select(*fact_schema().names)))


# Joins and aggregates -------------------------------------------------------------------------------------------------


@query(
    sql.with_parts(
        sql.FACILITIES, sql.STAFFING, sql.FACT_STAGE, sql.FACT,
        select="""SELECT f.ccn, f.workdateid, f.numofpatient, f.staffingtypeid, f.workhours, p.providername, p.city,
        p.state, p.longitude, p.latitude, p.numberofbed FROM fact f JOIN facilities p ON f.ccn = p.ccn""",
    )
)
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.with_provider(inputs.fact(spark, sf_dir), inputs.providers(spark, sf_dir))


@query(
    sql.with_parts(
        sql.STAFFING, sql.FACT_STAGE, sql.FACT, sql.CALENDAR, sql.TYPES,
        select="""SELECT f.ccn, f.workdateid, f.numofpatient, f.staffingtypeid, f.workhours, d.month, d.monthname, d.year,
        s.title, s.staffingtype FROM fact f JOIN types s ON CAST(f.staffingtypeid AS INTEGER) = s.staffingtypeid
        JOIN calendar d ON d.workdateid = CAST(f.workdateid AS INTEGER)""",
    )
)
def star_join_implicit_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text ids of the fact joined to the numeric ids of two dimensions."""
    rows = gold.with_calendar(inputs.fact(spark, sf_dir), settled(date_dim(spark, sf_dir)))
    return gold.with_type(rows, silver.staffing_type_stage(spark)).drop("date_key", "type_key")


@query(
    sql.with_parts(
        sql.STAFFING, sql.FACT_STAGE,
        select="""SELECT ccn, staffingtypeid, CAST(sum(workhours) AS DECIMAL(28,2)) AS totalworkhour FROM stage
        GROUP BY ccn, staffingtypeid""",
    )
)
def sum_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.fact(spark, sf_dir).groupBy("ccn", "staffingtypeid").agg(F.sum("workhours").alias("totalworkhour"))


@query(
    sql.with_parts(
        sql.FACILITIES, sql.STAFFING, sql.FACT_STAGE, sql.FACT,
        select=f"""SELECT f.ccn, f.staffingtypeid, {sql.EXACT_RATE} AS bedutilizationrate
        FROM fact f JOIN facilities p ON f.ccn = p.ccn GROUP BY f.ccn, f.staffingtypeid""",
    )
)
def avg_ratio_nullif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.bed_utilization(inputs.fact(spark, sf_dir), inputs.providers(spark, sf_dir))


def _gold(spark: SparkSession, sf_dir: str, mode: str = "exact") -> DataFrame:
    return without_stamp(
        gold.build_utilization(
            inputs.fact(spark, sf_dir),
            inputs.providers(spark, sf_dir),
            silver.staffing_type_stage(spark),
            settled(date_dim(spark, sf_dir)),
            mode=mode,
        )
    )


@query(sql.GOLD)
def gold_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir)


# Checks ---------------------------------------------------------------------------------------------------------------


@query(
    """SELECT 'click' AS subset, CAST(count(*) > 0 AS BIGINT) AS "rows" FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'negative', CAST(count(*) > 0 AS BIGINT) FROM events WHERE value < -1
    UNION ALL SELECT 'all', CAST(count(*) > 0 AS BIGINT) FROM events"""
)
def check_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    subsets = {
        "click": events.where(F.col("event_type") == "click"), "negative": events.where(F.col("value") < -1), "all": events
    }
    return reduce(
        DataFrame.unionByName,
        [quality.row_presence(df).select(F.lit(name).alias("subset"), "rows") for name, df in subsets.items()],
    )


@query(
    """SELECT 'event_id' AS "column", true AS present, count(event_id) AS filled FROM events
    UNION ALL SELECT 'event_type', true, count(nullif(event_type, 'view')) FROM events
    UNION ALL SELECT 'session_id', false, 0"""
)
def check_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names arrive padded and in upper case; one required column is absent."""
    events = table(spark, sf_dir, "events").withColumn("event_type", F.nullif("event_type", F.lit("view")))
    untidy = events.toDF(*[f" {c.upper()} " for c in events.columns])
    return quality.column_coverage(untidy, ["event_id", "event_type", "session_id"])


def _faulty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.nullif("event_type", F.lit("click")).alias("event_type"),
        F.when(F.col("value") > 5, F.col("value")).alias("value"),
        "user_id",
    )


@query(
    """WITH faulty AS (SELECT nullif(event_type, 'click') AS event_type, CASE WHEN value > 5 THEN value END AS value,
      user_id FROM events)
    SELECT 'event_type' AS "column", CAST(sum(CASE WHEN event_type IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS violations
      FROM faulty
    UNION ALL SELECT 'value', CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM faulty
    UNION ALL SELECT 'user_id', CAST(sum(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM faulty"""
)
def check_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(_faulty_events(spark, sf_dir), ["event_type", "value", "user_id"])


@query(
    """WITH texts AS (SELECT CASE WHEN lang <> 'fr' THEN text END AS text FROM documents)
    SELECT CAST(sum(n - 1) AS BIGINT) AS violations FROM (SELECT text, count(*) AS n FROM texts GROUP BY text)"""
)
def check_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat an earlier text; one language counts as NULL."""
    text = F.when(F.col("lang") != "fr", digest(F.col("text")))
    return quality.duplicate_count(table(spark, sf_dir, "documents").select(text.alias("text")), ["text"])


CHECKED_FACILITIES = """
reports AS (
  SELECT DISTINCT CASE WHEN state <> 'NATION_7' THEN ccn END AS cms_certification_number_ccn,
  providername AS provider_name,
  provideraddress || CASE WHEN state = 'NATION_5' THEN l_returnflag ELSE '' END AS provider_address,
  nullif(city, 'City of NATION_3') AS city_town, state, zipcode AS zip_code,
  nullif(numberofbed, 0) AS number_of_certified_beds, latitude, longitude
  FROM facilities JOIN lineitem ON CAST(l_suppkey AS VARCHAR) = ccn)"""
CHECKED_STAFFING = """
staffing AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS provnum, strftime(nullif(l_shipdate, DATE '1997-07-01'), '%Y%m%d') AS workdate,
         CAST(l_linenumber AS VARCHAR) AS census, CAST(nullif(l_quantity, 7) AS DECIMAL(18,2)) AS h1,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS h2, CAST(l_discount AS DECIMAL(18,2)) AS h3,
         CAST(l_tax AS DECIMAL(18,2)) AS h4
  FROM lineitem)"""
CHECKED_CALENDAR = "dates AS (SELECT *, 1 AS updated_at FROM calendar)"
CHECKED_FACT = "facts AS (SELECT *, 1 AS updated_at FROM stage)"
# The columns that the checks expect.
PROVIDER_COLUMNS = [
    "cms_certification_number_ccn", "provider_name", "provider_address", "city_town", "state", "zip_code",
    "number_of_certified_beds", "latitude", "longitude",
]
DATE_COLUMNS = ["workdateid", "workdate", "month", "monthname", "year", "quarter", "updated_at"]
FACT_COLUMNS = ["ccn", "workdateid", "numofpatient", "staffingtypeid", "workhours", "updated_at"]
CHECKS_SQL = {
    "validate_provider": (
        [sql.FACILITIES, CHECKED_FACILITIES],
        ("reports", "bronze.providerinfo", PROVIDER_COLUMNS, ["cms_certification_number_ccn"]),
    ),
    "validate_date_dim": (
        [CHECKED_STAFFING, sql.CALENDAR, CHECKED_CALENDAR],
        ("dates", "bronze.dailynursestaffing", DATE_COLUMNS, ["workdateid"]),
    ),
    "validate_fact": (
        [CHECKED_STAFFING, sql.FACT_STAGE, CHECKED_FACT],
        ("facts", "unioned dailynursestaffing", FACT_COLUMNS, ()),
    ),
}


def _checks_sql(key: str) -> str:
    parts, arguments = CHECKS_SQL[key]
    return sql.with_parts(*parts, select=sql.check_rows(*arguments))


def faulty_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility reports with missing keys, two spellings of an address, and missing cities and beds."""
    reports = inputs.facility_reports(spark, sf_dir)
    spelling = F.when(F.col("State") == "NATION_5", F.col("l_returnflag")).otherwise("")
    return reports.withColumns(
        {
            "CMS_Certification_Number_CCN": F.when(F.col("State") != "NATION_7", F.col("CMS_Certification_Number_CCN")),
            "Provider_Address": F.concat("Provider_Address", spelling),
            "City_Town": F.nullif("City_Town", F.lit("City of NATION_3")),
            "Number_of_Certified_Beds": F.nullif("Number_of_Certified_Beds", F.lit(0)),
        }
    )


def faulty_staffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staffing days with a missing date and missing hours."""
    return inputs.staffing(spark, sf_dir).withColumns(
        {
            "WorkDate": F.nullif("WorkDate", F.lit("19970701")),
            "Hrs_RNDON_emp": F.nullif("Hrs_RNDON_emp", F.lit(7).cast("decimal(18,2)")),
        }
    )


def _results(spark: SparkSession, sf_dir: str, checks: quality.CheckSet) -> DataFrame:
    reports, days = faulty_reports(spark, sf_dir), faulty_staffing(spark, sf_dir)
    return medallion.validation_results(reports, days, only=[checks]).drop("relation")


@query(_checks_sql("validate_provider"))
def validate_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir, silver.PROVIDER_CHECKS)


@query(_checks_sql("validate_date_dim"))
def validate_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir, silver.WORK_DATE_CHECKS)


@query(_checks_sql("validate_fact"))
def validate_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir, silver.FACT_CHECKS)


@query(
    sql.with_parts(
        sql.STAFFING, sql.FACT_STAGE,
        select=sql.check_rows("stage", "fact", ["ccn", "workdateid", "staffingtypeid"], ())
        + """
    UNION ALL SELECT 8, 'unique', 'ccn, workdateid, staffingtypeid', CAST(sum(n - 1) AS BIGINT),
      CAST(CAST(sum(n - 1) AS BIGINT) AS VARCHAR) || ' duplicate values in ccn, workdateid, staffingtypeid'
    FROM (SELECT count(*) AS n FROM stage GROUP BY ccn, workdateid, staffingtypeid)""",
    )
)
def check_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's key of three columns, checked as a whole."""
    key = ["ccn", "workdateid", "staffingtypeid"]
    stage = silver.fact_stage(inputs.staffing(spark, sf_dir))
    return quality.check_results(stage, quality.CheckSet("fact", required=key, unique_together=[key]))


@query(
    " UNION ALL ".join(
        f"""SELECT '{arguments[1]}' AS relation, * FROM ({_checks_sql(key)}) WHERE violations > 0"""
        for key, (_, arguments) in CHECKS_SQL.items()
    )
)
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings on the three faulty relations."""
    found = medallion.validation_results(faulty_reports(spark, sf_dir), faulty_staffing(spark, sf_dir))
    return found.where(F.col("violations") > 0)


@query(
    sql.with_parts(
        sql.FACILITIES, sql.STAFFING,
        select="""SELECT CAST(11 + 9 + 7 AS BIGINT) AS checks, CAST(
        (SELECT count(*) FROM facilities WHERE ccn IS NULL) + (SELECT count(*) - count(DISTINCT ccn) FROM facilities)
        + (SELECT count(*) FROM staffing WHERE provnum IS NULL OR workdate IS NULL OR census IS NULL OR h1 IS NULL
           OR h2 IS NULL OR h3 IS NULL OR h4 IS NULL) AS BIGINT) AS violations, true AS passed""",
    )
)
def validation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean input: the gate opens."""
    return medallion.gate(inputs.facilities(spark, sf_dir), inputs.staffing(spark, sf_dir))


OBSERVED_COLUMNS = ["PROVNUM", "WorkDate", "MDScensus", "Hrs_RNDON_emp"]


@query(
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (l_shipdate = DATE '1997-07-01') AS d, count(*) FILTER (l_quantity = 7) AS h
      FROM lineitem)
    SELECT 0 AS position, 'not_empty' AS "check", CAST(NULL AS VARCHAR) AS "column", CAST(n = 0 AS BIGINT) AS violations,
      'Query returned no data from staffing' AS message FROM c
    UNION ALL SELECT 2, 'not_null', 'PROVNUM', 0, '0 NULL values in PROVNUM'
    UNION ALL SELECT 4, 'not_null', 'WorkDate', d, d || ' NULL values in WorkDate' FROM c
    UNION ALL SELECT 6, 'not_null', 'MDScensus', 0, '0 NULL values in MDScensus'
    UNION ALL SELECT 8, 'not_null', 'Hrs_RNDON_emp', h, h || ' NULL values in Hrs_RNDON_emp' FROM c"""
)
def observed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL counts of staffing rows, observed while the rows are staged."""
    rules = quarantine.null_rules(OBSERVED_COLUMNS)
    return quarantine.staged(faulty_staffing(spark, sf_dir), rules, scratch_path(spark, "staged")).report("staffing")


@query(
    """SELECT CAST(l_suppkey AS VARCHAR) AS provnum, strftime(nullif(l_shipdate, DATE '1997-07-01'), '%Y%m%d') AS workdate,
      CAST(nullif(l_quantity, 7) AS DECIMAL(18,2)) AS hours,
      CAST(CASE WHEN l_shipdate = DATE '1997-07-01' THEN 2 ELSE 0 END + CASE WHEN l_quantity = 7 THEN 8 ELSE 0 END AS BIGINT)
      AS broken_rules FROM lineitem WHERE l_shipdate = DATE '1997-07-01' OR l_quantity = 7"""
)
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staffing rows that break a rule, with the bits of the rules they break."""
    rules = quarantine.null_rules(OBSERVED_COLUMNS)
    found = quarantine.staged(faulty_staffing(spark, sf_dir), rules, scratch_path(spark, "staged"))
    named = {"PROVNUM": "provnum", "WorkDate": "workdate", "Hrs_RNDON_emp": "hours", quarantine.BROKEN: quarantine.BROKEN}
    return found.quarantined.select(*[F.col(c).alias(to) for c, to in named.items()])


# End to end -----------------------------------------------------------------------------------------------------------


@query(sql.GOLD)
def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files of both kinds dropped in a landing folder and run through to the gold table."""
    landing = scratch_path(spark, "landing")
    inputs.drop_domain_files(spark, sf_dir, landing)
    config = medallion.Medallion(landing, scratch_path(spark, "warehouse"))
    return without_stamp(medallion.run_medallion(spark, config))


@query(sql.GOLD)
def medallion_second_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops, the second with the days from February 1996 on: its run checks and merges only the months it brings."""
    landing = scratch_path(spark, "landing")
    config = medallion.Medallion(landing, scratch_path(spark, "warehouse"))
    days = inputs.staffing(spark, sf_dir)
    inputs.drop_facilities(spark, sf_dir, landing)
    inputs.drop_staffing(days.where("WorkDate < '19960201'"), landing, "DailyNurseStaffing_early")
    medallion.run_medallion(spark, config, scope="months")
    inputs.drop_staffing(days.where("WorkDate >= '19960201'"), landing, "DailyNurseStaffing_late")
    return without_stamp(medallion.run_medallion(spark, config, scope="months"))


@query(sql.gold_sql(sql.FACT_OF_TWO_RUNS))
def gold_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second drop brings the second half of one month: gold follows by the difference of that month's old and new rows."""
    landing = scratch_path(spark, "landing")
    config = medallion.Medallion(landing, scratch_path(spark, "warehouse"))
    days = inputs.staffing(spark, sf_dir)
    late = F.col("WorkDate").between("19960116", "19960131")
    inputs.drop_facilities(spark, sf_dir, landing)
    inputs.drop_staffing(days.where(~late), landing, "DailyNurseStaffing_most")
    medallion.run_medallion(spark, config, scope="months")
    inputs.drop_staffing(days.where(late), landing, "DailyNurseStaffing_late")
    return without_stamp(medallion.run_medallion(spark, config, scope="months"))


@query(
    """WITH c AS (SELECT c_custkey AS custkey, c_name AS name, c_mktsegment AS segment,
      CAST(c_acctbal AS DECIMAL(12,2)) AS balance FROM customer)
    SELECT 1 AS entry, * FROM c WHERE balance > 1000
    UNION ALL SELECT 2, * FROM c WHERE balance > 1000 AND segment NOT IN ('BUILDING', 'MACHINERY')
    UNION ALL SELECT 2, custkey, 'new ' || name, segment, balance FROM c WHERE segment = 'BUILDING'"""
)
def ledger_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table as of its first and its second entry: one segment rewritten, one emptied, the others shared by both."""
    customers = inputs.customer_rows(spark, sf_dir)
    ledger = Ledger(scratch_path(spark, "warehouse"))
    first = ledger.begin(spark)
    first.replace_partitions(customers.where("balance > 1000"), "customers", "segment")
    first.commit()
    second = ledger.begin(spark)
    building = customers.where("segment = 'BUILDING'").withColumn("name", F.concat(F.lit("new "), "name"))
    second.replace_partitions(building, "customers", "segment", emptied=["MACHINERY"])
    second.commit()
    entries = [ledger.read(spark, "customers", customers.schema, at=n).select(F.lit(n).alias("entry"), "*") for n in (1, 2)]
    return entries[0].unionByName(entries[1])


@query(
    """WITH l AS (SELECT CASE WHEN l_shipdate < DATE '1996-02-01' THEN 1 ELSE 2 END AS "drop", l_partkey AS part,
      nullif(l_suppkey, 7) AS supp FROM lineitem),
    keys AS (SELECT "drop", part, supp, count(*) AS copies FROM l GROUP BY ALL),
    judged AS (SELECT *, min("drop") OVER (PARTITION BY part, supp) < "drop" AS stored FROM keys)
    SELECT *, copies - 1 + CAST(stored AS BIGINT) AS violations FROM judged WHERE stored OR copies > 1"""
)
def unique_against_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of order lines entered in a key index; each key that repeats one of its own drop or of the drop before."""
    supp = F.when(F.col("l_suppkey") != 7, F.col("l_suppkey"))
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", F.col("l_partkey").alias("part"), supp.alias("supp"))
    index = KeyIndex(Ledger(scratch_path(spark, "warehouse")), "lines", ["part", "supp"])
    early = F.col("l_shipdate") < F.lit("1996-02-01").cast("date")
    found = [index.load(spark, lines.where(own)).select(F.lit(n).alias("drop"), "*") for n, own in ((1, early), (2, ~early))]
    return found[0].unionByName(found[1])
