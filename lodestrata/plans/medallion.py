"""The whole flow: ingest, check, gate, merge silver, bring gold up to date, in one commit."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import maintained
from ..operators.quality import CheckSet, ValidationError, check_results, gate_status, validate
from ..operators.quarantine import BROKEN, null_rules, staged
from ..operators.reshape import ordered_within_files
from ..operators.skew import spread
from ..schemas import PROVIDER_DIM, STAFFING_TYPE_DIM, WORK_DATE_DIM, fact_schema, gold_schema
from ..session import freed_shuffles, scratch_path, settled
from ..sources.ingest import PROVIDER_TABLE, STAFFING_TABLE, Bronze, default_routes, ingest_folder
from ..sources.ledger import WHOLE, Commit, Ledger
from . import gold, silver

# More distinct months than this in one run and the fact is read without pruning.
MAX_TOUCHED_MONTHS = 10_000
MERGED = T.StructType([T.StructField("filename", T.StringType())])
# Runs whose merged files are kept apart before they are written together.
MERGED_VERSIONS = 50

# The tables of the warehouse that a run changes together.
FACT_TABLE = "silver/daily_facility_log_fact"
PROVIDER_DIM_TABLE = "silver/provider_dim"
TYPE_TABLE = "silver/staffing_type_dim"
DATE_TABLE = "silver/work_date_dim"
MERGED_TABLE = "silver/merged_files"
STATE_TABLE = "gold/monthly_state"
GOLD_TABLE = "gold/provider_staffing_utilization_metric"
QUARANTINE_TABLE = "quarantine/daily_nurse_staffing"
MONTH = "work_month"
STATE_KEYS = [*gold.MONTHLY_KEYS, MONTH]
STATE = T.StructType()
for _name, _kind in (
    ("ccn", T.StringType()), ("staffingtypeid", T.StringType()), ("month", T.IntegerType()), ("monthname", T.StringType()),
    ("year", T.IntegerType()), ("hours", T.DecimalType(38, 2)), ("hours_n", T.LongType()), ("census", T.LongType()),
    ("census_n", T.LongType()), ("rows", T.LongType()), (MONTH, T.StringType()),
):
    STATE = STATE.add(_name, _kind)


@dataclass(frozen=True)
class Medallion:
    """Folders and settings of one installation."""

    landing: str
    warehouse: str
    strict_scale: bool = False
    mode: str = "exact"
    # A date column of the provider files: files are snapshots, and the newest row of each provider counts.
    latest_by: str | None = None
    csv_options: dict = field(default_factory=dict)

    @property
    def bronze(self) -> Bronze:
        return Bronze(f"{self.warehouse}/bronze", default_routes(self.strict_scale), self.csv_options)

    @property
    def ledger(self) -> Ledger:
        """Silver and gold, which a run changes together."""
        return Ledger(self.warehouse)

    @property
    def fact_rows(self) -> T.StructType:
        return T.StructType([*fact_schema(self.strict_scale).fields, T.StructField(MONTH, T.StringType())])


ALL_CHECKS = (silver.PROVIDER_CHECKS, silver.WORK_DATE_CHECKS, silver.FACT_CHECKS)


def checked_relations(
    providers: DataFrame, staffing: DataFrame, run_ts: Column | None = None, only: Sequence[CheckSet] = ALL_CHECKS
) -> list[tuple[DataFrame, CheckSet, DataFrame | None]]:
    """The three relations under test, their checks, and where to look for NULLs if not in the whole relation.

    The relations are bags: the checks remove duplicates themselves, where they have to. Only those of `only` are built.
    """
    made = []
    for checks in only:
        if checks is silver.PROVIDER_CHECKS:
            made.append((providers.select(*silver.PROVIDER_COLUMNS.values()), checks, None))
        elif checks is silver.WORK_DATE_CHECKS:
            # The calendar is tiny once made: it is kept, or every check would parse the dates of all rows again.
            calendar = settled(silver.work_date_stage(staffing))
            made.append((silver.stamped(calendar, run_ts), checks, None))
        else:
            suspects = silver.stamped(silver.incomplete_facts(staffing), run_ts)
            made.append((silver.stamped(silver.fact_bag(staffing), run_ts), checks, suspects))
    return made


def validation_results(
    providers: DataFrame, staffing: DataFrame, run_ts: Column | None = None, only: Sequence[CheckSet] = ALL_CHECKS
) -> DataFrame:
    """All check results of the three relations, or of those in `only`, with the relation they belong to."""
    parts = [
        check_results(df, checks, True, suspects).select(F.lit(checks.name).alias("relation"), "*")
        for df, checks, suspects in checked_relations(providers, staffing, run_ts, only)
    ]
    return reduce(DataFrame.unionByName, parts)


def gate(providers: DataFrame, staffing: DataFrame, run_ts: Column | None = None) -> DataFrame:
    return gate_status(validation_results(providers, staffing, run_ts))


def run_checks(providers: DataFrame, staffing: DataFrame, only: Sequence[CheckSet] = ALL_CHECKS) -> None:
    """Run the validations side by side and raise one error with the findings of all of them."""
    outcomes = _in_parallel(
        staffing.sparkSession,
        [lambda relation=relation: _finding(*relation) for relation in checked_relations(providers, staffing, only=only)],
    )
    findings = [text for text in outcomes if text]
    if findings:
        raise ValidationError("\n".join(findings))


def _finding(df: DataFrame, checks: CheckSet, suspects: DataFrame | None) -> str | None:
    try:
        validate(df, checks, True, suspects)
    except ValidationError as error:
        return f"{checks.name}: {error}"
    return None


def _in_parallel(spark: SparkSession, jobs: list) -> list:
    """Independent jobs submitted together; the first failure is raised after all have ended."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [future.result() for future in futures]


def month_of(work_date_id: Column) -> Column:
    """The month of a date id, and NULL, the default partition, for an empty one."""
    return F.nullif(F.substring(F.trim(work_date_id), 1, 6), F.lit(""))


def touched_months(staffing: DataFrame) -> list[str | None] | None:
    """The months in `staffing`, None among them for rows without a date; no list at all if there are too many."""
    months = staffing.select(month_of(F.col("WorkDate")).alias("m")).distinct().limit(MAX_TOUCHED_MONTHS + 1).collect()
    return [row["m"] for row in months] if len(months) <= MAX_TOUCHED_MONTHS else None


def rows_of_months(staffing: DataFrame, months: Sequence[str | None]) -> DataFrame:
    """All rows of these months; the range from the first to the last of them reaches the scan as a filter."""
    date, named = F.col("WorkDate"), [m for m in months if m is not None]
    wanted = F.lit(False)
    if named:
        within = (date >= min(named)) & (date <= max(named) + "\U0010ffff")
        wanted = (within | date.startswith(" ")) & month_of(date).isin(named)
    if len(named) < len(months):
        wanted = wanted | date.isNull() | (F.trim(date) == "")
    return staffing.where(wanted)


def pending_files(spark: SparkSession, config: Medallion) -> DataFrame:
    """Names of ingested files that no run has merged yet, those of a run that a failed check stopped among them."""
    merged = config.ledger.read(spark, MERGED_TABLE, MERGED)
    return config.bronze.manifest(spark).select("filename").distinct().join(merged, "filename", "left_anti")


def merge_fact(
    commit: Commit,
    config: Medallion,
    staffing: DataFrame,
    run_ts: Column | None = None,
    months: Sequence[str | None] | None = None,
) -> Sequence[str | None] | None:
    """Merge into the fact, reading and rewriting only the months that occur in `staffing`: `months`, where known.

    The months are returned; None if there are too many to tell.
    """
    schema = fact_schema(config.strict_scale)
    months = touched_months(staffing) if months is None else months
    target = commit.read(FACT_TABLE, config.fact_rows, MONTH, months).select(*schema.names)
    options = {"strict_scale": config.strict_scale}
    first = target.isEmpty()
    if first and months is not None:
        # The wide rows are gathered by month already: the long ones, four times as many, are written where they are made.
        merged = silver.first_fact(staffing, target, run_ts, part=(MONTH, month_of), **options)
        sized = merged.withColumn(MONTH, month_of(F.col("workdateid")))
    else:
        build = silver.first_fact if first else silver.build_fact
        merged = build(staffing, target, run_ts, **options).withColumn(MONTH, month_of(F.col("workdateid")))
        # Rebalancing gathers each month in few files and splits a month that is too large for one task.
        sized = merged.hint("rebalance", MONTH)
    commit.replace_partitions(ordered_within_files(sized, MONTH, "workdateid"), FACT_TABLE, MONTH)
    return months


def merge_silver(
    commit: Commit,
    config: Medallion,
    providers: DataFrame,
    staffing: DataFrame,
    run_ts: Column | None = None,
    months: Sequence[str | None] | None = None,
) -> Sequence[str | None] | None:
    """The four merges side by side; they write different tables. `months`: those in `staffing`, where known; returned."""

    def dimension(table: str, schema: T.StructType, build) -> None:
        commit.replace(build(commit.read(table, schema)), table)

    done = _in_parallel(
        commit.spark,
        [
            lambda: dimension(
                PROVIDER_DIM_TABLE, PROVIDER_DIM, lambda old: silver.build_provider_dim(providers, old, run_ts)
            ),
            lambda: dimension(TYPE_TABLE, STAFFING_TYPE_DIM, lambda old: silver.build_staffing_type_dim(old, run_ts)),
            lambda: dimension(DATE_TABLE, WORK_DATE_DIM, lambda old: silver.build_work_date_dim(staffing, old, run_ts)),
            lambda: merge_fact(commit, config, staffing, run_ts, months),
        ],
    )
    return done[-1]


def silver_tables(spark: SparkSession, config: Medallion) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Fact, providers, staffing types and work dates as stored."""
    ledger = config.ledger
    state = ledger.state(spark)
    return (
        ledger.rows(spark, state, FACT_TABLE, config.fact_rows).drop(MONTH),
        ledger.rows(spark, state, PROVIDER_DIM_TABLE, PROVIDER_DIM),
        ledger.rows(spark, state, TYPE_TABLE, STAFFING_TYPE_DIM),
        ledger.rows(spark, state, DATE_TABLE, WORK_DATE_DIM),
    )


def refresh_state(commit: Commit, config: Medallion, months: Sequence[str | None] | None) -> None:
    """Bring the sums by provider, type and month up to date: by the difference of the touched months' old and new rows."""

    def rows(old: bool) -> DataFrame:
        fact = commit.read(FACT_TABLE, config.fact_rows, MONTH, months, old=old)
        return gold.monthly_sums(fact, commit.read(DATE_TABLE, WORK_DATE_DIM, old=old))

    if months is None:
        fresh = maintained.state(rows(False), STATE_KEYS, gold.MONTHLY_VALUES)
    else:
        change = maintained.delta(rows(True), rows(False), STATE_KEYS, gold.MONTHLY_VALUES)
        stored = commit.read(STATE_TABLE, STATE, MONTH, months)
        fresh = maintained.applied(stored, change, STATE_KEYS, gold.MONTHLY_VALUES)
    fresh = fresh.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STATE.fields])
    commit.replace_partitions(fresh.hint("rebalance", MONTH), STATE_TABLE, MONTH, emptied=months)


def _changed(commit: Commit, table: str, schema: T.StructType, columns: Sequence[str]) -> bool:
    """Whether a dimension differs from what it was, in what gold shows of it."""
    old, new = (commit.read(table, schema, old=o).select(*columns) for o in (True, False))
    return not (old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty())


def refresh_gold(
    commit: Commit, config: Medallion, run_ts: Column | None = None, months: Sequence[str | None] | None = None
) -> None:
    """The aggregate as a maintained view. Only the touched months of the fact are read, and only their rows of gold are
    written anew, unless a provider or type has changed: then all of gold is made from the state, without the fact.

    Decimal mode averages rounded quotients, which no state can carry on: there the table is made from the whole fact.
    """
    dimensions = (commit.read(PROVIDER_DIM_TABLE, PROVIDER_DIM), commit.read(TYPE_TABLE, STAFFING_TYPE_DIM))
    if config.mode != "exact":
        fact = commit.read(FACT_TABLE, config.fact_rows).drop(MONTH)
        dates = commit.read(DATE_TABLE, WORK_DATE_DIM)
        rows = gold.build_utilization(fact, *dimensions, dates, run_ts, mode=config.mode, strict_scale=config.strict_scale)
        commit.replace(rows, GOLD_TABLE)
        commit.after.pop(STATE_TABLE, None)
        return
    if STATE_TABLE not in commit.before or WHOLE in commit.before.get(GOLD_TABLE, {}):
        months = None
    refresh_state(commit, config, months)
    shown = [*gold.PROVIDER_ATTRIBUTES, "numberofbed"]
    if months is not None and (
        _changed(commit, PROVIDER_DIM_TABLE, PROVIDER_DIM, shown)
        or _changed(commit, TYPE_TABLE, STAFFING_TYPE_DIM, ["staffingtypeid", *gold.TYPE_ATTRIBUTES])
    ):
        months = None
    sums = commit.read(STATE_TABLE, STATE, MONTH, months).select(
        *STATE_KEYS,
        maintained.total("hours").alias("hours"),
        maintained.total("census").alias("census"),
        F.col(maintained.counted("census")).alias("days"),
    )
    # Narrow rows are spread by provider, once for the join and the grouping. A merge join leaves them in order: a provider's
    # texts then lie together in the shuffle by month that follows, which packs them away.
    sums, dimensions = spread(sums, silver.PROVIDER_KEY), (dimensions[0].hint("merge"), dimensions[1])
    rows = gold.shaped_gold(gold.from_monthly(sums, *dimensions, [MONTH]), run_ts, config.strict_scale, [MONTH])
    commit.replace_partitions(rows.hint("rebalance", MONTH), GOLD_TABLE, MONTH, emptied=months)


def read_gold(spark: SparkSession, config: Medallion) -> DataFrame:
    return config.ledger.read(spark, GOLD_TABLE, gold_schema(config.strict_scale))


def record_merged(commit: Commit, pending: DataFrame) -> None:
    """Remember which files are merged; from time to time in one table again."""
    if len(commit.after.get(MERGED_TABLE, {}).get(WHOLE, [])) < MERGED_VERSIONS:
        commit.append(pending.repartition(1), MERGED_TABLE)
    else:
        commit.replace(commit.read(MERGED_TABLE, MERGED).unionByName(pending), MERGED_TABLE)


STAFFING_RULES = ["PROVNUM", "WorkDate", "MDScensus", *silver.FACT_MEASURES.values()]
QUARANTINED = T.StructType([*[T.StructField(c, T.StringType()) for c in STAFFING_RULES], T.StructField(BROKEN, T.LongType())])


def set_aside(commit: Commit, staffing: DataFrame) -> DataFrame:
    """The staffing rows without NULLs, staged in one scan of bronze; the others go to the quarantine with their rules' bits.

    A row that is in quarantine already, from an earlier run over the same files, is not put there twice.
    """
    rows = staffing.select(*STAFFING_RULES)
    found = staged(rows, null_rules(STAFFING_RULES), scratch_path(commit.spark, "staged"))
    if any(found.violations.values()):
        kept = commit.read(QUARANTINE_TABLE, QUARANTINED)
        new = found.quarantined.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in QUARANTINED.fields])
        commit.replace(kept.unionByName(new).distinct(), QUARANTINE_TABLE)
    return found.clean


def read_quarantine(spark: SparkSession, config: Medallion) -> DataFrame:
    """Staffing rows that were set aside, as text, with the bits of the columns of `STAFFING_RULES` that are NULL."""
    return config.ledger.read(spark, QUARANTINE_TABLE, QUARANTINED)


def run_medallion(
    spark: SparkSession,
    config: Medallion,
    run_ts: Column | None = None,
    *,
    on_empty: str = "raise",
    scope: str = "all",
    on_fault: str = "stop",
) -> DataFrame:
    """Landing folder to gold. A failed check stops the run before any silver table is touched; silver, gold and the list of
    merged files change in one commit, so whatever stops a run, readers see all of it or nothing.

    Scope "all" checks and merges all of bronze. With "months" a run costs what its files cost: only the months that
    occur in files not merged yet are checked and merged, each with all of its rows. Other months keep their stamps, in gold
    too;
    their values are those of a full run too, unless several bronze rows share a key of the fact: a full run repeats
    the update of every month, which sets such rows to the greatest of them.

    With `on_fault="quarantine"` staffing rows with a NULL don't stop the run: they are set aside, counted while the others
    are staged, and all that follows reads the staged rows. Other faults stop the run as ever.
    """
    if scope not in ("months", "all"):
        raise ValueError(f"unknown scope: {scope}")
    if on_fault not in ("stop", "quarantine"):
        raise ValueError(f"unknown answer to faults: {on_fault}")
    ingest_folder(spark, config.bronze, config.landing, load_time=run_ts, on_empty=on_empty)
    providers = config.bronze.table(spark, PROVIDER_TABLE)
    staffing = config.bronze.table(spark, STAFFING_TABLE)
    if config.latest_by is not None:
        providers = silver.latest_providers(providers, config.latest_by)
    pending, months, checks = settled(pending_files(spark, config)), None, ALL_CHECKS
    if scope == "months":
        names = pending.withColumnRenamed("filename", "source_file")
        months = touched_months(staffing.join(names, "source_file", "left_semi"))
        if not months and months is not None and not staffing.isEmpty():
            checks = (silver.PROVIDER_CHECKS,)
        if months is not None:
            staffing = rows_of_months(staffing, months)
    commit = config.ledger.begin(spark)
    try:
        if on_fault == "quarantine":
            staffing = set_aside(commit, staffing)
            # Where a month has lost all its rows, nothing of it is merged.
            checks = checks if not staffing.isEmpty() else (silver.PROVIDER_CHECKS,)
        with freed_shuffles(spark):
            run_checks(providers, staffing, checks)
            months = merge_silver(commit, config, providers, staffing, run_ts, months)
            record_merged(commit, pending)
            refresh_gold(commit, config, run_ts, months)
        commit.commit()
    except BaseException:
        commit.abandon()
        raise
    return read_gold(spark, config)
