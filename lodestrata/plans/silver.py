"""Silver: stage relations from bronze, and the dimensions and the fact they are merged into."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import compact_date, padded_month_name
from ..operators.quality import CheckSet
from ..operators.reshape import distinct_long, literal_rows, wide_to_long
from ..operators.skew import hot_key_hashes, is_hot, spread
from ..operators.upsert import any_null, shaped, upsert
from ..schemas import PROVIDER_DIM, STAFFING_TYPE_DIM, WORK_DATE_DIM, fact_schema

# Dimension column from bronze column.
PROVIDER_COLUMNS = {
    "ccn": "CMS_Certification_Number_CCN",
    "providername": "Provider_Name",
    "provideraddress": "Provider_Address",
    "city": "City_Town",
    "state": "State",
    "zipcode": "ZIP_Code",
    "numberofbed": "Number_of_Certified_Beds",
    "latitude": "Latitude",
    "longitude": "Longitude",
}

# The four staffing types, and the hours column that feeds each of them.
STAFFING_TYPES = (
    (1, "Full Time Registered Nurse", "Full Time"),
    (2, "Contract Registered Nurse", "Contractor"),
    (3, "Full Time CNA", "Full Time"),
    (4, "Contract CNA", "Contractor"),
)
FACT_MEASURES = {"1": "Hrs_RNDON_emp", "2": "Hrs_RNDON_ctr", "3": "Hrs_CNA_emp", "4": "Hrs_CNA_ctr"}

PROVIDER_KEY = ["ccn"]
STAFFING_TYPE_KEY = ["staffingtypeid"]
WORK_DATE_KEY = ["workdateid"]
FACT_KEY = ["ccn", "workdateid", "staffingtypeid"]

PROVIDER_CHECKS = CheckSet(
    "bronze.providerinfo",
    required=[c.lower() for c in PROVIDER_COLUMNS.values()],
    unique=[PROVIDER_COLUMNS["ccn"].lower()],
)
WORK_DATE_CHECKS = CheckSet("bronze.dailynursestaffing", required=WORK_DATE_DIM.names, unique=WORK_DATE_KEY)
FACT_CHECKS = CheckSet("unioned dailynursestaffing", required=fact_schema().names)


def stamped(df: DataFrame, run_ts: Column | None, column: str = "updated_at") -> DataFrame:
    """The audit stamp: the same instant on every row of a run."""
    return df.withColumn(column, (F.current_timestamp() if run_ts is None else run_ts).cast("timestamp"))


# Stage relations ------------------------------------------------------------------------------------------------------


def provider_stage(bronze: DataFrame, columns: Mapping[str, str] = PROVIDER_COLUMNS) -> DataFrame:
    """The distinct provider rows: nine of the bronze columns, renamed and typed as the dimension has them."""
    kinds = {f.name: f.dataType for f in PROVIDER_DIM.fields}
    return bronze.select(*[F.col(source).cast(kinds[name]).alias(name) for name, source in columns.items()]).distinct()


def work_date_stage(staffing: DataFrame, column: str = "WorkDate") -> DataFrame:
    """The distinct calendar rows. Each distinct text is parsed once; trimmed texts of equal dates are equal."""
    texts = staffing.select(F.trim(F.col(column)).alias("text")).distinct()
    date = compact_date(F.col("text"))
    return texts.select(
        F.col("text").cast("int").alias("workdateid"),
        date.alias("workdate"),
        F.month(date).alias("month"),
        padded_month_name(date).alias("monthname"),
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
    )


FACT_IDS = ["ccn", "workdateid", "numofpatient"]
FACT_DAY = ["ccn", "workdateid"]


def staffing_days(staffing: DataFrame, measures: Mapping[str, str] = FACT_MEASURES) -> DataFrame:
    """The fact's ids and one hours column per staffing type, row by row as bronze has them."""
    return staffing.select(
        F.col("PROVNUM").alias("ccn"),
        F.col("WorkDate").alias("workdateid"),
        F.col("MDScensus").alias("numofpatient"),
        *[F.col(column).alias(f"hours_{label}") for label, column in measures.items()],
    )


def _hours(measures: Mapping[str, str]) -> dict[str, str]:
    return {label: f"hours_{label}" for label in measures}


def fact_bag(staffing: DataFrame, measures: Mapping[str, str] = FACT_MEASURES) -> DataFrame:
    """Every hours value as a row of its own, repeats included."""
    days = staffing_days(staffing, measures)
    return wide_to_long(days, FACT_IDS, _hours(measures), "staffingtypeid", "workhours")


def incomplete_facts(staffing: DataFrame, measures: Mapping[str, str] = FACT_MEASURES) -> DataFrame:
    """The rows of `fact_bag` with a NULL, found by a filter on bronze that skips files without any."""
    sources = ["PROVNUM", "WorkDate", "MDScensus", *measures.values()]
    return fact_bag(staffing.where(any_null(sources)), measures)


def hot_days(days: DataFrame) -> list[int]:
    """Provider days that hold a large share of all rows, missing keys included."""
    return hot_key_hashes(days, FACT_DAY)


def fact_stage(
    staffing: DataFrame,
    measures: Mapping[str, str] = FACT_MEASURES,
    hot: Sequence[int] | None = None,
    keys: Sequence[str] = FACT_DAY,
    part: tuple[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """The distinct fact rows, still as text and source decimals, spread by `keys`: by provider and day, or by provider.

    Spread by provider, what follows by provider needs no further shuffle. Hot keys are looked up unless given.
    `part` names a column that is made of the date id; the rows carry it and lie as they are written by it.
    """
    days, ids, name = staffing_days(staffing, measures), FACT_IDS, None
    if part is not None:
        name, value = part
        days, ids, keys = days.withColumn(name, value(F.col("workdateid"))), [*ids, name], [name, *keys]
    hot = hot_key_hashes(days, keys) if hot is None else hot
    return distinct_long(days, ids, _hours(measures), "staffingtypeid", "workhours", keys, hot, name)


def whole_census() -> Column:
    """Census as INT; text that is no whole number stops the job."""
    census = F.col("numofpatient").try_cast("int")
    bad = F.col("numofpatient").isNotNull() & census.isNull()
    stop = F.raise_error(F.concat(F.lit("census is no whole number: "), F.col("numofpatient"))).cast("int")
    return F.when(bad, stop).otherwise(census)


def typed_fact(stage: DataFrame, strict_scale: bool = False) -> DataFrame:
    """Census as INT and hours as the fact's decimal, half up."""
    hours = fact_schema(strict_scale)["workhours"].dataType
    return stage.select(
        "ccn",
        "workdateid",
        whole_census().alias("numofpatient"),
        "staffingtypeid",
        F.col("workhours").cast(hours).alias("workhours"),
    )


def staffing_type_stage(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, STAFFING_TYPES, T.StructType(STAFFING_TYPE_DIM.fields[:3]))


# Merges ---------------------------------------------------------------------------------------------------------------


def build_provider_dim(bronze: DataFrame, target: DataFrame, run_ts: Column | None = None, **policy) -> DataFrame:
    return upsert(target, provider_stage(bronze), PROVIDER_KEY, stamp=run_ts, **policy)


def latest_providers(bronze: DataFrame, latest_by: str = "Processing_Date") -> DataFrame:
    """The dimension's columns of the newest snapshot of each provider; rows without a provider number all stay.

    Of several rows with the newest date the greatest stays. Only these columns and the date are shuffled.
    """
    key = PROVIDER_COLUMNS["ccn"]
    columns = [c for c in PROVIDER_COLUMNS.values() if c in bronze.columns]
    others = [c for c in columns if c not in (key, latest_by)]
    newest = (
        bronze.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(latest_by, *others)).alias("newest"))
        .select(key, "newest.*")
    )
    return newest.select(*columns).unionByName(bronze.where(F.col(key).isNull()).select(*columns))


def build_staffing_type_dim(target: DataFrame, run_ts: Column | None = None) -> DataFrame:
    return upsert(target, staffing_type_stage(target.sparkSession), STAFFING_TYPE_KEY, stamp=run_ts)


def build_work_date_dim(staffing: DataFrame, target: DataFrame, run_ts: Column | None = None) -> DataFrame:
    return upsert(target, work_date_stage(staffing), WORK_DATE_KEY, stamp=run_ts)


def _by_label(measures: Mapping[str, str], column: str) -> Column:
    """Of the columns `<column>_<label>`, the one that belongs to the row's staffing type."""
    result = F.lit(None)
    for label in measures:
        result = F.when(F.col("staffingtypeid") == label, F.col(f"{column}_{label}")).otherwise(result)
    return result


@dataclass(frozen=True)
class Days:
    """Stage rows by where they are merged: spread by provider and day, of hot provider days, or without a key."""

    cold: DataFrame
    frequent: DataFrame | None
    keyless: DataFrame
    hot: Sequence[int]

    @classmethod
    def split(cls, days: DataFrame, hot: Sequence[int]) -> Days:
        keyed = days.where(~any_null(FACT_DAY))
        cold = keyed.where(~is_hot(FACT_DAY, hot)) if hot else keyed
        frequent = keyed.where(is_hot(FACT_DAY, hot)) if hot else None
        return cls(spread(cold, FACT_DAY), frequent, days.where(any_null(FACT_DAY)), hot)

    def beside(self, keyed: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        """Stage rows with the rows of `keyed` that may share their provider day, one pair per way to merge."""
        if self.frequent is None:
            return [(self.cold, keyed)]
        frequent = is_hot(FACT_DAY, self.hot)
        return [(self.cold, keyed.where(~frequent)), (self.frequent, keyed.where(frequent))]


def updated_fact(
    days: Days, target: DataFrame, measures: Mapping[str, str], run_ts: Column | None, strict_scale: bool
) -> DataFrame:
    """The target with the values of the last stage row per key: greatest census, then greatest hours."""
    hours = fact_schema(strict_scale)["workhours"].dataType
    last = {
        f"best_{label}": F.max(
            F.struct(whole_census().alias("numofpatient"), F.col(f"hours_{label}").cast(hours).alias("workhours"))
        )
        for label in measures
    }
    matched = F.col("best").isNotNull()
    now = F.current_timestamp() if run_ts is None else run_ts
    values = {
        "numofpatient": F.when(matched, F.col("best.numofpatient")).otherwise(F.col("numofpatient")),
        "workhours": F.when(matched, F.col("best.workhours")).otherwise(F.col("workhours")),
        "updated_at": F.when(matched, now.cast("timestamp")).otherwise(F.col("updated_at")),
    }
    parts = [target.where(any_null(FACT_DAY))]
    for stage, known in days.beside(target.where(~any_null(FACT_DAY))):
        best = stage.groupBy(*FACT_DAY).agg(*[column.alias(name) for name, column in last.items()])
        # One row per hot provider day, and those are few.
        best = F.broadcast(best) if stage is days.frequent else best
        joined = known.join(best, FACT_DAY, "left").withColumn("best", _by_label(measures, "best"))
        parts.append(joined.select(*[values.get(c, F.col(c)).alias(c) for c in target.columns]))
    return reduce(DataFrame.unionByName, parts)


def new_fact_rows(days: Days, target: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """The distinct stage rows whose key the target lacks.

    The wide rows learn, per staffing type, whether the target knows it, and only the other types become rows.
    """
    flags = {f"known_{label}": F.max(F.col("staffingtypeid") == label) for label in measures}
    parts = [wide_to_long(days.keyless, FACT_IDS, _hours(measures), "staffingtypeid", "workhours").distinct()]
    for stage, known in days.beside(target.where(~any_null(FACT_DAY))):
        types = known.groupBy(*FACT_DAY).agg(*[column.alias(name) for name, column in flags.items()])
        types = F.broadcast(types) if stage is days.frequent else types
        joined = stage.join(types, FACT_DAY, "left")
        rows = wide_to_long(joined, [*FACT_IDS, *flags], _hours(measures), "staffingtypeid", "workhours")
        new = rows.where(~F.coalesce(_by_label(measures, "known"), F.lit(False))).drop(*flags)
        parts.append(new.distinct())
    return reduce(DataFrame.unionByName, parts)


def first_fact(
    staffing: DataFrame,
    target: DataFrame,
    run_ts: Column | None = None,
    *,
    strict_scale: bool = False,
    part: tuple[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """What `build_fact` makes of a target without rows: the stage alone, with nothing to aggregate or join for an update.

    With `part`, a column that is made of the date id, the rows lie as they are written by it, those of a provider together.
    """
    stage = fact_stage(staffing) if part is None else fact_stage(staffing, keys=PROVIDER_KEY, part=part)
    return shaped(typed_fact(stage, strict_scale), target, run_ts)


def build_fact(
    staffing: DataFrame,
    target: DataFrame,
    run_ts: Column | None = None,
    *,
    measures: Mapping[str, str] = FACT_MEASURES,
    strict_scale: bool = False,
    insert_duplicates: str = "keep",
) -> DataFrame:
    """The fact after update and insert: what `upsert` makes of the fact stage, without ever shuffling the long rows.

    Both halves work on the wide rows, spread once by provider and day: the update takes the last values of all types
    per provider day, the insert makes long only what is new and removes copies where they lie. Provider days with a
    large share of the rows, looked for in one scan per side, are combined in place and meet in broadcast joins.
    """
    if insert_duplicates != "keep":
        stage = typed_fact(fact_stage(staffing, measures), strict_scale)
        return upsert(target, stage, FACT_KEY, stamp=run_ts, insert_duplicates=insert_duplicates)
    rows = staffing_days(staffing, measures)
    days = Days.split(rows, list(dict.fromkeys(hot_days(rows) + hot_days(target))))
    updated = updated_fact(days, target, measures, run_ts, strict_scale)
    new = typed_fact(new_fact_rows(days, target, measures), strict_scale)
    return updated.unionByName(shaped(new, target, run_ts))
