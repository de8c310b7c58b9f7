import csv as stdlib_csv
import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata.functions.numbers import mean_percent_half_up
from lodestrata.operators.quality import ValidationError
from lodestrata.operators.quarantine import null_rules, staged
from lodestrata.plans import gold, silver
from lodestrata.plans.medallion import (
    FACT_TABLE,
    GOLD_TABLE,
    STAFFING_RULES,
    STATE_TABLE,
    Medallion,
    merge_fact,
    read_gold,
    read_quarantine,
    refresh_gold,
    run_medallion,
    silver_tables,
)
from lodestrata.schemas import (
    PROVIDER_DIM,
    daily_nurse_staffing_schema,
    fact_schema,
    gold_schema,
    provider_info_schema,
)
from lodestrata.sources.ingest import NoNewFilesError
from lodestrata.sources.tables import read_table, replace_partitions, replace_table

FIRST, SECOND = datetime.datetime(2026, 1, 1), datetime.datetime(2026, 2, 1)


def staffing(spark, *content):
    """Rows of provider, date, census and the four hours that the fact uses."""
    columns = "PROVNUM string, WorkDate string, MDScensus string, " + ", ".join(
        f"{c} decimal(18,2)" for c in silver.FACT_MEASURES.values()
    )
    return spark.createDataFrame([(*r[:3], *[None if h is None else Decimal(h) for h in r[3:]]) for r in content], columns)


# Layouts --------------------------------------------------------------------------------------------------------------


def test_layouts_have_the_declared_shape():
    kinds = [f.dataType.simpleString() for f in provider_info_schema(strict_scale=True).fields]
    assert len(kinds) == 103
    counts = {k: kinds.count(k) for k in set(kinds)}
    assert counts == {"string": 22, "int": 45, "decimal(18,0)": 28, "smallint": 3, "date": 5}
    kinds = [f.dataType.simpleString() for f in daily_nurse_staffing_schema().fields]
    assert len(kinds) == 33 and kinds.count("string") == 9 and kinds.count("decimal(18,2)") == 24
    assert len(gold_schema()) == 14 and len(fact_schema()) == 6 and len(PROVIDER_DIM) == 10


# Silver ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("20240229", (20240229, datetime.date(2024, 2, 29), 2, "February ", 2024, 1)),
        (" 20241231", (20241231, datetime.date(2024, 12, 31), 12, "December ", 2024, 4)),
        ("20240501", (20240501, datetime.date(2024, 5, 1), 5, "May      ", 2024, 2)),
    ],
)
def test_calendar_row(spark, text, expected):
    df = spark.createDataFrame([(text,), (text.strip(),), (text + " ",)], "WorkDate string")
    assert [tuple(r) for r in silver.work_date_stage(df).collect()] == [expected]


@pytest.mark.parametrize("text", ["2024-01-01", "20240230", "soon", ""])
def test_unreadable_date_stops_the_job(spark, text):
    with pytest.raises(Exception, match="not a yyyyMMdd date|CAST_INVALID_INPUT"):
        silver.work_date_stage(spark.createDataFrame([(text,)], "WorkDate string")).collect()


def test_fact_stage_removes_copies_but_keeps_equal_hours_of_two_types(spark, rows):
    df = staffing(spark, ("p", "20240101", "80", 8, 8, 1, None), ("p", "20240101", "80", 8, 8, 2, None))
    assert [r[3:] for r in rows(silver.fact_stage(df))] == [
        ("1", Decimal("8.00")), ("2", Decimal("8.00")), ("3", Decimal("1.00")), ("3", Decimal("2.00")), ("4", None)
    ]


def test_fact_merge_policies(spark, rows):
    days = [("p", "20240101", "80", 8, 1, 1, 1), ("p", "20240101", "80", 9, 1, 1, 1), ("p", "20240101", "080", 9, 1, 1, 1)]
    empty = spark.createDataFrame([], fact_schema())

    def first_type(**options):
        merged = silver.build_fact(staffing(spark, *days), empty, F.lit(FIRST), **options)
        return [r["workhours"] for r in merged.where("staffingtypeid = '1'").sort("workhours").collect()]

    # Copies are told apart as text, before the census becomes a number.
    assert first_type() == [Decimal(8), Decimal(9), Decimal(9)]
    assert first_type(insert_duplicates="one") == [Decimal(9)]
    with pytest.raises(Exception, match="several new rows for key p, 20240101"):
        first_type(insert_duplicates="error")


@pytest.mark.parametrize("census", ["80.5", "many", ""])
def test_census_must_be_a_whole_number(spark, census):
    df = silver.fact_stage(staffing(spark, ("p", "20240101", census, 1, 1, 1, 1)))
    with pytest.raises(Exception, match="census is no whole number"):
        silver.typed_fact(df).collect()


def test_hours_round_half_up_at_scale_zero(spark, rows):
    df = staffing(spark, ("p", "20240101", "8", "2.5", "-2.5", "2.49", None))
    hours = {r["staffingtypeid"]: r["workhours"] for r in silver.typed_fact(silver.fact_stage(df), True).collect()}
    assert hours == {"1": Decimal(3), "2": Decimal(-3), "3": Decimal(2), "4": None}


def test_latest_provider_snapshot(spark, rows):
    df = spark.createDataFrame(
        [("a", "old", datetime.date(2024, 1, 1)), ("a", "new", datetime.date(2024, 2, 1)), (None, "x", None)],
        "CMS_Certification_Number_CCN string, Provider_Name string, Processing_Date date",
    )
    assert rows(silver.latest_providers(df), "Provider_Name") == [("new",), ("x",)]


# Gold -----------------------------------------------------------------------------------------------------------------


def star(spark, staffing_rows, providers):
    days = staffing(spark, *staffing_rows)
    dim = spark.createDataFrame(
        [(ccn, name, "addr", "city", "ST", 1, beds, Decimal("1.5"), Decimal("-2.5"), FIRST) for ccn, name, beds in providers],
        PROVIDER_DIM,
    )
    return (
        silver.typed_fact(silver.fact_stage(days)),
        dim,
        silver.staffing_type_stage(spark),
        silver.work_date_stage(days),
    )


def by_title(df):
    return {(r["providername"], r["title"]): (r["totalworkhour"], r["bedutilizationrate"]) for r in df.collect()}


@pytest.mark.parametrize("mode", ["exact", "decimal"])
def test_gold_of_a_small_star(spark, mode):
    days = [
        ("p", "20240101", "80", 8, 1, 2, None),
        ("p", "20240115", "70", 7, 1, 2, None),
        ("p", "20240120", None, 1, 1, 2, None),
        ("zero", "20240101", "5", 1, 1, 1, 1),
        ("null", "20240101", "5", 1, 1, 1, 1),
        ("absent", "20240101", "5", 1, 1, 1, 1),
    ]
    tables = star(spark, days, [("p", "P", 90), ("zero", "Z", 0), ("null", "N", None)])
    found = by_title(gold.utilization(*tables, mode=mode))
    nurse = "Full Time Registered Nurse"
    assert found[("P", nurse)] == (Decimal("16.00"), Decimal("83.33"))
    assert found[("P", "Contract CNA")] == (None, Decimal("83.33"))
    assert found[("Z", nurse)] == (Decimal("1.00"), None)
    assert found[("N", nurse)] == (Decimal("1.00"), None)
    assert len(found) == 12


def test_gold_groups_by_month_and_year(spark):
    days = [("p", d, "9", 1, 1, 1, 1) for d in ("20240131", "20240201", "20230101")]
    found = gold.utilization(*star(spark, days, [("p", "P", 9)]))
    keys = {(r["year"], r["month"], r["monthname"]) for r in found.collect()}
    assert keys == {(2024, 1, "January  "), (2024, 2, "February "), (2023, 1, "January  ")}


@pytest.mark.parametrize("mode", ["exact", "decimal"])
def test_double_provider_multiplies_the_fact(spark, mode):
    """Two rows of one provider that differ only in beds: hours count twice, the rate averages both."""
    tables = star(spark, [("p", "20240101", "30", 8, 1, 1, 1)], [("p", "P", 100), ("p", "P", 50)])
    found = by_title(gold.utilization(*tables, mode=mode))
    assert found[("P", "Full Time CNA")] == (Decimal("2.00"), Decimal("45.00"))


def test_gold_column_order_and_types(spark):
    tables = star(spark, [("p", "20240101", "30", 8, 1, 1, 1)], [("p", "P", 100)])
    for strict in (False, True):
        built = gold.build_utilization(*tables, F.lit(FIRST), strict_scale=strict)
        assert [(f.name, f.dataType) for f in built.schema.fields] == [
            (f.name, f.dataType) for f in gold_schema(strict).fields
        ]
    assert {r["updated_at"] for r in built.collect()} == {FIRST}


@pytest.mark.parametrize(
    ("total", "count", "beds", "expected"),
    [(1, 1, 8, "12.50"), (1, 3, 8, "4.17"), (1, 1, 16, "6.25"), (1, 1, 32, "3.13"), (-1, 1, 32, "-3.13"),
     (0, 1, 5, "0.00"), (1, 0, 5, None), (3 * 10**13, 10**12, 40, "75.00")],
)
def test_mean_percent_rounds_half_away_from_zero(spark, total, count, beds, expected):
    column = mean_percent_half_up(F.lit(total).cast("bigint"), F.lit(count).cast("bigint"), F.lit(beds))
    found = spark.range(1).select(column).first()[0]
    assert found == (None if expected is None else Decimal(expected))


def test_gold_sums_before_it_joins_the_providers(spark, tmp_path):
    tables = star(spark, [("p", "20240101", "30", 8, 1, 1, 1)], [("p", "P", 100)])
    plan = gold.utilization(*tables)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    provider_join = next(i for i, line in enumerate(lines) if "Join" in line and "ccn" in line)
    assert "Aggregate" in "\n".join(lines[provider_join:])


# Tables ---------------------------------------------------------------------------------------------------------------


def test_table_can_be_replaced_by_a_query_on_itself(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), PROVIDER_DIM
    assert read_table(spark, path, schema).count() == 0
    for n in range(1, 5):
        old = read_table(spark, path, schema)
        new = spark.createDataFrame([(str(n), *[None] * 9)], schema)
        replace_table(old.unionByName(new), path)
        assert read_table(spark, path, schema).count() == n
    assert len(list((tmp_path / "t").iterdir())) == 2


def test_unfinished_snapshot_is_ignored(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.createDataFrame([("1", *[None] * 9)], PROVIDER_DIM), path)
    broken = tmp_path / "t" / "snapshot-00000002"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half a file")
    assert read_table(spark, path, PROVIDER_DIM).count() == 1
    replace_table(spark.createDataFrame([("2", *[None] * 9)], PROVIDER_DIM), path)
    assert read_table(spark, path, PROVIDER_DIM).first()["ccn"] == "2"


def test_only_touched_partitions_are_replaced(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.range(9).select("id", (F.col("id") % 3).alias("p")).write.partitionBy("p").parquet(path)
    untouched = sorted(f.name for f in (tmp_path / "t" / "p=0").iterdir())
    own = spark.read.parquet(path).where("p = 1").withColumn("id", F.col("id") + 100)
    replace_partitions(own, path, "p")
    assert rows(spark.read.parquet(path).where("p = 1"), "id") == [(101,), (104,), (107,)]
    assert sorted(f.name for f in (tmp_path / "t" / "p=0").iterdir()) == untouched


# The whole flow -------------------------------------------------------------------------------------------------------


@pytest.fixture
def site(tmp_path):
    """A landing folder that files can be dropped into."""

    class Site:
        config = Medallion(str(tmp_path / "landing"), str(tmp_path / "warehouse"))

        def drop(self, name, schema, content):
            (tmp_path / "landing").mkdir(exist_ok=True)
            with open(tmp_path / "landing" / name, "w", newline="") as file:
                writer = stdlib_csv.writer(file)
                writer.writerow(schema.names)
                writer.writerows([[row.get(n, "") for n in schema.names] for row in content])

        def providers(self, name, *content):
            rows = [
                {
                    "CMS_Certification_Number_CCN": ccn, "Provider_Name": title, "Provider_Address": "1, Main St",
                    "City_Town": "C", "State": "AL", "ZIP_Code": 35653, "Number_of_Certified_Beds": beds,
                    "Latitude": "34.514971", "Longitude": "-87.736372",
                }
                for ccn, title, beds in content
            ]
            self.drop(name, provider_info_schema(), rows)

        def days(self, name, *content):
            names = ["PROVNUM", "WorkDate", "MDScensus", *silver.FACT_MEASURES.values()]
            self.drop(name, daily_nurse_staffing_schema(), [dict(zip(names, row, strict=True)) for row in content])

    return Site()


def gold_rows(spark, config):
    return {
        (r["ccn"], r["year"], r["month"], r["title"]): (str(r["totalworkhour"]), str(r["bedutilizationrate"]))
        for r in read_gold(spark, config).collect()
    }


CNA = "Full Time CNA"


def test_files_to_gold_and_again(spark, site):
    site.providers("ProviderInfo_1.csv", ("015009", "One", 57), ("015010", "Two", 85))
    site.days(
        "DailyNurseStaffing_1.csv",
        ("015009", "20240401", "51", "10.77", "0", "160.08", "0"),
        ("015009", "20240402", "52", "8.43", "0", "135.95", "0"),
        ("999999", "20240402", "52", "1", "1", "1", "1"),
    )
    run_medallion(spark, site.config, F.lit(FIRST))
    first = gold_rows(spark, site.config)
    assert first[("015009", 2024, 4, CNA)] == ("296.03", "90.35")
    assert len(first) == 4
    fact, providers, types, dates = silver_tables(spark, site.config)
    assert (fact.count(), providers.count(), types.count(), dates.count()) == (12, 2, 4, 2)
    assert str(providers.first()["latitude"]) == "34.514971"

    with pytest.raises(NoNewFilesError):
        run_medallion(spark, site.config, F.lit(SECOND))
    run_medallion(spark, site.config, F.lit(SECOND), on_empty="skip")
    assert gold_rows(spark, site.config) == first
    assert [t.count() for t in silver_tables(spark, site.config)] == [12, 2, 4, 2]
    assert {r["updated_at"] for r in silver_tables(spark, site.config)[0].collect()} == {SECOND}

    site.days("dailynursestaffing_2.csv", ("015010", "20240501", "80", "1", "2", "3", "4"))
    run_medallion(spark, site.config, F.lit(SECOND))
    after = gold_rows(spark, site.config)
    assert after[("015010", 2024, 5, CNA)] == ("3.00", "94.12")
    assert {k: v for k, v in after.items() if k in first} == first


def test_failed_check_leaves_silver_untouched(spark, site, tmp_path):
    site.providers("ProviderInfo_1.csv", ("015009", "One", 57), ("015009", "Renamed", 57), ("015011", "Three", ""))
    site.days("DailyNurseStaffing_1.csv", ("015009", "20240401", "51", "1", "", "3", "4"))
    with pytest.raises(ValidationError) as error:
        run_medallion(spark, site.config)
    for text in (
        "1 duplicate values in cms_certification_number_ccn",
        "1 NULL values in number_of_certified_beds",
        "1 NULL values in workhours",
    ):
        assert text in str(error.value)
    assert not (tmp_path / "warehouse" / "silver").exists()
    assert not (tmp_path / "warehouse" / "gold").exists()


def test_scale_zero_loses_the_fractions(spark, site):
    config = Medallion(site.config.landing, site.config.warehouse, strict_scale=True)
    site.providers("ProviderInfo_1.csv", ("015009", "One", 57))
    site.days("DailyNurseStaffing_1.csv", ("015009", "20240401", "51", "10.77", "0", "160.98", "0"))
    run_medallion(spark, config)
    row = read_gold(spark, config).where(F.col("title") == CNA).first()
    assert str(row["totalworkhour"]) == "160.00"
    assert str(row["latitude"]) == "34.000000"


def merged(spark, config, days, **options):
    """One merge of the fact, committed; the entry's live versions of the fact's months."""
    commit = config.ledger.begin(spark)
    merge_fact(commit, config, days, **options)
    commit.commit()
    return config.ledger.state(spark)[FACT_TABLE]


def test_only_touched_months_are_rewritten(spark, site):
    first = merged(spark, site.config, staffing(spark, ("p", "20240101", "1", 1, 1, 1, 1), ("p", "20240201", "1", 1, 1, 1, 1)))
    second = merged(spark, site.config, staffing(spark, ("p", "20240201", "1", 5, 1, 1, 1), ("q", "20240301", "1", 1, 1, 1, 1)))
    assert first["work_month=202401"] == second["work_month=202401"]
    assert first["work_month=202402"] != second["work_month=202402"] and "work_month=202403" in second
    fact = silver_tables(spark, site.config)[0]
    assert fact.count() == 12
    assert fact.where("workdateid = '20240201' and staffingtypeid = '1'").first()["workhours"] == Decimal("5.00")


def test_rows_without_a_date_survive_a_merge(spark, site):
    for provider in ("p", "q"):
        merged(spark, site.config, staffing(spark, (provider, None, "1", 1, 1, 1, 1)))
    assert silver_tables(spark, site.config)[0].count() == 8


def test_fact_merge_shuffles_the_stage_once(spark, tmp_path):
    days = staffing(spark, *[(f"p{n % 50}", f"202401{n % 28 + 1:02d}", str(n), n, 1, 1, 1) for n in range(500)])
    days.write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    target = silver.build_fact(days.where("WorkDate < '20240110'"), spark.createDataFrame([], fact_schema()))
    target.write.parquet(str(tmp_path / "fact"))
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in thresholds}
    try:
        for name in thresholds:
            spark.conf.set(name, "-1")
        merged = silver.build_fact(days, spark.read.parquet(str(tmp_path / "fact")))
        assert merged.count() > 0
        merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert plan.count("ReusedExchange") == 1
    # The stage by provider and day, the target's rows, and what the target knows per provider and day.
    assert len([line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "Reused" not in line]) == 3


def test_fact_check_of_complete_days_skips_their_files(spark, tmp_path):
    from lodestrata.plans.medallion import checked_relations

    staffing(spark, ("p", "20240101", "80", 8, 8, 1, 1)).write.parquet(str(tmp_path / "days"))
    providers = spark.createDataFrame([(None,) * 9], ", ".join(f"{c} string" for c in silver.PROVIDER_COLUMNS.values()))
    suspects = checked_relations(providers, spark.read.parquet(str(tmp_path / "days")))[2][2]
    plan = suspects._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "IsNull(PROVNUM)" in plan
    assert suspects.count() == 0


def test_suspects_hold_exactly_the_rows_with_a_null(spark, rows):
    days = staffing(spark, ("p", "20240101", "80", 8, None, 1, 1), (None, "20240101", "80", 8, 1, 1, 1), ("q", "20240101", "1", 1, 1, 1, 1))
    columns = fact_schema().names[:5]
    has_null = " or ".join(f"{c} is null" for c in columns)
    assert rows(silver.incomplete_facts(days).where(has_null)) == rows(silver.fact_bag(days).where(has_null))


def test_months_of_empty_and_padded_dates(spark):
    from lodestrata.plans.medallion import month_of

    dates = spark.createDataFrame([("",), (None,), (" 20241231",), ("20240102",)], "d string")
    assert [r[0] for r in dates.select(month_of(dates["d"])).collect()] == [None, None, "202412", "202401"]


def two_months(site):
    site.providers("ProviderInfo_1.csv", ("015009", "One", 57))
    site.days("DailyNurseStaffing_1.csv", ("015009", "20240401", "51", "1", "2", "3", "4"), ("015009", "20240501", "51", "1", "2", "3", "4"))


def test_second_drop_leaves_other_months_alone(spark, site):
    two_months(site)
    run_medallion(spark, site.config, scope="months")
    first = site.config.ledger.state(spark)
    site.days("DailyNurseStaffing_2.csv", ("015009", "20240502", "50", "1", "2", "3", "4"))
    run_medallion(spark, site.config, scope="months")
    second = site.config.ledger.state(spark)
    for table in (FACT_TABLE, STATE_TABLE, GOLD_TABLE):
        assert first[table]["work_month=202404"] == second[table]["work_month=202404"]
        assert first[table]["work_month=202405"] != second[table]["work_month=202405"]
    assert silver_tables(spark, site.config)[0].count() == 12


def test_gold_of_a_second_drop_reads_no_other_month(spark, site):
    """The plans of the delta list the files of the touched month alone."""
    two_months(site)
    run_medallion(spark, site.config, scope="months")
    config, read = site.config, []
    commit = config.ledger.begin(spark)
    plain = commit.read

    def watched(table, *arguments, **options):
        df = plain(table, *arguments, **options)
        if table in (FACT_TABLE, STATE_TABLE):
            read.extend(df.inputFiles())
        return df

    commit.read = watched
    days = staffing(spark, ("015009", "20240502", "50", 1, 2, 3, 4))
    months = merge_fact(commit, config, days)
    refresh_gold(commit, config, months=months)
    assert months == ["202405"] and read and all("work_month=202405" in path for path in read)
    commit.abandon()


def test_changed_provider_changes_all_its_months(spark, site):
    two_months(site)
    config = Medallion(site.config.landing, site.config.warehouse, latest_by="Processing_Date")
    run_medallion(spark, config, scope="months")
    site.drop(
        "ProviderInfo_2.csv", provider_info_schema(),
        [{"CMS_Certification_Number_CCN": "015009", "Provider_Name": "New", "Provider_Address": "1", "City_Town": "C", "State": "AL",
          "ZIP_Code": 1, "Number_of_Certified_Beds": 102, "Latitude": "1", "Longitude": "1", "Processing_Date": "2024-06-01"}],
    )
    run_medallion(spark, config, scope="months")
    shown = {(r["month"], r["providername"], str(r["bedutilizationrate"])) for r in read_gold(spark, config).collect()}
    assert shown == {(4, "New", "50.00"), (5, "New", "50.00")}


def test_decimal_mode_and_back(spark, site):
    """A table made from the whole fact gives way to the maintained one, and the other way round."""
    two_months(site)
    exact, decimal = site.config, Medallion(site.config.landing, site.config.warehouse, mode="decimal")
    for config in (exact, decimal, exact):
        run_medallion(spark, config, on_empty="skip")
        assert len(gold_rows(spark, config)) == 8


# A killed run, two writers --------------------------------------------------------------------------------------------


def test_run_killed_between_two_tables_changes_nothing(spark, site, monkeypatch):
    from lodestrata.sources.ledger import Commit

    two_months(site)
    run_medallion(spark, site.config, scope="months")
    before, state = gold_rows(spark, site.config), site.config.ledger.state(spark)
    site.days("DailyNurseStaffing_2.csv", ("015009", "20240402", "5", "1", "2", "3", "4"), ("015009", "20240502", "5", "1", "2", "3", "4"))
    plain = Commit.replace_partitions

    def killed(self, df, table, *arguments, **options):
        plain(self, df, table, *arguments, **options)
        if table == STATE_TABLE:
            raise KeyboardInterrupt

    monkeypatch.setattr(Commit, "replace_partitions", killed)
    with pytest.raises(KeyboardInterrupt):
        run_medallion(spark, site.config, scope="months")
    monkeypatch.undo()
    assert gold_rows(spark, site.config) == before and site.config.ledger.state(spark) == state
    assert silver_tables(spark, site.config)[0].count() == 8
    run_medallion(spark, site.config, scope="months", on_empty="skip")
    after = gold_rows(spark, site.config)
    assert after[("015009", 2024, 4, CNA)] == ("6.00", "49.12") and silver_tables(spark, site.config)[0].count() == 16


def test_files_of_a_stopped_run_are_merged_by_the_next(spark, site):
    site.providers("ProviderInfo_1.csv", ("015009", "One", 57), ("015009", "Renamed", 57))
    site.days("DailyNurseStaffing_1.csv", ("015009", "20240401", "51", "1", "2", "3", "4"))
    with pytest.raises(ValidationError):
        run_medallion(spark, site.config, scope="months")
    config = Medallion(site.config.landing, site.config.warehouse, latest_by="Processing_Date")
    site.days("DailyNurseStaffing_2.csv", ("015009", "20240501", "51", "1", "2", "3", "4"))
    run_medallion(spark, config, scope="months")
    fact, providers = silver_tables(spark, config)[:2]
    assert fact.count() == 8
    assert [r["providername"] for r in providers.collect()] == ["Renamed"]


def test_rows_of_months(spark):
    from lodestrata.plans.medallion import rows_of_months, touched_months

    dates = [None, "", " ", "20240101", " 20240131", "20240201", "20240301", "202403"]
    days = spark.createDataFrame([(d,) for d in dates], "WorkDate string")
    found = lambda months: sorted([r[0] or "" for r in rows_of_months(days, months).collect()])
    assert found([None]) == ["", "", " "]
    assert found(["202401", "202403"]) == [" 20240131", "20240101", "202403", "20240301"]
    assert found([]) == []
    assert sorted(touched_months(days), key=str) == ["202401", "202402", "202403", None]


# Quarantine, stamps, order -------------------------------------------------------------------------------------------


def test_faulty_rows_are_set_aside_once_and_the_rest_goes_on(spark, site):
    site.providers("ProviderInfo_1.csv", ("015009", "One", 57))
    site.days(
        "DailyNurseStaffing_1.csv",
        ("015009", "20240401", "51", "1", "2", "3", "4"), ("015009", "20240402", "51", "1", "", "3", "4"),
        ("015009", "20240403", "51", "", "", "3", "4"),
    )
    with pytest.raises(ValidationError):
        run_medallion(spark, site.config, scope="months")
    run_medallion(spark, site.config, scope="months", on_fault="quarantine", on_empty="skip")
    assert silver_tables(spark, site.config)[0].count() == 4 and len(gold_rows(spark, site.config)) == 4
    first, second = (1 << STAFFING_RULES.index(c) for c in list(silver.FACT_MEASURES.values())[:2])
    bits = {r["WorkDate"]: r["broken_rules"] for r in read_quarantine(spark, site.config).collect()}
    assert bits == {"20240402": second, "20240403": first | second}
    site.days("DailyNurseStaffing_2.csv", ("015009", "20240404", "51", "1", "2", "3", "4"))
    run_medallion(spark, site.config, scope="months", on_fault="quarantine")
    assert silver_tables(spark, site.config)[0].count() == 8 and read_quarantine(spark, site.config).count() == 2


def test_checks_are_observed_in_one_scan(spark, tmp_path, rows):
    """Counts, clean rows and set-aside rows come from one pass over the source; more rules than bits are refused."""
    scanned = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            scanned.add(batch.num_rows)
            yield batch

    source = spark.createDataFrame([(1, "a"), (None, "b"), (2, None), (None, None)], "x int, y string")
    found = staged(source.mapInArrow(count, "x int, y string"), null_rules(["x", "y"]) | {"big": F.col("x") > 1}, str(tmp_path / "s"))
    assert (found.rows, found.violations) == (4, {"x": 2, "y": 2, "big": 1})
    assert rows(found.clean) == [(1, "a")]
    assert rows(found.quarantined, "broken_rules") == [(1,), (3,), (6,)]
    assert found.report("t").count() == 4 and scanned.value == 4
    empty = staged(source.limit(0), null_rules(["x"]), str(tmp_path / "e"))
    assert (empty.rows, empty.violations, empty.clean.count(), empty.quarantined.count()) == (0, {"x": 0}, 0, 0)
    with pytest.raises(ValueError, match="64 rules"):
        staged(source, {str(n): F.lit(True) for n in range(64)}, str(tmp_path / "m"))


def test_one_stamp_for_a_run_and_only_for_matched_rows(spark, rows):
    """Without a given stamp a run has one instant; rows without a match keep theirs."""
    old = [("p", "20240101", 1, "1", Decimal(1), FIRST), ("q", "20240101", 1, "1", Decimal(1), FIRST)]
    target = spark.createDataFrame(old, fact_schema())
    started = datetime.datetime.now()
    merged = silver.build_fact(staffing(spark, ("p", "20240101", "2", 5, 1, 1, 1), ("r", "20240101", "2", 5, 1, 1, 1)), target).collect()
    stamps = {r["updated_at"] for r in merged if r["ccn"] != "q"}
    assert len(stamps) == 1 and started <= stamps.pop() <= datetime.datetime.now()
    assert [r["updated_at"] for r in merged if r["ccn"] == "q"] == [FIRST]


def test_written_files_are_sorted(spark, tmp_path):
    from lodestrata.operators.reshape import ordered_within_files

    days = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n"), (F.col("id") % 3).alias("p")).repartition(4)
    ordered_within_files(days, "p", "n").write.parquet(str(tmp_path / "sorted"))
    files = sorted((tmp_path / "sorted").glob("*.parquet"))
    for file in files:
        found = [(r["p"], r["n"]) for r in spark.read.parquet(str(file)).coalesce(1).collect()]
        assert len(found) > 1 and found == sorted(found)


def test_first_fact_is_the_merge_into_an_empty_fact(spark, rows):
    """Copies, several rows of one key, and missing keys, dates, census and hours."""
    days = [("p", "20240101", "80", 8, 1, 1, None)] * 2 + [("p", "20240101", "81", 8, 2, 1, None), ("q", "20240102", None, 1, 1, 1, 1)]
    days += [(None, "20240101", "80", 8, 1, 1, 1)] * 2 + [("p", None, "7", 0.125, 1, 1, 1)] * 2
    stamp = F.lit(FIRST)
    for strict in (False, True):
        empty = spark.createDataFrame([], fact_schema(strict))
        first = silver.first_fact(staffing(spark, *days), empty, stamp, strict_scale=strict)
        merged = silver.build_fact(staffing(spark, *days), empty, stamp, strict_scale=strict)
        assert first.dtypes == merged.dtypes
        assert rows(first) == rows(merged) and first.count() == 20


def test_only_months_with_rows_are_merged_into(spark, tmp_path, rows, monkeypatch):
    """A first run, and a run whose months are all new, neither aggregate nor join for an update; a run into old rows does."""
    merges, build = [], silver.build_fact
    monkeypatch.setattr(silver, "build_fact", lambda *a, **k: merges.append(1) or build(*a, **k))
    config, found = Medallion(str(tmp_path / "in"), str(tmp_path / "out")), []
    for day, hours, expected in (("20240101", 1, 0), ("20240201", 2, 0), ("20240101", 3, 1)):
        commit = config.ledger.begin(spark)
        merge_fact(commit, config, staffing(spark, ("p", day, "80", hours, 1, 1, 1)), F.lit(FIRST))
        commit.commit()
        assert len(merges) == expected
        found = rows(config.ledger.read(spark, FACT_TABLE, config.fact_rows), "workdateid", "staffingtypeid", "workhours")
    firsts = [r for r in found if r[1] == "1"]
    assert firsts == [("20240101", "1", Decimal("3.00")), ("20240201", "1", Decimal("2.00"))] and len(found) == 8
