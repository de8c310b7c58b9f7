"""What a run holds on disk: few shuffles, of narrow rows, none of which outlives its step."""

import datetime
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import maintained, skew
from lodestrata.plans import medallion, silver
from lodestrata.plans.medallion import FACT_TABLE, GOLD_TABLE, MONTH, Medallion, merge_fact, month_of
from lodestrata.schemas import fact_schema
from lodestrata.session import SHUFFLE_CLEANUP, freed_shuffles

RUN = datetime.datetime(2026, 1, 1)
COLUMNS = "PROVNUM string, WorkDate string, MDScensus string, " + ", ".join(
    f"{c} decimal(18,2)" for c in silver.FACT_MEASURES.values()
)


def staffing(spark, *content):
    return spark.createDataFrame([(*r[:3], *[None if h is None else Decimal(h) for h in r[3:]]) for r in content], COLUMNS)


def many_days(spark, n):
    """Three months of one size and one that has half of the rows; a third of all rows are those of provider `p0`."""
    month = F.when(F.col("id") % 2 == 0, "202402").otherwise(F.concat(F.lit("20230"), 1 + F.col("id") % 3))
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "p0").otherwise(F.concat(F.lit("p"), F.col("id") % 211)).alias("PROVNUM"),
        F.concat(month, 10 + F.col("id") % 17).alias("WorkDate"),
        (F.col("id") % 5).cast("string").alias("MDScensus"),
        *[(F.col("id") % (h + 2)).cast("decimal(18,2)").alias(c) for h, c in enumerate(silver.FACT_MEASURES.values())],
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written(commit):
    """The plans that are written by partition through `commit`, by table."""
    plans, replace = {}, commit.replace_partitions

    def watched(df, table, *arguments, **options):
        plans[table] = plan(df)
        return replace(df, table, *arguments, **options)

    commit.replace_partitions = watched
    return plans


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_step_that_made_them(spark, tmp_path):
    df = spark.range(1000).repartition(7, "id")
    df.count()
    before = shuffle_files(spark)
    with freed_shuffles(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        df.write.parquet(str(tmp_path / "rows"))
        end = time.time() + 20
        while shuffle_files(spark) - before and time.time() < end:
            time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) != "true"
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 1000


def test_a_run_frees_its_shuffles_and_leaves_the_setting_alone(spark, tmp_path, monkeypatch):
    during = []
    for name in ("merge_silver", "refresh_gold"):
        plain = getattr(medallion, name)

        def watched(*arguments, plain=plain):
            during.append(spark.conf.get(SHUFFLE_CLEANUP, None))
            return plain(*arguments)

        monkeypatch.setattr(medallion, name, watched)
    monkeypatch.setattr(medallion, "run_checks", lambda *arguments: None)
    from lodestrata.queries import inputs

    config = Medallion(str(tmp_path / "in"), str(tmp_path / "out"))
    inputs.drop_facilities(spark, "/root/testdata/sf0.001", config.landing)
    inputs.drop_staffing(many_days(spark, 50), config.landing)
    medallion.run_medallion(spark, config, scope="months")
    assert during == ["true", "true"] and spark.conf.get(SHUFFLE_CLEANUP, None) != "true"


def test_a_first_fact_shuffles_its_wide_rows_once(spark, tmp_path, rows):
    """The long rows are written where they are made; the rows are those of the stage spread by day."""
    config = Medallion(str(tmp_path / "in"), str(tmp_path / "out"))
    commit = config.ledger.begin(spark)
    plans = written(commit)
    merge_fact(commit, config, many_days(spark, 3000), F.lit(RUN))
    assert plans[FACT_TABLE].count("Exchange ") == 2 and plans[FACT_TABLE].count("BroadcastExchange ") == 1
    found = commit.read(FACT_TABLE, config.fact_rows, MONTH).drop(MONTH)
    assert rows(found) == rows(silver.first_fact(many_days(spark, 3000), spark.createDataFrame([], fact_schema()), F.lit(RUN)))
    commit.abandon()


@pytest.mark.parametrize("hot_rows", [10**6, 300])
def test_rows_by_month_are_those_by_day(spark, rows, monkeypatch, hot_rows):
    """Copies, missing keys and dates, blanks around a date, large and small months, and a provider month that is hot."""
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 200)
    monkeypatch.setattr(skew, "FEWEST_ROWS", 50)
    monkeypatch.setattr(skew.hot_key_hashes, "__defaults__", (hot_rows,))
    odd = [("p", "20240101", "80", 8, 1, 1, None)] * 2 + [(None, "20240101", "80", 8, 1, 1, 1)] * 2
    odd += [("p", None, "7", 0.125, 1, 1, 1)] * 2 + [("p", "", None, 1, 1, 1, 1), ("p", " 20240101", "80", 8, 1, 1, None)]
    days, empty = many_days(spark, 2000).unionByName(staffing(spark, *odd)), spark.createDataFrame([], fact_schema())
    by_month = silver.first_fact(days, empty, F.lit(RUN), part=(MONTH, month_of))
    plain = silver.first_fact(days, empty, F.lit(RUN))
    assert by_month.dtypes == plain.dtypes and rows(by_month) == rows(plain)
    # "rebalance" is only for the rows of hot keys.
    assert ("REBALANCE" in plan(by_month)) == (hot_rows == 300)
    assert "REBALANCE" not in plan(plain)


def test_a_task_has_few_months_and_a_bounded_share_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 400)
    monkeypatch.setattr(skew, "FEWEST_ROWS", 50)
    days = silver.staffing_days(many_days(spark, 6000)).withColumn(MONTH, month_of(F.col("workdateid")))
    found = skew.spread_within(days.where("ccn != 'p0'"), F.col(MONTH), [MONTH, "ccn"])
    found = found.withColumn("p", F.spark_partition_id())
    tasks = found.groupBy("p").agg(F.count("*").alias("n"), F.count_distinct(MONTH).alias("m")).collect()
    assert max(r["n"] for r in tasks) < 3 * 200 and max(r["m"] for r in tasks) == 1 and len(tasks) > 15
    together = found.groupBy(MONTH, "ccn").agg(F.count_distinct("p").alias("p")).agg(F.max("p")).first()[0]
    assert together == 1


def test_small_parts_share_a_task(monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 200)
    monkeypatch.setattr(skew, "FEWEST_ROWS", 10)
    placed, tasks = skew.tasks_of_parts({"c": 250, "a": 40, "b": 50, None: 5, "d": 1, "e": 99}, 2)
    assert (placed, tasks) == ([(None, 0, 1), ("a", 0, 1), ("b", 0, 1), ("c", 1, 3), ("d", 4, 1), ("e", 4, 1)], 5)
    assert skew.tasks_of_parts({}, 8) == ([], 1)
    assert skew.tasks_of_parts({"a": 500}, 1) == ([("a", 0, 5)], 5)
    assert skew.tasks_of_parts({"a": 3, "b": 4}, 8) == ([("a", 0, 1), ("b", 0, 1)], 1)


def test_a_delta_without_an_old_state_is_the_state(spark, rows):
    """It is not shuffled a second time, and groups without rows are left out of it all the same."""
    schema = "k string, v decimal(18,2)"
    data = [("a", Decimal(1)), ("a", None), (None, Decimal(2)), ("b", Decimal(3))]
    before, after = spark.createDataFrame([("b", Decimal(3)), ("z", Decimal(4))], schema), spark.createDataFrame(data, schema)
    expected = maintained.state(after, ["k"], ["v"])
    change = maintained.delta(spark.createDataFrame([], schema), after, ["k"], ["v"])
    first = maintained.applied(spark.createDataFrame([], expected.schema), change, ["k"], ["v"])
    assert plan(first).count("Exchange ") == 1
    one = spark.createDataFrame([("y", Decimal(0), 0, 1)], expected.schema)
    assert first.dtypes == maintained.applied(one, change, ["k"], ["v"]).dtypes
    assert rows(first) == rows(expected)
    lost = maintained.applied(spark.createDataFrame([], expected.schema), maintained.delta(before, after, ["k"], ["v"]), ["k"], ["v"])
    assert [r[0] for r in rows(lost)] == ["a", None]


def test_gold_is_shuffled_by_provider_before_it_has_their_texts(spark, tmp_path):
    from lodestrata.queries import inputs

    config, sf_dir = Medallion(str(tmp_path / "in"), str(tmp_path / "out")), "/root/testdata/sf0.001"
    commit = config.ledger.begin(spark)
    plans = written(commit)
    months = medallion.merge_silver(commit, config, inputs.facilities(spark, sf_dir), inputs.staffing(spark, sf_dir), F.lit(RUN))
    medallion.refresh_gold(commit, config, F.lit(RUN), months)
    wide = [line for line in plans[GOLD_TABLE].split("\n") if "Exchange hashpartitioning" in line and "providername" in line]
    assert not wide and plans[GOLD_TABLE].count("REBALANCE") == 1
    assert commit.read(GOLD_TABLE, medallion.STATE, MONTH).count() > 0
    commit.abandon()
