import pytest
from pyspark.sql import functions as F

from layouts import layout

from lodestrata.operators import quality
from lodestrata.operators.quality import CheckSet, ValidationError, check_results, gate_status, validate
from lodestrata.operators.reshape import literal_rows, union_distinct, wide_to_long
from lodestrata.sources.conformance import schema_conformance

CHECKS = CheckSet("some.table", required=["k", "v"], unique=["k"])


def frame(spark, *content):
    return spark.createDataFrame(content, "k string, v int")


def test_clean_relation_passes(spark):
    df = frame(spark, ("a", 1), ("b", 2))
    validate(df, CHECKS)
    assert tuple(gate_status(check_results(df, CHECKS)).first()) == (4, 0, True)


def test_all_findings_are_listed_in_order(spark):
    df = frame(spark, ("a", 1), ("a", 2), (None, None), (None, 4), (None, 5))
    with pytest.raises(ValidationError) as error:
        validate(df, CHECKS)
    assert str(error.value) == (
        "Validation failed:\n3 NULL values in k\n3 duplicate values in k\n1 NULL values in v"
    )
    assert tuple(gate_status(check_results(df, CHECKS)).first()) == (4, 7, False)


def test_distinct_rows_are_counted_once(spark):
    df = frame(spark, ("a", 1), ("a", 1), (None, 1), (None, 1), ("b", None), ("b", None), ("b", None))
    found = {(r["check"], r["column"]): r["violations"] for r in check_results(df, CHECKS, distinct_rows=True).collect()}
    assert found == {("not_empty", None): 0, ("not_null", "k"): 1, ("unique", "k"): 0, ("not_null", "v"): 1}


def test_empty_relation_fails_first(spark):
    with pytest.raises(ValidationError, match="Query returned no data from some.table"):
        validate(frame(spark).where("false"), CHECKS)


def test_empty_relation_comes_before_missing_columns(spark):
    with pytest.raises(ValidationError, match="no data"):
        validate(frame(spark).drop("v"), CHECKS)
    with pytest.raises(ValidationError, match=r"Missing expected columns: \['v'\]"):
        validate(frame(spark, ("a", 1)).drop("v"), CHECKS)


def test_names_are_trimmed_and_lowered(spark):
    validate(frame(spark, ("a", 1)).toDF(" K ", "V"), CHECKS)


def test_missing_column_in_a_report(spark):
    found = check_results(frame(spark, ("a", 1)).drop("v"), CHECKS).collect()
    assert [(r["check"], r["column"], r["violations"]) for r in found] == [("required_columns", "v", 1)]


def test_gate_stays_shut_without_results(spark):
    df = frame(spark, ("a", 1))
    assert gate_status(check_results(df, CHECKS).where("false")).first()["passed"] is False


def test_null_check_of_clean_rows_reaches_the_scan(spark, tmp_path):
    frame(spark, ("a", 1)).write.parquet(str(tmp_path / "t"))
    plan = quality.null_counts(spark.read.parquet(str(tmp_path / "t")), ["k", "v"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(k),IsNull(v))]" in text


def test_duplicates_of_null_and_value(spark):
    df = frame(spark, (None, 1), (None, 1), (None, 1), ("a", 1), ("a", 1))
    assert quality.duplicate_count(df, ["k"]).first()[0] == 3
    assert quality.duplicate_count(df.where("false"), ["k"]).first()[0] == 0


def test_conformance_counts_values_that_do_not_fit(spark):
    df = spark.createDataFrame([("1", 70000), ("x", 5), (None, None)], "a string, b int")
    found = {r["column"]: tuple(r)[1:] for r in schema_conformance(df, layout("a int; b smallint; c string")).collect()}
    assert found == {
        "a": ("int", "string", False, 1),
        "b": ("smallint", "int", False, 1),
        "c": ("string", None, False, None),
    }


def test_wide_to_long_keeps_nulls_and_equal_values(spark, rows):
    df = spark.createDataFrame([("p", 1, 1), ("p", 1, 1), ("q", None, 2)], "id string, emp int, ctr int")
    result = wide_to_long(df, ["id"], {"1": "emp", "2": "ctr"}, "kind", "hours").distinct()
    assert set(rows(result)) == {("p", "1", 1), ("p", "2", 1), ("q", "1", None), ("q", "2", 2)}
    assert result.count() == 4


def test_wide_to_long_scans_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).select("id", F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1).alias("unused")).write.parquet(path)
    result = wide_to_long(spark.read.parquet(path), ["id"], {"1": "a", "2": "b"}, "kind", "hours").distinct()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "unused" not in plan


def test_union_distinct_binds_by_position(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    right = spark.createDataFrame([(2,), (3,)], "b int")
    assert rows(union_distinct(left, right)) == [(1,), (2,), (3,)]


def test_literal_rows_are_distinct_and_tiny(spark, rows):
    df = literal_rows(spark, [(1, "a"), (1, "a"), (2, None)], layout("n int; t string"))
    assert rows(df) == [(1, "a"), (2, None)]
    assert df.schema.simpleString() == "struct<n:int,t:string>"
    big = spark.range(10_000_000).withColumn("n", F.col("id").cast("int"))
    assert "BroadcastHashJoin" in big.join(df, "n")._jdf.queryExecution().executedPlan().toString()
