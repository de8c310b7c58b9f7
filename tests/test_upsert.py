import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrata.operators.skew import hot_key_hashes, key_hash, lookup_join
from lodestrata.operators.upsert import insert_if_absent, last_per_key, missing_rows, update_from, upsert

OLD, NEW = datetime.datetime(2020, 1, 1), datetime.datetime(2026, 1, 1)
TARGET = "k int, v string, w int, updated_at timestamp"
STAGE = "k int, v string, w int"


def frames(spark, target, stage):
    return (
        spark.createDataFrame([(*row, OLD) for row in target], TARGET),
        spark.createDataFrame(stage, STAGE),
    )


def merged(spark, target, stage, **options):
    t, s = frames(spark, target, stage)
    return upsert(t, s, ["k"], stamp=F.lit(NEW), **options)


def test_update_insert_and_untouched(spark, rows):
    result = merged(spark, [(1, "a", 1), (2, "b", 2)], [(2, "B", None), (3, "c", 3)])
    assert rows(result) == [(1, "a", 1, OLD), (2, "B", None, NEW), (3, "c", 3, NEW)]


def test_matched_row_is_restamped_even_when_equal(spark, rows):
    assert rows(merged(spark, [(1, "a", 1)], [(1, "a", 1)])) == [(1, "a", 1, NEW)]


def test_default_stamp_is_one_instant_of_the_run(spark):
    target, stage = frames(spark, [(1, "a", 1), (2, "b", 2)], [(2, "B", 0), (3, "c", 3), (4, "d", 4)])
    begin = datetime.datetime.now()
    found = {r["k"]: r["updated_at"] for r in upsert(target, stage.repartition(3), ["k"]).collect()}
    assert found[1] == OLD
    assert len({found[2], found[3], found[4]}) == 1
    assert begin <= found[2] <= datetime.datetime.now()


def test_null_keys_never_match(spark, rows):
    result = merged(spark, [(None, "t", 1)], [(None, "s", 2), (None, "s", 2)])
    assert rows(result) == [(None, "s", 2, NEW), (None, "s", 2, NEW), (None, "t", 1, OLD)]


def test_several_stage_rows_per_key(spark, rows):
    stage = [(1, "x", 5), (1, "y", 4), (7, "p", 1), (7, "q", 1)]
    assert rows(merged(spark, [(1, "a", 0)], stage)) == [(1, "y", 4, NEW), (7, "p", 1, NEW), (7, "q", 1, NEW)]
    assert rows(merged(spark, [(1, "a", 0)], stage, order_by=["w"]))[0] == (1, "x", 5, NEW)
    assert rows(merged(spark, [(1, "a", 0)], stage, insert_duplicates="one")) == [(1, "y", 4, NEW), (7, "q", 1, NEW)]
    with pytest.raises(Exception, match="several new rows for key 7"):
        merged(spark, [(1, "a", 0)], stage, insert_duplicates="error").collect()
    # Several rows for a known key are an update, not an insert.
    assert rows(merged(spark, [(1, "a", 0)], stage[:2], insert_duplicates="error")) == [(1, "y", 4, NEW)]
    with pytest.raises(ValueError, match="unknown policy"):
        merged(spark, [], stage, insert_duplicates="maybe")


def test_duplicate_target_rows_are_all_updated(spark, rows):
    assert rows(merged(spark, [(1, "a", 0), (1, "b", 1)], [(1, "z", 9)])) == [(1, "z", 9, NEW)] * 2


def test_update_and_insert_alone(spark, rows):
    t, s = frames(spark, [(1, "a", 1)], [(1, "b", 2), (2, "c", 3)])
    assert rows(update_from(t, s, ["k"], stamp=F.lit(NEW))) == [(1, "b", 2, NEW)]
    assert rows(missing_rows(t, s, ["k"], stamp=F.lit(NEW))) == [(2, "c", 3, NEW)]


def test_insert_if_absent_leaves_known_rows_alone(spark, rows):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("a", 2), ("b", 3), ("b", 3), ("b", 4)], "k string, v int")
    assert rows(insert_if_absent(target, source, ["k"])) == [("b", 3)]
    assert rows(insert_if_absent(target.select("k"), source.select("k"), ["k"])) == [("b",)]


def test_last_per_key_counts_copies(spark, rows):
    stage = spark.createDataFrame([(1, "a", None), (1, "a", 3), (2, None, None)], STAGE)
    assert rows(last_per_key(stage, ["k"]).select("k", "picked.*", "copies")) == [(1, "a", 3, 2), (2, None, None, 1)]


KEY = st.one_of(st.none(), st.integers(0, 5))
ROW = st.tuples(KEY, st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 3)))


def by_hand(target, stage):
    """The merge, one row at a time."""
    best = {}
    for k, v, w in stage:
        if k is not None:
            order = ((v is not None, v or ""), (w is not None, w or 0))
            best[k] = max(best.get(k, (order, v, w)), (order, v, w), key=lambda item: item[0])
    known = {row[0] for row in target if row[0] is not None}
    out = [(k, *best[k][1:], NEW) if k in best else (k, v, w, OLD) for k, v, w in target]
    return out + [(k, v, w, NEW) for k, v, w in stage if k is None or k not in known]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(ROW, max_size=8), stage=st.lists(ROW, max_size=8), hot=st.sets(st.integers(0, 5), max_size=3))
def test_merge_equals_the_row_by_row_form(spark, rows, target, stage, hot):
    ranked = lambda found: sorted(found, key=lambda t: tuple((v is None, str(v)) for v in t))
    hashes = [
        r[0] for r in spark.createDataFrame([(k,) for k in hot], "k int").select(key_hash(["k"])).collect()
    ]
    result = merged(spark, target, stage, target_hot=hashes, stage_hot=hashes)
    assert rows(result) == ranked(by_hand(target, stage))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.dictionaries(st.integers(0, 6), st.integers(0, 3), max_size=6),
    stage=st.dictionaries(st.integers(0, 6), st.integers(0, 3), max_size=6),
)
def test_merge_is_idempotent_for_unique_keys(spark, rows, target, stage):
    t, s = frames(spark, [(k, "t", w) for k, w in target.items()], [(k, "s", w) for k, w in stage.items()])
    once = upsert(t, s, ["k"], stamp=F.lit(NEW))
    assert rows(upsert(once, s, ["k"], stamp=F.lit(NEW))) == rows(once)
    assert rows(upsert(t, s, ["k"], stamp=F.lit(NEW), insert_duplicates="one")) == rows(once)


def skewed(spark):
    """A third of all rows on one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 1000)
    return spark.range(30_000).select(key.alias("k"), F.col("id").alias("v"))


def test_hot_keys_are_found_and_only_they(spark):
    found = hot_key_hashes(skewed(spark), ["k"], min_rows=1000)
    expected = spark.range(1).select(F.lit(7).cast("bigint").alias("k")).select(key_hash(["k"])).first()[0]
    assert found == [expected]
    assert hot_key_hashes(skewed(spark), ["k"]) == []  # too small a table to be worth it
    assert hot_key_hashes(spark.createDataFrame([], "k int"), ["k"]) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
@pytest.mark.parametrize("partner", [True, False])
def test_split_join_equals_the_plain_join(spark, rows, how, partner):
    many = skewed(spark)
    one = spark.range(0 if partner else 1000, 9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    hot = hot_key_hashes(many, ["k"], min_rows=1000)
    assert rows(lookup_join(many, one, ["k"], how, hot)) == rows(many.join(one, ["k"], how))


def test_split_join_refuses_what_it_cannot_split(spark):
    many = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(ValueError, match="split join cannot be full"):
        lookup_join(many, many, ["k"], "full", [1])
    with pytest.raises(ValueError, match="same exact type"):
        lookup_join(many, many.select(F.col("k").cast("int")), ["k"], "inner", [1])


FACT_ROW = st.tuples(
    st.sampled_from(["p", "q", None]), st.sampled_from(["20240101", "20240102", None]), st.integers(1, 2),
    st.integers(0, 2), st.one_of(st.none(), st.integers(0, 2)),
)
TARGET_ROW = st.tuples(
    st.sampled_from(["p", "q", None]), st.sampled_from(["20240101", "20240102", None]), st.integers(0, 9),
    st.sampled_from(["1", "2", "9", None]), st.integers(0, 9),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    days=st.lists(FACT_ROW, max_size=8),
    known=st.lists(TARGET_ROW, max_size=8),
    hot=st.sets(st.sampled_from(["p", "q"]), max_size=1),
)
def test_fact_merge_equals_the_general_merge_of_its_stage(spark, rows, monkeypatch, days, known, hot):
    """The wide form against stage, types and generic upsert, also with a provider taken as hot."""
    from decimal import Decimal

    from lodestrata.plans import silver
    from lodestrata.schemas import fact_schema

    staffing = spark.createDataFrame(
        [(p, d, str(n), *[None if h is None else Decimal(h) for h in (a, b)]) for p, d, n, a, b in days],
        "PROVNUM string, WorkDate string, MDScensus string, emp decimal(18,2), ctr decimal(18,2)",
    )
    measures = {"1": "emp", "2": "ctr"}
    target = spark.createDataFrame([(p, d, n, t, Decimal(h), OLD) for p, d, n, t, h in known], fact_schema())
    pairs = [(p, d) for p in hot for d in ("20240101", "20240102")]
    hashes = [
        r[0]
        for r in spark.createDataFrame(pairs, "ccn string, workdateid string").select(key_hash(silver.FACT_DAY)).collect()
    ]
    stage = silver.typed_fact(silver.fact_bag(staffing, measures).distinct())
    expected = upsert(target, stage, silver.FACT_KEY, stamp=F.lit(NEW))
    with monkeypatch.context() as patch:
        patch.setattr(silver, "hot_days", lambda _df: hashes)
        found = silver.build_fact(staffing, target, F.lit(NEW), measures=measures)
        assert rows(found) == rows(expected)


def test_a_spread_input_takes_more_tasks_as_it_grows(spark, monkeypatch):
    """A task's share of the rows is bounded, for the distinct fact stage and for the wide rows of the merge."""
    from lodestrata.operators import skew
    from lodestrata.plans import silver

    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    staffing = spark.range(3000).select(
        *[F.col("id").cast("string").alias(c) for c in ("PROVNUM", "WorkDate", "MDScensus")],
        *[(F.col("id") + h).cast("decimal(18,2)").alias(c) for h, c in enumerate(silver.FACT_MEASURES.values())],
    )
    stage = silver.fact_stage(staffing)
    assert stage.count() == 12_000
    sizes = stage.select("*", F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(sizes) > 20 and max(r["count"] for r in sizes) < 4 * 200
    cold = silver.Days.split(silver.staffing_days(staffing), []).cold
    assert cold.select(F.spark_partition_id().alias("p")).distinct().count() > 20


def test_a_stage_spread_by_provider_is_summed_by_provider_without_a_shuffle(spark, rows, monkeypatch):
    """One shuffle in all, and the same rows as when spread by day, also with a provider that is hot and one without a name."""
    from lodestrata.operators import skew
    from lodestrata.plans import silver

    staffing = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "p").when(F.col("id") % 5 > 0, F.concat(F.lit("q"), F.col("id") % 7)).alias("PROVNUM"),
        F.concat(F.lit("202401"), 10 + F.col("id") % 20).alias("WorkDate"),
        F.lit("7").alias("MDScensus"),
        *[(F.col("id") % (h + 2)).cast("decimal(18,2)").alias(c) for h, c in enumerate(silver.FACT_MEASURES.values())],
    )
    by_provider = silver.fact_stage(staffing, keys=silver.PROVIDER_KEY)
    sums = by_provider.groupBy("ccn", "staffingtypeid").agg(F.sum("workhours"))
    assert sums._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    expected = rows(silver.fact_stage(staffing))
    assert rows(by_provider) == expected
    found = skew.hot_key_hashes(staffing.select(F.col("PROVNUM").alias("ccn")), silver.PROVIDER_KEY, min_rows=100)
    assert len(found) == 1
    assert rows(silver.fact_stage(staffing, hot=found, keys=silver.PROVIDER_KEY)) == expected


def test_the_gold_query_shuffles_its_fact_once(spark):
    from lodestrata.queries import inputs

    fact = inputs.fact(spark, "/root/testdata/sf0.001")
    by_month = fact.groupBy("ccn", "staffingtypeid", F.substring("workdateid", 1, 6)).agg(F.sum("workhours"))
    assert by_month._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
