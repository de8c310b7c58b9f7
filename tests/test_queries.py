"""Every registered query against its SQL on the smallest tables."""

import pytest

from oracle_check import connect, differences

import __spark_entry__ as entry_point

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_its_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(entry_point.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    assert differences(entry_point.queries()[name](spark, SF_DIR), duck, entry_point.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["fact_upsert", "fact_unpivot_union", "gold_utilization"])
def test_results_do_not_depend_on_which_keys_are_hot(spark, duck, monkeypatch, name):
    """With every repeated provider day taken as hot the split really happens, and the result is the same."""
    from lodestrata.operators import skew
    from lodestrata.plans import silver

    seen = []

    def eager(df, keys):
        found = [r[0] for r in df.groupBy(skew.key_hash(keys)).count().where("count > 1").limit(300).collect()]
        seen.append(len(found))
        return found

    monkeypatch.setattr(silver, "hot_key_hashes", eager)
    assert differences(entry_point.queries()[name](spark, SF_DIR), duck, entry_point.oracle_sql()[name]) == []
    assert max(seen) > 0
