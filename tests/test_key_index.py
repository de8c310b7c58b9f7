import random

import pytest

from lodestrata.sources.key_index import FILTER, KeyIndex
from lodestrata.sources.ledger import ConflictError, Ledger

SCHEMA = "a long, b string"


@pytest.fixture
def index(tmp_path):
    return KeyIndex(Ledger(str(tmp_path / "warehouse")), "t", ["a", "b"], parts=4, blocks=64)


def drop(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def found(spark, index, *rows):
    return {(r["a"], r["b"]): (r["copies"], r["stored"], r["violations"]) for r in index.load(spark, drop(spark, *rows)).collect()}


def stored_keys(spark, index):
    own = index._tables[0]
    return sorted(map(str, index.ledger.read(spark, own, drop(spark).schema).collect()))


def test_drops_are_told_from_what_is_stored(spark, index):
    assert found(spark, index, (1, "x"), (2, "x"), (2, "x"), (None, "x")) == {(2, "x"): (2, False, 1)}
    assert found(spark, index, (1, "x"), (3, "x"), (None, "x"), (1, None)) == {(1, "x"): (1, True, 1), (None, "x"): (1, True, 1)}
    assert found(spark, index) == {}
    assert found(spark, index, (1, None), (3, "x"), (3, "x")) == {(1, None): (1, True, 1), (3, "x"): (2, True, 2)}
    keys = stored_keys(spark, index)
    assert len(keys) == len(set(keys)) == 5


def test_drops_equal_plain_counting(spark, index):
    rng, stored = random.Random(7), set()
    for _ in range(3):
        rows = [(rng.choice([None, *range(40)]), rng.choice([None, "p", "q"])) for _ in range(60)]
        wanted = {k: (rows.count(k), k in stored, rows.count(k) - 1 + (k in stored)) for k in set(rows)}
        assert found(spark, index, *rows) == {k: v for k, v in wanted.items() if v[2]}
        stored |= set(rows)
    assert len(stored_keys(spark, index)) == len(stored)


def test_a_false_hit_of_the_filter_is_not_reported(spark, tmp_path):
    """One block for all keys: it soon has every bit, so every key is a possible hit."""
    index = KeyIndex(Ledger(str(tmp_path / "warehouse")), "t", ["a", "b"], parts=1, blocks=1)
    assert found(spark, index, *[(i, "x") for i in range(200)]) == {}
    marks = index.ledger.read(spark, index._tables[1], FILTER).collect()
    assert [r["index_mask"] for r in marks] == [-1]
    assert found(spark, index, *[(i, "x") for i in range(199, 260)]) == {(199, "x"): (1, True, 1)}


def test_partitions_without_a_possible_hit_are_not_read(spark, index, monkeypatch):
    found(spark, index, *[(i, "x") for i in range(30)])
    read = []
    own = Ledger.rows

    def watched(self, spark, state, table, schema, column=None, values=None):
        read.append((table, values))
        return own(self, spark, state, table, schema, column, values)

    monkeypatch.setattr(Ledger, "rows", watched)
    assert found(spark, index, (5, "x")) == {(5, "x"): (1, True, 1)}
    assert [len(values) for table, values in read if table == index._tables[0]] == [1]


def test_two_loads_at_once(spark, index, monkeypatch):
    found(spark, index, (1, "x"))
    begin = Ledger.begin

    def overtaken(self, spark):
        commit = begin(self, spark)
        monkeypatch.setattr(Ledger, "begin", begin)
        found(spark, index, (2, "x"))
        return commit

    monkeypatch.setattr(Ledger, "begin", overtaken)
    with pytest.raises(ConflictError):
        index.load(spark, drop(spark, (3, "x")))
    assert len(stored_keys(spark, index)) == 2


def test_names_of_the_result_are_no_keys(spark, tmp_path):
    with pytest.raises(ValueError, match="copies"):
        KeyIndex(Ledger(str(tmp_path)), "t", ["copies"]).load(spark, spark.createDataFrame([(1,)], "copies int"))
