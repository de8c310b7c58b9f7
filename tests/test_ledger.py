import random
import threading

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import maintained
from lodestrata.sources.ledger import ConflictError, Ledger, last_rows

SCHEMA = "id long, p string"


@pytest.fixture
def ledger(tmp_path):
    return Ledger(str(tmp_path / "warehouse"))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def put(spark, ledger, *rows, **options):
    commit = ledger.begin(spark)
    commit.replace_partitions(frame(spark, *rows), "t", "p", **options)
    return commit.commit()


def test_nothing_is_visible_before_the_commit(spark, ledger, rows):
    schema = frame(spark).schema
    assert ledger.read(spark, "t", schema).count() == 0 and ledger.numbers(spark) == []
    commit = ledger.begin(spark)
    commit.replace_partitions(frame(spark, (1, "a"), (2, "b")), "t", "p")
    commit.replace(frame(spark, (9, "x")), "u")
    assert ledger.read(spark, "t", schema).count() == 0 and commit.read("t", schema).count() == 2
    assert commit.commit() == 1
    assert rows(ledger.read(spark, "t", schema)) == [(1, "a"), (2, "b")] and ledger.read(spark, "u", schema).count() == 1


def test_partitions_versions_and_the_past(spark, ledger, rows):
    schema = frame(spark).schema
    odd = "a/b=c d%ß"
    put(spark, ledger, (1, "a"), (2, odd), (3, None))
    put(spark, ledger, (4, odd), (5, "new"))
    put(spark, ledger, (6, "a"), emptied=[None, "never there"])
    assert rows(ledger.read(spark, "t", schema)) == sorted([(4, odd), (5, "new"), (6, "a")], key=str)
    assert rows(last_rows(ledger, spark, "t", schema, back=2)) == [(1, "a"), (2, odd), (3, None)]
    state = ledger.state(spark, 2)
    assert rows(ledger.rows(spark, state, "t", schema, "p", [odd, None, "absent"])) == [(3, None), (4, odd)]
    put(spark, ledger, (7, "only"), emptied=None)
    assert rows(ledger.read(spark, "t", schema)) == [(7, "only")]


def test_a_table_can_be_replaced_by_a_query_on_itself(spark, ledger):
    schema = frame(spark).schema
    for n in range(1, 4):
        commit = ledger.begin(spark)
        commit.replace(commit.read("t", schema).unionByName(frame(spark, (n, "a"))), "t")
        commit.append(frame(spark, (n, "b")), "log")
        commit.commit()
        assert ledger.read(spark, "t", schema).count() == ledger.read(spark, "log", schema).count() == n


def test_of_two_writers_the_later_gets_an_error_and_leaves_nothing(spark, ledger, rows, tmp_path):
    schema = frame(spark).schema
    put(spark, ledger, (1, "a"))
    one, other = ledger.begin(spark), ledger.begin(spark)
    one.replace_partitions(frame(spark, (2, "a")), "t", "p")
    other.replace_partitions(frame(spark, (3, "b")), "t", "p")
    one.commit()
    with pytest.raises(ConflictError):
        other.commit()
    assert rows(ledger.read(spark, "t", schema)) == [(2, "a")]
    assert len(list((tmp_path / "warehouse" / "t").iterdir())) == 2
    assert not [f.name for f in (tmp_path / "warehouse" / "_log").iterdir() if "draft" in f.name and not f.name.endswith(".crc")]


def test_many_writers_at_once_lose_no_commit(spark, ledger):
    """Each tries again after a conflict; every row is there in the end."""
    schema = frame(spark).schema

    def write(n):
        while True:
            commit = ledger.begin(spark)
            commit.append(frame(spark, (n, "a")), "t")
            try:
                return commit.commit()
            except ConflictError:
                continue

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert sorted(r["id"] for r in ledger.read(spark, "t", schema).collect()) == [0, 1, 2, 3]
    assert ledger.numbers(spark) == [1, 2, 3, 4]


def test_vacuum_keeps_what_kept_entries_name(spark, ledger, rows, tmp_path):
    schema = frame(spark).schema
    for n in range(4):
        put(spark, ledger, (n, "a"), *([(10, "b")] if n == 0 else []))
    orphan = ledger.begin(spark)
    orphan.replace(frame(spark, (99, "x")), "t")
    # The first version still holds partition b; the second is past, and the orphan may be a run under way.
    assert ledger.vacuum(spark, keep=2) == 1
    assert ledger.numbers(spark) == [3, 4]
    assert rows(ledger.read(spark, "t", schema)) == [(10, "b"), (3, "a")] and rows(last_rows(ledger, spark, "t", schema)) == [(10, "b"), (2, "a")]
    assert ledger.vacuum(spark, keep=2, orphan_seconds=-1) == 1
    assert len(list((tmp_path / "warehouse" / "t").iterdir())) == 3


# Maintained aggregates ------------------------------------------------------------------------------------------------

KEYS, VALUES = ["k"], ["v", "w"]
FACT = "id long, k string, v decimal(18,2), w bigint"


def test_state_follows_added_changed_and_withdrawn_rows(spark, rows):
    """A random walk: the maintained state is always the aggregate of the rows that are there."""
    pick = random.Random(4)
    content, state = {}, maintained.state(spark.createDataFrame([], FACT), KEYS, VALUES)
    for _ in range(5):
        before = dict(content)
        for _ in range(12):
            n = pick.randrange(15)
            if pick.random() < 0.35:
                content.pop(n, None)
            else:
                content[n] = (n, pick.choice(["a", "b", "c", None]), pick.choice([None, 0, 1, -2]), pick.choice([None, 0, 5]))
        frames = [
            spark.createDataFrame(list(c.values()), "id long, k string, v long, w bigint").withColumn("v", F.col("v").cast("decimal(18,2)"))
            for c in (before, content)
        ]
        change = maintained.delta(*frames, KEYS, VALUES)
        state = spark.createDataFrame(maintained.applied(state, change, KEYS, VALUES).collect(), state.schema)
        shown = state.select("k", maintained.total("v"), maintained.total("w"), "w_n", "rows")
        plain = frames[1].groupBy("k").agg(F.sum("v"), F.sum("w"), F.count("w"), F.count("*"))
        assert rows(shown) == rows(plain)


def test_unchanged_rows_leave_no_delta(spark):
    df = spark.createDataFrame([(1, "a", None, 2), (2, None, None, None)], "id long, k string, v decimal(18,2), w bigint")
    assert maintained.delta(df, df, KEYS, VALUES).count() == 0
