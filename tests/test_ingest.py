import datetime

import pytest
from pyspark.sql import functions as F

from layouts import layout

from lodestrata.sources import ingest, listing
from lodestrata.sources.ingest import Bronze
from lodestrata.sources.listing import NoNewFilesError, Route, UnroutedFileError
from lodestrata.streaming.arrivals import ingest_stream

SCHEMA = layout("id int; name string")


@pytest.fixture
def bronze(tmp_path):
    return Bronze(str(tmp_path / "bronze"), [Route("A_", "alpha", SCHEMA), Route("b", "beta", SCHEMA)])


@pytest.fixture
def drop(tmp_path):
    def _drop(name, *ids):
        path = tmp_path / "landing" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("id,name\n" + "".join(f"{i},n{i}\n" for i in ids))
        return str(tmp_path / "landing")

    return _drop


def ids(spark, bronze, table):
    return sorted(r["id"] for r in bronze.table(spark, table).collect())


def manifest(spark, bronze):
    return sorted((r["filename"], r["table_name"]) for r in bronze.manifest(spark).collect())


@pytest.mark.parametrize(
    ("name", "table"),
    [
        ("a_1.csv", "alpha"),
        ("A_x.csv", "alpha"),
        ("Ax.csv", None),
        ("BETA.csv", "beta"),
        ("xa_1.csv", None),
    ],
)
def test_route_by_prefix_in_any_case(spark, name, table):
    column = listing.routed_table(F.lit(name), [("A_", "alpha"), ("b", "beta")])
    assert spark.range(1).select(column).first()[0] == table


def test_first_fitting_route_wins(spark):
    column = listing.routed_table(F.lit("ab.csv"), [("a", "first"), ("ab", "second")])
    assert spark.range(1).select(column).first()[0] == "first"


def test_unmatched_name_raises_on_request(spark):
    column = listing.routed_table(F.lit("x.csv"), [("a", "alpha")], "raise")
    with pytest.raises(Exception, match="No matching table for file: x.csv"):
        spark.range(1).select(column).collect()


def test_listing_opens_no_file_and_filters_the_suffix(spark, drop):
    drop("A_1.csv", 1)
    drop("deep/er/A_2.csv", 2)
    root = drop("A_3.CSV", 3)
    files = listing.list_files(spark, root, ".csv")
    assert files.columns == ["path", "length", "modificationTime"]
    assert sorted(r["path"].rsplit("/", 1)[1] for r in files.collect()) == ["A_1.csv", "A_2.csv"]


def test_load_records_and_repeats_nothing(spark, bronze, drop):
    drop("A_1.csv", 1, 2)
    root = drop("B.csv", 9)
    when = F.lit(datetime.datetime(2026, 1, 1))
    assert ingest.ingest_folder(spark, bronze, root, load_time=when) == 2
    assert ids(spark, bronze, "alpha") == [1, 2]
    assert ids(spark, bronze, "beta") == [9]
    assert manifest(spark, bronze) == [("A_1.csv", "alpha"), ("B.csv", "beta")]
    assert bronze.manifest(spark).select("load_time").distinct().first()[0] == datetime.datetime(2026, 1, 1)

    with pytest.raises(NoNewFilesError, match="No new files"):
        ingest.ingest_folder(spark, bronze, root)
    assert ingest.ingest_folder(spark, bronze, root, on_empty="skip") == 0

    drop("A_4.csv", 4)
    assert ingest.ingest_folder(spark, bronze, root) == 1
    assert ids(spark, bronze, "alpha") == [1, 2, 4]


def test_empty_listing_is_an_error_too(spark, bronze, tmp_path):
    (tmp_path / "nothing").mkdir()
    with pytest.raises(NoNewFilesError):
        ingest.ingest_folder(spark, bronze, str(tmp_path / "nothing"))


def test_unknown_name_stops_before_any_load(spark, bronze, drop):
    drop("A_1.csv", 1)
    root = drop("other.csv", 2)
    with pytest.raises(UnroutedFileError, match="other.csv"):
        ingest.ingest_folder(spark, bronze, root)
    assert ids(spark, bronze, "alpha") == []
    assert manifest(spark, bronze) == []


@pytest.mark.parametrize("files_per_load", [1, 2, 100])
def test_equal_names_that_arrive_together_both_load(spark, bronze, drop, files_per_load):
    drop("x/A_1.csv", 1)
    drop("y/A_1.csv", 2)
    drop("z/A_1.csv", 3)
    root = drop("A_2.csv", 4)
    assert ingest.ingest_folder(spark, bronze, root, files_per_load=files_per_load) == 4
    assert ids(spark, bronze, "alpha") == [1, 2, 3, 4]
    assert manifest(spark, bronze) == [("A_1.csv", "alpha"), ("A_2.csv", "alpha")]


def test_known_name_in_another_folder_counts_as_loaded(spark, bronze, drop):
    root = drop("x/A_1.csv", 1)
    ingest.ingest_folder(spark, bronze, root)
    drop("y/A_1.csv", 2)
    assert ingest.ingest_folder(spark, bronze, root, on_empty="skip") == 0


def test_load_without_record_is_repeated_without_doubling(spark, bronze, drop, monkeypatch):
    root = drop("A_1.csv", 1, 2)

    def lost(*_args, **_kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "record_files", lost)
        with pytest.raises(RuntimeError):
            ingest.ingest_folder(spark, bronze, root)
    assert ids(spark, bronze, "alpha") == [1, 2]
    assert ingest.ingest_folder(spark, bronze, root) == 1
    assert ids(spark, bronze, "alpha") == [1, 2]


def test_bad_value_leaves_bronze_and_manifest_alone(spark, bronze, drop, tmp_path):
    root = drop("A_1.csv", 1)
    (tmp_path / "landing" / "A_2.csv").write_text("id,name\nnope,x\n")
    with pytest.raises(Exception, match="unreadable value in id, file A_2.csv"):
        ingest.ingest_folder(spark, bronze, root)
    assert ids(spark, bronze, "alpha") == []
    assert manifest(spark, bronze) == []


def test_wildcards_in_a_name_are_literal(spark, bronze, drop):
    drop("A_[1].csv", 1)
    root = drop("A_1.csv", 2)
    ingest.ingest_folder(spark, bronze, root)
    assert ids(spark, bronze, "alpha") == [1, 2]


def test_bronze_reads_only_the_files_asked_for(spark, bronze, drop):
    drop("A_1.csv", 1)
    root = drop("A_2.csv", 2)
    ingest.ingest_folder(spark, bronze, root)
    assert [r["id"] for r in bronze.table(spark, "alpha", ["A_2.csv"]).collect()] == [2]


def test_counts_of_new_and_known_add_up(spark):
    files = spark.createDataFrame([(f"d/{i % 7}/{i}.csv",) for i in range(100)], "path string")
    known = spark.createDataFrame([(f"{i}.csv",) for i in range(0, 150, 3)], "filename string")
    new = listing.new_files(files, known).count()
    assert new == sum(1 for i in range(100) if i % 3)


def test_landing_difference(spark):
    source = spark.createDataFrame(
        [("a.csv", "text/csv"), ("b.csv", "text/csv"), ("c.txt", "text/plain")], "filename string, mime_type string"
    )
    due = listing.due_files(source, spark.createDataFrame([("b.csv",)], "filename string"))
    assert [r["filename"] for r in due.collect()] == ["a.csv"]
    assert tuple(listing.sync_summary(due).first()) == ("success", 1)


def test_landing_difference_of_one_folder(spark, rows):
    kinds = [("a.csv", "in", "text/csv"), ("b.csv", "in", "text/csv"), ("c.csv", "out", "text/csv"), ("d.csv", None, "text/csv"),
             ("e.txt", "in", "text/plain")]
    source = spark.createDataFrame(kinds, "filename string, folder string, mime_type string")
    landed = spark.createDataFrame([("b.csv",)], "filename string")
    assert rows(listing.due_files(source, landed, folder="in"), "filename") == [("a.csv",)]
    assert rows(listing.due_files(source, landed, mime_type=None, folder="in"), "filename") == [("a.csv",), ("e.txt",)]
    assert rows(listing.due_files(source, landed, folder="none")) == []


def test_stream_loads_each_drop_once(spark, bronze, drop, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    root = drop("A_1.csv", 1)

    def run():
        ingest_stream(spark, bronze, root, checkpoint, files_per_trigger=1).awaitTermination()

    run()
    run()
    assert ids(spark, bronze, "alpha") == [1]
    drop("A_2.csv", 2)
    drop("later/B_1.csv", 3)
    drop("later/A_1.csv", 99)  # a known name in another folder: the manifest decides
    run()
    assert ids(spark, bronze, "alpha") == [1, 2]
    assert ids(spark, bronze, "beta") == [3]


def test_stream_with_a_lost_checkpoint_loads_nothing_twice(spark, bronze, drop, tmp_path):
    root = drop("A_1.csv", 1)
    for attempt in range(2):
        ingest_stream(spark, bronze, root, str(tmp_path / f"checkpoint{attempt}")).awaitTermination()
    assert ids(spark, bronze, "alpha") == [1]


@pytest.mark.parametrize("limit", [None, "60000"])
@pytest.mark.parametrize("fails", [False, True])
def test_files_load_in_methods_that_the_jvm_compiles(spark, bronze, drop, monkeypatch, limit, fails):
    """The limit holds for the load only, whatever it was before and however the load ends."""
    key, seen = "spark.sql.codegen.hugeMethodLimit", []

    def write(df, *_args):
        seen.append(df.sparkSession.conf.get(key))
        if fails:
            raise OSError("full")

    monkeypatch.setattr(ingest, "replace_partitions", write)
    standard = spark.conf.get(key)
    if limit is not None:
        spark.conf.set(key, limit)
    try:
        landing = drop("A_1.csv", 1)
        if fails:
            with pytest.raises(OSError, match="full"):
                ingest.ingest_folder(spark, bronze, landing)
        else:
            ingest.ingest_folder(spark, bronze, landing)
        assert seen == ["8000"]
        assert spark.conf.get(key) == (limit or standard)
    finally:
        spark.conf.unset(key)
