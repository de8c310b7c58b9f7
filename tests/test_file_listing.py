"""The listing data source: one task per prefix, and a stream that goes on from its stored offset."""

import os
import time

import pytest
from pyspark.sql import functions as F

from lodestrata.sources import ingest, listing
from lodestrata.sources.file_listing import scan_files, stream_files
from lodestrata.streaming.arrivals import ingest_stream


def put(root, name, text="a,b\n1,x\n", age=0):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if age:
        os.utime(path, (time.time() - age,) * 2)
    return path


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    for name in ("part0.csv", "one/part1.csv", "one/deep er/part2.csv", "two/part3.CSV", "two/k=_x/part4.csv", "_tmp/part5.csv",
                 "one/.part6.csv", "one/_part7.csv"):
        put(root, name)
    return root


def test_same_files_as_the_file_source(spark, rows, landing):
    own = scan_files(spark, f"file:{landing}", ".csv")
    theirs = listing.list_files(spark, str(landing), ".csv")
    columns = ("path", "length", "modificationTime")
    assert [r[:2] for r in rows(own, *columns)] == [r[:2] for r in rows(theirs, *columns)]
    assert len(rows(own)) == 4
    # The file source cuts times to milliseconds.
    assert rows(own.select(F.date_trunc("second", "modificationTime"))) == rows(theirs.select(F.date_trunc("second", "modificationTime")))


def test_one_task_per_prefix(spark, landing):
    own = scan_files(spark, str(landing))
    assert own.rdd.getNumPartitions() == 3
    below = F.split(F.replace("path", F.lit(f"{landing}/")), "/")[0]
    per_task = own.groupBy(F.spark_partition_id()).agg(F.collect_set(below).alias("top")).collect()
    assert sorted(len(r["top"]) for r in per_task) == [1, 1, 1]


def test_named_prefixes_are_all_that_is_read(spark, rows, landing):
    named = scan_files(spark, str(landing), prefixes=["one/deep er", "two", "none"])
    assert sorted(r[0].rsplit("/", 1)[1] for r in rows(named, "path")) == ["part2.csv", "part3.CSV", "part4.csv"]


def test_empty_root_has_no_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert scan_files(spark, str(tmp_path / "empty")).isEmpty()


def test_many_files_in_several_batches(spark, tmp_path):
    root = tmp_path / "many"
    root.mkdir()
    for n in range(9000):
        (root / f"f{n}").touch()
    assert scan_files(spark, str(root)).select("path").distinct().count() == 9000


def test_stream_goes_on_from_its_offset(spark, tmp_path):
    root, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")

    def run():
        batches = []
        keep = lambda batch, _: batches.extend(r["path"].rsplit("/", 1)[1] for r in batch.collect())
        files = stream_files(spark, str(root), overlap_seconds=0)
        files.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return sorted(batches)

    put(root, "one/part0.csv", age=100)
    put(root, "part1.csv", age=50)
    assert run() == ["part0.csv", "part1.csv"]
    time.sleep(0.1)
    put(root, "two/part2.csv")
    time.sleep(0.1)
    assert run() == ["part2.csv"]
    assert run() == []


def test_overlap_repeats_files_that_the_manifest_knows(spark, rows, tmp_path):
    root, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    bronze = ingest.Bronze(str(tmp_path / "bronze"), [listing.Route("part", "rows", spark.createDataFrame([], "a INT, b STRING").schema)])
    for n in range(2):
        # The second file is older than the first run, but within the overlap.
        put(root, f"day{n}/part{n}.csv", f"a,b\n{n},x\n", age=20 * n)
        ingest_stream(spark, bronze, str(root), checkpoint, files=stream_files(spark, str(root))).awaitTermination()
    assert rows(bronze.table(spark, "rows"), "a") == [(0,), (1,)]
    assert rows(bronze.manifest(spark), "filename") == [("part0.csv",), ("part1.csv",)]
