"""Records of text files whose quoted fields may hold line breaks, read in byte ranges by many tasks.

Whether a range begins inside quotes depends on all quotes before it. A first scan therefore sums up every range for both
possibilities: how many quotes it has, odd or even, and the lines before its first and after its last record end if it began
outside quotes, and if it began inside. A running sum of the parities over the ranges of a file tells which one holds; records
that cross ranges are put together from those pieces alone. The second scan cuts each range into the records that lie in it.

Lines are never shuffled; per range one row with its two ends is. The driver gets the ranges that begin inside quotes, one
entry each, far fewer than the splits it plans anyway. A file with an unclosed quote makes one record of everything after it.
Lines end with a line feed, with or without a carriage return before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship

RANGE = ["path", "name", "start"]
ENDS = "path string, name string, start long, odd int, records0 long, records1 long, head binary, tail0 binary, tail1 binary"
RECORDS = "path string, name string, record binary"


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every line as bytes, with its file and where the range begins that it was read in."""
    meta = [F.col(f"_metadata.{c}").alias(to) for c, to in (("file_path", "path"), ("file_name", "name"), ("file_block_start", "start"))]
    return spark.read.text(list(paths), lineSep="\n").select(*meta, F.col("value").cast("binary").alias("line"))


class _Batch:
    """Lines of one range: their bytes, and whether an odd number of quotes stands before the end of each."""

    def __init__(self, lines: pa.Array, quote: int):
        lines = lines.cast(pa.large_binary())
        _, offsets, data = lines.buffers()
        bounds = np.frombuffer(offsets, np.int64)[lines.offset : lines.offset + len(lines) + 1]
        raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
        quotes = np.concatenate(([0], np.cumsum(raw == quote)))[bounds - bounds[0]]
        self.lines, self.odd = lines, (quotes[1:] % 2).astype(bool)


def _ranges(batches: Iterator[pa.RecordBatch], quote: int) -> Iterator[tuple[tuple, _Batch]]:
    """Runs of lines of one range, in order; a range may come in several runs, one after the other."""
    for batch in batches:
        names = [batch.column(c).dictionary_encode() for c in ("path", "name")]
        codes = np.stack([n.indices.to_numpy() for n in names] + [batch.column("start").to_numpy()])
        cuts = np.flatnonzero(np.any(np.diff(codes, axis=1), axis=0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if a < b:
                key = tuple(batch.column(c)[int(a)].as_py() for c in RANGE)
                yield key, _Batch(batch.column("line").slice(int(a), int(b - a)), quote)


class _Cut:
    """A range cut into records for one start state: complete records, what comes before the first end and after the last."""

    def __init__(self, inside: bool):
        self.odd, self.open, self.head, self.records = inside, [], None if inside else b"", 0

    def feed(self, run: _Batch) -> list[bytes]:
        """The records that end in this run."""
        ends = np.flatnonzero(run.odd == self.odd)
        done, start = [], 0
        for end in ends:
            own = [line.as_py() for line in run.lines.slice(start, int(end) - start + 1)]
            record = b"\n".join([*self.open, *own])
            self.open, start = [], int(end) + 1
            if self.head is None:
                self.head = record
            else:
                done.append(record)
        self.open += [line.as_py() for line in run.lines.slice(start)]
        self.odd ^= bool(run.odd[-1])
        self.records += len(done)
        return done


def _ends(batches: Iterator[pa.RecordBatch], quote: int) -> Iterator[pa.RecordBatch]:
    """One row for each range."""
    rows, key, cuts = [], None, []

    def row() -> tuple:
        outside, inside = cuts
        tails = [b"\n".join(c.open) if c.open else None for c in cuts]
        # Without any end the whole range goes on from the one before to the one after.
        return (*key, int(outside.odd), outside.records, inside.records, inside.head, *tails)

    for now, run in _ranges(batches, quote):
        if now != key:
            if key is not None:
                rows.append(row())
            key, cuts = now, [_Cut(False), _Cut(True)]
        for cut in cuts:
            cut.feed(run)
    if key is not None:
        rows.append(row())
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.split(" ")[0] for c in ENDS.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def range_ends(lines: DataFrame, quote: str) -> DataFrame:
    """Every range with its ends for the state in which it really begins: `inside` or not."""
    sign = ord(quote)
    found = lines.mapInArrow(lambda batches: _ends(batches, sign), ENDS)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    pick = lambda one, other: F.when(F.col("inside"), one).otherwise(other)
    return found.select(*RANGE, "inside", pick(F.col("records1"), F.col("records0")).alias("records"),
                        pick(F.col("head"), F.lit(None)).alias("head"), pick(F.col("tail1"), F.col("tail0")).alias("tail"))


def crossing(ends: DataFrame) -> DataFrame:
    """The records that cross ranges: the tail of one, whatever whole ranges follow, and the head of the last.

    `header` marks the one that opens its file.
    """
    parts = ends.select("path", "name", "start", "records", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("head").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("tail").alias("text"))
    )).alias("part"), "inside", "head").where("part.text IS NOT NULL")
    # A tail opens a record, but for that of a range that has no end at all: it carries on what is open.
    opens = (F.col("part.kind") == 1) & ~(F.col("inside") & F.col("head").isNull())
    order = Window.partitionBy("path").orderBy("start", "part.kind")
    numbered = parts.withColumn("number", F.sum(opens.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    gathered = numbered.groupBy("path", "name", "number").agg(
        F.array_sort(F.collect_list(F.struct("start", "part.kind", "part.text"))).alias("parts"),
        F.bool_or((F.col("start") == 0) & (F.col("records") == 0) & (F.col("part.kind") == 1)).alias("header"),
    )
    text = F.array_join(F.transform("parts", lambda p: F.decode(p["text"], "ISO-8859-1")), "\n")
    return gathered.select("path", "name", text.alias("record"), "header")


def _inner(batches: Iterator[pa.RecordBatch], quote: int, inside: set) -> Iterator[pa.RecordBatch]:
    """The records that lie in one range each, without the first of every file."""
    key, cut, header = None, None, False
    for now, run in _ranges(batches, quote):
        if now != key:
            key, cut = now, _Cut((now[0], now[2]) in inside)
            header = now[2] == 0
        found = cut.feed(run)
        if header and found:
            found, header = found[1:], False
        columns = [pa.array([v] * len(found), pa.string()) for v in key[:2]] + [pa.array(found, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["path", "name", "record"])


def records(spark: SparkSession, paths: Sequence[str], quote: str = '"') -> DataFrame:
    """(path, name, record): every record but the first of each file, one character per byte."""
    ship(spark)
    lines, sign = lines_of(spark, paths), ord(quote)
    ends = range_ends(lines, quote)
    inside = spark.sparkContext.broadcast({(r["path"], r["start"]) for r in ends.where("inside").select("path", "start").collect()})
    own = lines.mapInArrow(lambda batches: _inner(batches, sign, inside.value), RECORDS)
    own = own.select("path", "name", F.decode("record", "ISO-8859-1").alias("record"))
    return own.unionByName(crossing(ends).where("NOT header").drop("header"))


def without_return(record: Column) -> Column:
    """The record less the carriage return of its line end."""
    return F.regexp_replace(record, r"\r\z", "")
