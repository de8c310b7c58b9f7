"""Filter interaction audit over a sparse document-term matrix.

Words (maximal runs of bytes other than blank, tab, line ends, vertical tab and form feed; case counts) are encoded by one
dictionary for the whole corpus: a word's column is its 64-bit name, and a pass over the distinct words verifies that no
two of them share it. Those that do (none, as a rule: V words have V^2 / 2^65 such pairs by chance) get columns of their own,
which are few enough to be sent to all tasks. So a shard, a run of documents of about `SHARD_BYTES`, builds its part of the
matrix in CSR form with the columns of the whole corpus where it lies: the matrix is never shuffled, only distinct words are.

Row sums (words) and nonzero counts (distinct words) of the shards decide filters A and B. Three more flags are attached:

A under 50 words; B 100 * distinct words < 65 * words; C 100 * letters A to Z > 5 * code points; D any of # $ % & * |;
E the same text as a document with a smaller id, removed or not.

All orders of the five filters are then told from one small table: documents by part and set of failed filters (32 at most).

Null and empty texts are the same text without words: they fail A, and E if repeated. Rows that repeat a text under one id do
not fail E by each other; a null id is smaller than no other and no other is smaller than it. Every row is a document. A
document is good or toxic if any of its labels says so. Null parts count as ''. Texts are compared by their SHA-256. A very
long text is a shard of its own and worked on whole, in some twenty times its bytes. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import ship, stored
from .text import Texts, byte_class, column_texts, pieces, prefix_sums, span_names, word_codes

SHARD_BYTES = 4 << 20
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5

NOT_BLANK = ~byte_class((0x20, 0x20), (0x09, 0x0D))
CAPITALS = byte_class((0x41, 0x5A))
CHARACTERS = ~byte_class((0x80, 0xBF))
SIGNS = byte_class(*((b, b) for b in b"#$%&*|"))

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in itertools.permutations(FILTERS)]


def names_of(words: pa.Array) -> np.ndarray:
    """The 64-bit name of each word."""
    data, bounds = column_texts(words)
    return span_names(prefix_sums(data), bounds[:-1], bounds[1:])


class Csr(NamedTuple):
    """Row i has the columns indices[indptr[i]:indptr[i + 1]], each as often as `data` says."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray

    def row_sums(self) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(self.data)))[self.indptr])

    def nonzeros(self) -> np.ndarray:
        return np.diff(self.indptr)


def shard(texts: Texts, exceptions: dict[bytes, int], name=names_of) -> Csr:
    """The rows of the matrix for some texts; `exceptions` are words whose column is not their name."""
    words, codes, distinct = word_codes(texts, NOT_BLANK)
    columns = name(distinct)
    if exceptions:
        other = [exceptions.get(w.as_py()) for w in distinct]
        columns = np.array([c if o is None else o for c, o in zip(columns, other, strict=True)], np.uint64)
    many = max(len(distinct), 1)
    cells, counts = np.unique(words.text_of() * many + codes, return_counts=True)
    indptr = np.searchsorted(cells // many, np.arange(len(texts.offsets)))
    return Csr(indptr, columns[cells % many], counts)


def dictionary(rows: DataFrame, name=names_of) -> DataFrame:
    """(word, name) of every distinct word of the corpus, made distinct per shard and per task before the shuffle."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, piece in pieces(column_texts(batch.column("text")), SHARD_BYTES):
                _, _, found = word_codes(piece, NOT_BLANK)
                yield pa.RecordBatch.from_arrays([found.cast(pa.binary()), pa.array(name(found).view(np.int64))], names=["word", "name"])

    return rows.select("text").mapInArrow(distinct, "word binary, name long").distinct()


def own_columns(words: DataFrame) -> dict[bytes, int]:
    """The words that share a name with another, each with a column that no name takes: no two words have one column.

    Two names of 2^64 meet by chance only, so the list is far below a row per million words. The free columns are found
    among the first numbers: at most as many of them are names as there are words below, which one look at them tells.
    """
    shared = words.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    rivals = sorted(bytes(r["word"]) for r in words.join(shared, "name", "left_semi").select("word").toLocalIterator())
    if not rivals:
        return {}
    span = 2 * len(rivals)
    while True:
        taken = {r["name"] for r in words.where(F.col("name").between(0, span)).select("name").distinct().collect()}
        free = [c for c in range(span) if c not in taken]
        if len(free) >= len(rivals):
            return dict(zip(rivals, free, strict=False))
        span *= 2


ROW = "part string, digest binary, fails int, n_words long, n_distinct long"


def flagged(docs: DataFrame, id_col: str, text_col: str, part_col: str, name=names_of) -> DataFrame:
    """Per document its id, part, the digest of its text, words, distinct words, and the filters A to D that it fails, as
    bits 1, 2, 4 and 8."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("text")
    )
    exceptions = docs.sparkSession.sparkContext.broadcast(own_columns(stored(dictionary(rows, name), "dictionary")))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, piece in pieces(column_texts(batch.column("text")), SHARD_BYTES):
                matrix = shard(piece, exceptions.value, name)
                words, distinct = matrix.row_sums(), matrix.nonzeros()
                capitals, characters, signs = (
                    np.diff(np.concatenate(([0], np.cumsum(table[piece.data])))[piece.offsets]) for table in (CAPITALS, CHARACTERS, SIGNS)
                )
                failed = [words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * words, 100 * capitals > MOST_CAPITALS * characters, signs > 0]
                data = piece.data.tobytes()
                digests = [hashlib.sha256(data[a:b]).digest() for a, b in itertools.pairwise(piece.offsets)]
                own = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("id"),
                        own.column("part"),
                        pa.array(digests, pa.binary()),
                        pa.array(sum(f.astype(np.int32) << k for k, f in enumerate(failed)), pa.int32()),
                        pa.array(words, pa.int64()),
                        pa.array(distinct, pa.int64()),
                    ],
                    names=["id", "part", "digest", "fails", "n_words", "n_distinct"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(judge, f"id {kind}, {ROW}")


def failures(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", name=names_of
) -> DataFrame:
    """(part, fails, n, good, toxic): documents by part and set of failed filters, E being bit 16."""
    rows = stored(flagged(docs, id_col, text_col, part_col, name), "flags")
    copies = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    # As structs, so that the copies of one text meet in a join whose large keys Spark may split.
    copies = copies.select(F.struct("digest").alias("key"), "first")
    rows = rows.withColumn("key", F.struct("digest")).join(copies, "key", "left")
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        *[F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))]
    )
    rows = rows.select("id", "part", F.expr("fails + CASE WHEN id > first THEN 16 ELSE 0 END").alias("fails")).join(marks, "id", "left")
    return rows.groupBy("part", "fails").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")).fillna(
        0, ["good", "toxic"]
    )


def _total(field: str, holds) -> Column:
    return F.aggregate(
        "sets", F.lit(0).cast("long"), lambda sum_, s: sum_ + F.when(holds(s["fails"]), s[field]).otherwise(F.lit(0)).cast("long")
    )


def interactions(counted: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: what stays, goes and is lost, from documents by set of failed filters."""
    sets = counted.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("sets"))
    steps = sets.withColumn("filter_order", F.explode(F.lit(ORDERS))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def bits(letters: Column) -> Column:
        return sum((F.contains(letters, F.lit(f)).cast("int") * (1 << k) for k, f in enumerate(FILTERS)), F.lit(0))

    steps = steps.withColumn("own", bits(F.expr("substring(filter_order, step, 1)")))
    steps = steps.withColumn("before", bits(F.expr("substring(filter_order, 1, step - 1)")))
    fails_own = lambda f: f.bitwiseAND(F.col("own")) != 0
    gone = lambda f: f.bitwiseAND(F.col("before")) != 0
    here = lambda f: fails_own(f) & ~gone(f)
    # Of a document's k failed filters, each comes first in one k-th of all orders.
    first = F.aggregate(
        "sets", F.lit(0).cast("long"),
        lambda sum_, s: sum_ + F.when(fails_own(s["fails"]), F.try_divide(s["n"] * len(ORDERS), F.bit_count(s["fails"])).cast("long")).otherwise(F.lit(0)).cast("long"),
    )
    return steps.select(
        "part",
        "filter_order",
        "step",
        _total("n", lambda f: f.bitwiseAND(F.col("before").bitwiseOR(F.col("own"))) == 0).alias("kept"),
        _total("n", here).alias("removed"),
        _total("n", lambda f: fails_own(f) & gone(f)).alias("redundant"),
        _total("n", lambda f: f == F.col("own")).alias("unique_fails"),
        _total("good", here).alias("good_lost"),
        _total("toxic", here).alias("toxic_lost"),
        first.alias("shapley"),
    )


def audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """The interactions of the five filters in every part, for all their orders and steps."""
    ship(docs.sparkSession)
    return interactions(failures(docs, labels, id_col, text_col, part_col))
