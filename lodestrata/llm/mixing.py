"""Mixing sources to target weights by systematic sampling.

A document's size is its words (maximal runs of characters other than blank, tab, line ends, vertical tab and form feed).
Sources, in the order of their code points and null last, have the weights 3, 1, 2 in turn and share `SHARE` of all sizes;
no target is above `MOST` times its source's size, and what is above is shared anew by weight until none is.

Every document of a source is expected target / size times. Documents stand in the order of their sizes (ties by a hash
of the id, then the id); their expected copies are summed up in that order, one offset, drawn by hash from the seed, is added
per source, and a document is emitted once for each integer that its sum crosses. So each is taken as often as expected,
rounded up or down, and what a source yields is off its target by about one of its largest documents at most.

Places in the order are numbered without a window over a source: a range shuffle of (source, size, id) sorts them, Spark's
running row numbers count inside each partition, and the few (partition, source) counts give what stands before. Sources are
numbered in the same way. Equal ids with equal sizes take neighbouring places; which of them is taken is as good as the other.

Null and empty texts have size 0 and are expected as often as all others of their source, taking no words. A source of size 0
has the target 0 and yields nothing. A null id is an id like any other. Reruns agree, however the rows are dealt out. An
empty table gives an empty result. Other columns are carried by `mix` and ignored by `plan`. Texts are read by regular
expressions of Spark in one pass, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = "mix"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """`rows` with `place`, from 1 on in every group, in the order of `order`; no task holds a group.

    Written before it is read, since the bounds of the ranges are not the same in every computation.
    """
    keys = [F.asc_nulls_last(c) for c in (*group, *order)]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__row", F.monotonically_increasing_id())
    sorted_ = stored(sorted_, "sorted").withColumn("__part", F.shiftright("__row", 33))
    counts = sorted_.groupBy("__part", *group).agg(F.count("*").alias("__n"), F.min("__row").alias("__first"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    named = {c: f"__of_{c}" for c in ("__part", *group)}
    counts = counts.withColumnsRenamed(named)
    joined = sorted_.join(counts, [F.col(c).eqNullSafe(F.col(of)) for c, of in named.items()])
    return joined.select(*rows.columns, F.expr("__row - __first + __before + 1").alias("place"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size); the driver sees only sums.

    Each round shares what is left among the sources that are not at their limit yet; a round that puts no other there
    ends it.
    """
    placed = numbered(sources, [], ["source"])
    turn = (F.col("place") - 1) % len(weights)
    weight = F.element_at(F.lit(list(weights)), (turn + 1).cast("int")).cast("double")
    placed = stored(placed.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("most")), "sources")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    full, level = F.lit(False), 0.0
    sums = placed.agg(F.sum("weight"), F.lit(0.0), F.lit(0)).first()
    while True:
        open_weight, spent, at_limit = (x or 0 for x in sums)
        left = share * total - spent
        if not open_weight or left <= 0:
            break
        # weight * left / open weight; kept as a fraction, so that the result is rounded once.
        level = F.col("weight") * F.lit(left) / F.lit(open_weight)
        full = F.col("most") <= level
        sums = placed.agg(F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, F.col("most"))), F.count(F.when(full, 1))).first()
        if sums[2] == at_limit:
            break
    target = F.when(full, F.col("most")).otherwise(level)
    return placed.select("source", "source_size", target.cast("double").alias("target"))


def plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED,
) -> DataFrame:
    """`id_col`, source, size, source_size, target and copies of every document."""
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size_of(F.col(text_col)).alias("size"))
    sized = stored(sized, "sizes")
    aims = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    aims = aims.withColumn("expected", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)))
    # 52 bits of a digest: exact as a double.
    digits = F.substring(F.md5(F.concat_ws("/", F.lit(seed), "source")), 1, 13)
    aims = aims.withColumn("offset", F.conv(digits, 16, 10).cast("long") / float(1 << 52))
    order = sized.withColumn("tie", F.md5(F.col("id").cast("string")))
    placed = numbered(order, ["source"], ["size", "tie", "id"])
    joined = placed.join(aims.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    crossed = lambda place: F.floor(F.col("expected") * place + F.col("offset"))
    copies = crossed(F.col("place")) - crossed(F.col("place") - 1)
    return joined.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """The mixed corpus: every row of `docs` as often as it is taken. Ids must be unique and not null here."""
    copies = plan(docs, id_col, text_col, source_col, **settings).where("copies > 0").select(F.col(id_col).alias("__id"), "copies")
    taken = docs.join(copies, F.col(id_col) == F.col("__id"))
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("__id", "__copy", "copies")
