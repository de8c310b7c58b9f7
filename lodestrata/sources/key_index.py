"""Uniqueness against everything loaded before, without regrouping it.

The index holds every key once, in partition folders by hash, and a blocked filter: for each partition a fixed number of
64-bit blocks, in one of which a key sets four bits. A new drop is grouped by key on its own, its keys are looked up in the
filter, and only partitions with a possible hit are read for an exact join, so a false hit is never reported and stored keys
elsewhere are not touched. Keys and filter change in one commit of the ledger.

NULLs equal each other. The filter has at most `parts * blocks` rows, whatever the number of keys; one that has filled up
rules less out, and the exact join then reads more. An index is told apart by its name and sizes, which stay as they were made.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settled
from .ledger import Ledger

FILTER = T.StructType([T.StructField("index_part", T.IntegerType()), T.StructField("index_block", T.IntegerType()), T.StructField("index_mask", T.LongType())])
BITS = 4


@dataclass(frozen=True)
class KeyIndex:
    """The keys of one relation; `columns` names them."""

    ledger: Ledger
    name: str
    columns: Sequence[str]
    parts: int = 64
    blocks: int = 1 << 14

    @property
    def _tables(self) -> tuple[str, str]:
        label = f"{self.name}_{self.parts}_{self.blocks}"
        return f"keys_{label}", f"filter_{label}"

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows with the partition, block and bits of their key."""
        bits = [F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(index_bits, {6 * i}) & 63L AS INT))") for i in range(BITS)]
        rows = rows.withColumn("index_hash", F.xxhash64(*self.columns)).withColumn("index_bits", F.xxhash64("index_hash"))
        return rows.select(
            *[c for c in rows.columns if c != "index_bits"],
            F.pmod("index_hash", F.lit(self.parts)).cast("int").alias("index_part"),
            F.pmod(F.expr("shiftrightunsigned(index_hash, 20)"), F.lit(self.blocks)).cast("int").alias("index_block"),
            reduce(Column.bitwiseOR, bits).alias("index_mask"),
        )

    def load(self, spark: SparkSession, df: DataFrame) -> DataFrame:
        """Enter the keys of a new drop; the keys that repeat, with the number of rows the drop has of each, whether the key
        was stored before, and how many of the rows repeat an earlier one.

        `ConflictError` if another load has committed meanwhile; nothing is entered then.
        """
        clash = {"copies", "stored", "violations"} & set(self.columns)
        if clash:
            raise ValueError(f"columns of the result, not names for keys: {sorted(clash)}")
        keys_table, filter_table = self._tables
        commit = self.ledger.begin(spark)
        keys = list(self.columns)
        marks = commit.read(filter_table, FILTER)
        drop = self._placed(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")))
        seen = F.coalesce(F.col("index_stored_mask").bitwiseAND(F.col("index_mask")) == F.col("index_mask"), F.lit(False))
        drop = settled(
            drop.join(marks.withColumnRenamed("index_mask", "index_stored_mask"), ["index_part", "index_block"], "left")
            .withColumn("index_possible", seen)
            .drop("index_stored_mask")
        )
        # At most `parts` numbers.
        hit = [r["index_part"] for r in drop.where("index_possible").select("index_part").distinct().collect()]
        schema = T.StructType([*[df.schema[c] for c in keys], T.StructField("index_hash", T.LongType()), T.StructField("index_part", T.IntegerType())])
        judged = drop.withColumn("stored", F.lit(False))
        if hit:
            known = commit.read(keys_table, schema, "index_part", [str(p) for p in hit])
            known = known.select(F.col("index_hash").alias("index_known_hash"), F.struct(*keys).alias("index_known"))
            same = (F.col("index_hash") == F.col("index_known_hash")) & F.struct(*keys).eqNullSafe(F.col("index_known"))
            found = drop.where("index_possible").join(known, same, "left").withColumn("stored", F.col("index_known_hash").isNotNull())
            rest = judged.where("NOT index_possible")
            judged = settled(found.select(*judged.columns).unionByName(rest))
        new = judged.where("NOT stored")
        commit.append_partitions(new.select(*schema.names).repartition("index_part"), keys_table, "index_part")
        marked = new.select(*FILTER.names).unionByName(marks).groupBy("index_part", "index_block").agg(F.bit_or("index_mask").alias("index_mask"))
        commit.replace(marked, filter_table)
        commit.commit()
        violations = F.col("copies") - 1 + F.col("stored").cast("long")
        return judged.select(*keys, "copies", "stored", violations.alias("violations")).where("violations > 0")
