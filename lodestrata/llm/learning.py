"""Bounded labelled samples, and what the trained operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A model tells apart at most this many classes: the ones with most rows.
MAX_CLASSES = 200
GRAIN = 1 << 30


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % modulus


def bounded_sample(rows: DataFrame, per_class: int) -> DataFrame:
    """About `per_class` rows of (id, label) for each class, chosen by a hash of the id, with `weight`: the rows of the
    class that each stands for. Repeated ids count once, with their largest label; null ids and labels are left out."""
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
    sizes = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(MAX_CLASSES).collect()
    share = F.lit(0.0)
    for row in sizes:
        share = F.when(F.col("label") == row["label"], F.lit(min(1.0, per_class / row["count"]))).otherwise(share)
    picked = rows.withColumn("share", share).where(F.pmod(F.xxhash64("id"), F.lit(GRAIN)) < F.col("share") * GRAIN)
    return picked.select("id", "label", F.try_divide(F.lit(1.0), F.col("share")).alias("weight"))


def with_texts(docs: DataFrame, sample: DataFrame, id_col: str) -> DataFrame:
    """The documents of a bounded sample; its size has a stated bound, so it is broadcast."""
    known = F.broadcast(sample.withColumnsRenamed({"id": "__id", "label": "__label", "weight": "__weight"}))
    return docs.join(known, F.col(id_col) == F.col("__id")).drop("__id")


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Adagrad:
    """Step sizes that shrink where gradients were large."""

    def __init__(self, rate: float):
        self.rate, self.seen = rate, {}

    def step(self, name: str, value: np.ndarray, gradient: np.ndarray) -> None:
        seen = self.seen.setdefault(name, np.full_like(value, 1e-8))
        seen += gradient * gradient
        value -= self.rate * gradient / np.sqrt(seen)
