"""Connected components of links, as joins and partial aggregates; nothing is gathered on the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component, for every node of `links` (a, b).

    Each round takes the smallest label among a node and its neighbours, then the label of that label, so the longest
    chain halves at least; a round that changes nothing ends it. A node with very many links is a large join key, which
    Spark may split, and its minimum is aggregated before the shuffle. Null ends link nothing, a link of a node with itself
    only names it, repeated links count once, and no links give no nodes.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL")
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    nearest = both.groupBy("node").agg(F.min("other").alias("low"))
    labels = stored(nearest.select("node", F.least("node", "low").alias("label")))
    while True:
        near = links.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a")
        near = near.join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
        low = F.least("la", "lb")
        # A smaller label is offered to both ends and to the labels they had.
        ends = [F.struct(F.col(end).alias("node"), low.alias("low")) for end in ("a", "b", "la", "lb")]
        offers = near.where("la <> lb").select(F.inline(F.array(*ends)))
        best = offers.groupBy("node").agg(F.min("low").alias("low"))
        joined = labels.join(best, "node", "left").select("node", F.least("label", F.coalesce("low", "label")).alias("label"))
        joined = stored(joined)
        # The label that very many nodes have is a key that Spark may split: both sides come straight from a shuffle.
        roots = joined.select(F.struct(F.col("node").alias("label")).alias("key"), F.col("label").alias("root"))
        keyed = joined.select("node", F.struct("label").alias("key"))
        after = stored(keyed.join(roots, "key", "left").select("node", F.coalesce("root", "key.label").alias("label")))
        same = after.join(labels.withColumnRenamed("label", "was"), "node").where("label <> was").isEmpty()
        discard(joined, labels)
        labels = after
        if same:
            return labels
