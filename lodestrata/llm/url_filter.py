"""URL rules and URL lists: a blocked Bloom filter passes possible hits to an exact hash join.

The filter is a table of 256-bit blocks. A key sets four bits in one block, so a probe is one lookup. The table has at most
`MAX_BLOCKS` rows (about 50 MB) whatever the list's length: a longer list only makes it pass more keys on, and the exact
join removes those. Everything is a DataFrame function.

A null url, or one without `://`, has an empty host and path, and matches nothing. Rows that repeat are judged alike; an
empty list gives the default verdict everywhere. Columns of the input are kept, except `host`, `path`, `rule` and
`verdict`, which are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .exact_dedup import UPPER
from .frames import stored

MAX_BLOCKS = 1 << 20
BITS_PER_KEY = 16


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(raw, F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and all its parent domains."""
    labels = F.split(host, r"\.")
    every = F.sequence(F.lit(1), F.size(labels))
    return F.transform(every, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def prefixes(path: Column, lengths: Sequence[int]) -> Column:
    """The path's beginnings of the lengths that occur in the rules."""
    wanted = F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")
    return F.transform(F.filter(wanted, lambda n: n <= F.char_length(path)), lambda n: F.left(path, n))


def key_hash(kind: Column, host: Column, path: Column) -> Column:
    return F.xxhash64(kind, host, path)


def filter_blocks(keys: int) -> int:
    """How many 256-bit blocks a filter for so many keys has."""
    return min(MAX_BLOCKS, 1 << max(0, math.ceil(math.log2(max(1, keys * BITS_PER_KEY / 256)))))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(key, 24), F.lit(blocks))


def _words(key: Column) -> list[Column]:
    """The four 64-bit words of a block with the key's bit in each."""
    places = [F.shiftright(key, 6 * i).bitwiseAND(63).cast("int") for i in range(4)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]


def bloom_table(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter for the hashes in `keys.key`: (block, w0..w3)."""
    words = [w.alias(f"w{i}") for i, w in enumerate(_words(F.col("key")))]
    marked = keys.select(_block(F.col("key"), blocks).alias("block"), *words)
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def possible(probes: DataFrame, filter_table: DataFrame, blocks: int) -> DataFrame:
    """The rows of `probes` whose `key` the filter does not rule out."""
    found = probes.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(filter_table), "block")
    for i, word in enumerate(_words(F.col("key"))):
        found = found.where(F.col(f"w{i}").bitwiseAND(word) == word)
    return found.select(*probes.columns)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame([("rule", h, p, v) for v, h, p in rules], "kind string, host string, path string, verdict string")


def url_table(urls: DataFrame, url_col: str, verdict: str) -> DataFrame:
    """A list of URLs, each standing for its canonical form (host and path) alone."""
    canonical = urls.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")).distinct()
    return canonical.where("host <> ''").select(F.lit("url").alias("kind"), "host", "path", F.lit(verdict).alias("verdict"))


def judge(pages: DataFrame, listed: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """`pages` with host, path, rule and verdict.

    `listed` has (kind, host, path, verdict). An entry of kind `rule` fits its host and all subdomains where the path starts
    with its own; the longest one wins (of equal length, the longer host). An entry of kind `url` fits that canonical URL
    alone and speaks only where no rule does. Distinct (host, path) pairs are judged once and joined back.
    """
    listed = stored(listed.distinct().withColumn("key", key_hash(F.col("kind"), F.col("host"), F.col("path"))), "listed")
    blocks = filter_blocks(listed.count())
    lengths = sorted(r[0] for r in listed.where("kind = 'rule'").select(F.char_length("path")).distinct().collect())
    parsed = pages.drop("host", "path", "rule", "verdict").withColumns(
        {"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))}
    )
    pairs = parsed.select("host", "path").distinct()
    rule_probe = F.flatten(
        F.transform(
            suffixes(F.col("host")),
            lambda h: F.transform(
                prefixes(F.col("path"), lengths),
                lambda p: F.struct(F.lit("rule").alias("kind"), h.alias("host"), p.alias("path")),
            ),
        )
    )
    url_probe = F.array(F.struct(F.lit("url").alias("kind"), F.col("host"), F.col("path")))
    probes = pairs.select(F.struct("host", "path").alias("page"), F.inline(F.concat(rule_probe, url_probe)))
    probes = probes.withColumn("key", key_hash(F.col("kind"), F.col("host"), F.col("path")))
    hits = possible(probes, bloom_table(listed.select("key"), blocks), blocks).join(
        listed, ["key", "kind", "host", "path"]
    )
    is_rule = F.col("kind") == "rule"
    rank = F.struct(
        is_rule.alias("is_rule"),
        (F.char_length("host") + F.char_length("path")).alias("size"),
        F.char_length("host").alias("host_size"),
        F.when(is_rule, F.concat("host", "path")).alias("rule"),
        F.col("verdict"),
    )
    best = hits.groupBy("page").agg(F.max(rank).alias("best"))
    best = best.select(F.struct(F.col("page.host"), F.col("page.path")).alias("page"), "best")
    joined = parsed.withColumn("page", F.struct("host", "path")).join(best, "page", "left")
    return joined.withColumns(
        {"rule": F.col("best.rule"), "verdict": F.coalesce(F.col("best.verdict"), F.lit(default))}
    ).drop("page", "best")
