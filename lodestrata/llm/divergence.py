"""Source divergence audit by count-level bitmaps.

Every (language, source) group is compared with the other sources of its language, and with the language as a whole, over
the terms that stand in at least `SUPPORT` documents of the language. A kept term that occurs n times in a group has the
smoothed share p = 1 + floor(10^9 * (n + 5) / (N + 5 * V)), N being the group's kept occurrences and V the kept terms.

Kept terms are numbered by falling frequency, and 64 neighbouring numbers make a machine word. For every group, word and
count there is one bitset of the terms with just that count there. For two groups the AND of two of their bitsets, popcounted,
is the number of terms in that joint cell (count here, count there); it is multiplied by the cell's |p - q|. Terms that a
group lacks are never stored: cells with a zero on one or both sides follow from the sizes of the levels by complement.
Neighbours in frequency have similar counts, so a word holds few bitsets per group, 64 at most.

Occurrences are counted per piece of text, then per task, before any shuffle. The bitmaps of two sources meet in groups of
at most `BLOCK_WORDS` words and two tiles of `TILE` sources, whatever the size of a language or source.

Null text, language and source count as ''. A group without terms is a group like any other. Rows that repeat are documents
of their own. In a language without kept terms all pairs have the value 0. Ties rank by the UTF-8 bytes of the item. A text
is worked on whole, in memory of some ten times its bytes. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import ship, stored
from .text import LOWER, Texts, byte_class, column_texts, pieces, word_codes

SUPPORT = 30
SMOOTHING = 5
TOP_TERMS = 50
PIECE_BYTES = 8 << 20
BLOCK_WORDS = 64
TILE = 64
# Cells of the matrix of bitset pairs that are looked at together.
CELLS = 1 << 20

# Letters A to Z and every byte of a character beyond ASCII.
LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

COUNTS = "lang string, source string, term string, n long, docs long"


def _text_or_empty(column: pa.Array) -> pa.Array:
    return column.cast(pa.string()).fill_null("")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group, piece by piece; the term '' marks that a group occurs."""
    for batch in batches:
        langs, sources = _text_or_empty(batch.column(0)), _text_or_empty(batch.column(1))
        for begin, end, piece in pieces(column_texts(batch.column(2)), PIECE_BYTES):
            lang = langs.slice(begin, end - begin).dictionary_encode()
            source = sources.slice(begin, end - begin).dictionary_encode()
            pair = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            groups, group_of = np.unique(pair, return_inverse=True)
            words, codes, terms = word_codes(Texts(LOWER[piece.data], piece.offsets), LETTERS)
            many = max(len(terms), 1)
            cells, n = np.unique(words.text_of() * many + codes, return_counts=True)
            merged, at = np.unique(group_of[cells // many] * many + cells % many, return_inverse=True)
            marks = len(groups)
            group = groups[np.concatenate((np.arange(marks), merged // many))]
            term = pa.concat_arrays([pa.array([""] * marks, pa.string()), terms.take(pa.array(merged % many)).cast(pa.string())])
            totals = [np.bincount(at, n, len(merged)), np.bincount(at, minlength=len(merged))]
            totals = [pa.array(np.concatenate((np.zeros(marks, np.int64), x.astype(np.int64)))) for x in totals]
            lang_of = lang.dictionary.take(pa.array(group // len(source.dictionary)))
            source_of = source.dictionary.take(pa.array(group % len(source.dictionary)))
            yield pa.RecordBatch.from_arrays([lang_of, source_of, term, *totals], names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in every group; '' stands for the group."""
    rows = docs.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text")
    )
    counted = rows.mapInArrow(_count, COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(lang, term, total, number) of the terms in at least `support` documents of their language.

    Numbers rise with falling frequency inside each range of the sort; they are unique, not dense.
    """
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    order = ["lang", F.desc("total"), "term"]
    kept = kept.where(F.col("docs") >= support).drop("docs").repartitionByRange(*order).sortWithinPartitions(*order)
    return kept.withColumn("number", F.monotonically_increasing_id())


def share(n: str, size: str) -> Column:
    """p of a term with `n` occurrences in a group whose N + 5 V is `size`; exact beyond 64 bits."""
    return F.expr(f"CASE WHEN {size} > 0 THEN 1 + (CAST(1000000000 AS DECIMAL(10,0)) * ({n} + {SMOOTHING})) div {size} ELSE 0 END")


def bitmaps(cells: DataFrame) -> DataFrame:
    """(lang, source, word, n, bits): for each group, count and word of 64 term numbers, the terms with that count."""
    bit = F.expr("bit_or(shiftleft(1L, CAST(number & 63 AS INT)))").alias("bits")
    return cells.groupBy("lang", "source", F.shiftright("number", 6).alias("word"), "n").agg(bit)


def joint_values(one: tuple[np.ndarray, ...], other: tuple[np.ndarray, ...], cells: int = CELLS) -> np.ndarray:
    """Per source of `one` and source of `other`: the sum over joint cells of their terms times what they add to the value.

    Each side: places of the sources, p, p of zero, and bitsets, of one word and sorted by place. A term that both sides have
    adds |p - q| and takes back what the complements count for it: |p - q0| and |p0 - q|, less the |p0 - q0| in both.
    """
    places, p, zero, bits = one
    theirs, q, q_zero, their_bits = other
    firsts = np.flatnonzero(np.diff(theirs, prepend=-1))
    out = np.zeros((int(places[-1]) + 1, int(theirs[-1]) + 1), np.int64)
    step = max(1, cells // len(theirs))
    for a in range(0, len(places), step):
        rows = slice(a, a + step)
        terms = np.bitwise_count(bits[rows, None] & their_bits[None, :]).astype(np.int64)
        mine, mine_zero = p[rows, None], zero[rows, None]
        value = np.abs(mine - q) - np.abs(mine - q_zero) - np.abs(mine_zero - q) + np.abs(mine_zero - q_zero)
        sums = np.add.reduceat(terms * value, firsts, axis=1)
        own = np.zeros((sums.shape[0], out.shape[1]), np.int64)
        own[:, theirs[firsts]] = sums
        np.add.at(out, places[rows], own)
    return out


def _joint(key: tuple, table: pa.Table, size: int, cells: int) -> pa.Table:
    """Joint values of all pairs of sources, one of each tile, in a block of words."""
    lang, _, low, high = (k.as_py() for k in key)
    word, place, p, zero = (table[c].to_numpy() for c in ("word", "place", "p", "zero"))
    bits = table["bits"].to_numpy().view(np.uint64)
    total = np.zeros((size, size), np.int64)
    order = np.lexsort((place, word))
    cuts = np.flatnonzero(np.diff(word[order], prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
        own = order[a:b]
        sides = [own[place[own] // size == tile] for tile in (low, high)]
        if all(len(side) for side in sides):
            sums = joint_values(*[(place[s] % size, p[s], zero[s], bits[s]) for s in sides], cells)
            total[: sums.shape[0], : sums.shape[1]] += sums
    one, other = np.nonzero(total if low < high else np.triu(total, 1))
    return pa.table(
        {
            "lang": pa.array([lang] * len(one), pa.string()),
            "one": pa.array(one + low * size, pa.int64()),
            "other": pa.array(other + high * size, pa.int64()),
            "value": pa.array(total[one, other], pa.int64()),
        }
    )


def pair_values(
    groups: DataFrame, maps: DataFrame, tile: int = TILE, block_words: int = BLOCK_WORDS, cells: int = CELLS
) -> DataFrame:
    """(lang, one, other, value) for every pair of sources of a language, by place; one < other.

    The value is the sum of what holds by complement where neither has the term, where one has it, and of the joint cells.
    """
    levels = maps.groupBy("lang", "source", "n").agg(F.sum(F.bit_count("bits")).alias("terms"))
    group = ["lang", "source", "place", "size", "zero"]
    levels = levels.join(groups.select(*group), ["lang", "source"]).withColumn("p", share("n", "size"))
    far = groups.select("lang", F.col("place").alias("far"), F.col("zero").alias("far_zero"))
    # |p - 0's share| of all terms that this side has, as if the other had none of them.
    alone = levels.join(far, "lang").where("place <> far").groupBy(
        "lang", F.least("place", "far").alias("one"), F.greatest("place", "far").alias("other")
    ).agg(F.sum(F.expr("terms * abs(p - far_zero)")).alias("value"))
    near = groups.select("lang", F.col("place").alias("one"), "kept", F.col("own").alias("one_own"), "zero")
    both = near.join(groups.select("lang", F.col("place").alias("other"), F.col("own").alias("other_own"), F.col("zero").alias("far_zero")), "lang")
    lacking = both.where("one < other").select(
        "lang", "one", "other", F.expr("(kept - one_own - other_own) * abs(zero - far_zero)").alias("value")
    )
    entries = maps.join(groups.select(*group, "sources"), ["lang", "source"]).select(
        "lang", "word", "place", share("n", "size").alias("p"), "zero", "bits", F.expr(f"place div {tile}").alias("tile"), "sources"
    )
    # A source's bitmaps go once to each tile of its language: once in all, up to `tile` sources.
    entries = entries.withColumn("far", F.explode(F.expr(f"sequence(0L, (sources - 1) div {tile})")))
    keys = ["lang", F.expr(f"word div {block_words}").alias("block"), F.least("tile", "far").alias("low"), F.greatest("tile", "far").alias("high")]
    joint = entries.select(*keys, "word", "place", "p", "zero", "bits").groupBy("lang", "block", "low", "high")
    joint = joint.applyInArrow(lambda key, rows: _joint(key, rows, tile, cells), "lang string, one long, other long, value long")
    parts = lacking.unionByName(alone).unionByName(joint)
    return parts.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    support: int = SUPPORT, top_terms: int = TOP_TERMS, **tiling: int,
) -> DataFrame:
    """lang, source, part, item, value and rank: part `pair` holds the distance to each other source of the language, part
    `term` the kept terms that the group has and uses more than its language does, the `top_terms` first ones. `tiling`
    (`tile`, `block_words`, `cells`) sets how the bitmaps are dealt out, never what is returned."""
    ship(docs.sparkSession)
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "counts")
    kept = stored(kept_terms(counts, support), "kept")
    cells = stored(counts.where("term <> ''").drop("docs").join(kept, ["lang", "term"]), "cells")
    maps = stored(bitmaps(cells), "bitmaps")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_own"))
    owns = cells.groupBy("lang", "source").agg(F.sum("n").alias("occurrences"), F.count("*").alias("own"))
    groups = counts.where("term = ''").select("lang", "source").join(langs, "lang", "left").join(owns, ["lang", "source"], "left")
    groups = groups.fillna(0, ["kept", "lang_own", "occurrences", "own"])
    own_lang = Window.partitionBy("lang")
    groups = groups.withColumns(
        {
            "size": F.col("occurrences") + SMOOTHING * F.col("kept"),
            "place": (F.row_number().over(own_lang.orderBy("source")) - 1).cast("long"),
            "sources": F.count("*").over(own_lang),
        }
    )
    groups = stored(groups.withColumn("zero", share("0L", "size")), "groups")
    names = [groups.select("lang", F.col("place").alias(end), F.col("source").alias(f"{end}_source")) for end in ("one", "other")]
    pairs = pair_values(groups, maps, **tiling).join(names[0], ["lang", "one"]).join(names[1], ["lang", "other"])
    ends = [F.struct(F.col(f"{a}_source").alias("source"), F.col(f"{b}_source").alias("item")) for a, b in (("one", "other"), ("other", "one"))]
    pairs = pairs.select("lang", F.inline(F.array(*ends)), "value")
    sized = cells.join(groups.select("lang", "source", "size", F.expr(f"lang_own + {SMOOTHING} * kept").alias("lang_size")), ["lang", "source"])
    terms = sized.select("lang", "source", F.col("term").alias("item"), (share("n", "size") - share("total", "lang_size")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.where("value > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    out = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")]
    return pairs.withColumn("part", F.lit("pair")).select(*out).unionByName(terms.withColumn("part", F.lit("term")).select(*out))
