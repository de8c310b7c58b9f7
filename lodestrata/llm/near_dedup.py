"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A shingle is five words (A to Z lower-cased); its weight is its count in the document times a damped inverse document
frequency, 1 + `DAMPING` * ln(1 / f) / ln(1 / `RARE`), where f is the share of other documents that have it, `RARE` at least.
Shares are counted over all documents in 2^18 hashed buckets, less what a bucket holds on average, so neither what every task
is sent nor a weight changes with the size of the corpus. Each of 56 samples of a document falls on a shingle and a level with
the probability of the weighted Jaccard similarity that two documents agree; 40 bands, each of six of the samples, make the
candidates (a pair of similarity 0.8 shares one with probability 0.998, one of 0.3 with 0.03). The random numbers come from
tables of 16,384 triples.

Documents with the same shingles are one node from the start. Links are found in three ways, each between classes that the one
before has left apart. First every node is paired with one leader, the smallest node of its largest bucket; then with another,
drawn by hash, of a bucket that still holds another class, and all members of small buckets are compared. Pairs whose samples agree rarely (less than 0.55, five deviations below 0.8) are left here; the others are
verified by their exact weighted Jaccard similarity, and links of 0.8 or more make classes. What then shares a larger bucket with
another class (texts with a common template, say) is worked off by an exact join, without samples: with its shingles ordered
from rare to frequent, each text is looked up under its first ones only, as many as two texts of 0.8 cannot both do without.
Where many texts stand under one of those, they are one family with a pivot, the text most like all of them. What a text has more
and less than the pivot is compared first, and links to the pivot are followed; two texts of a family that are still apart reach
0.8 only if they share much of these differences. So they meet in a join under their rare differences, and no more under the
shingles that all of the family have; the join by shingles is left with pairs across families. Before both, classes are merged:
the texts get bands of more samples, which pairs above 0.8 share far more often than others, and are verified with one leader of
each. The joins then make the pairs still apart; any choice of pivots gives the same links.

A document without words is like no other and is its own class, as is, with a null class, a row with a null id. Rows that
repeat an id are one document, with the smaller of its texts by hash; `one_of_each` tells such rows apart by their texts. Equal
choices fall to the smaller id. A very long text is worked on whole, in some thirty times its bytes. An empty table gives an
empty result. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import discard, lean, release, ship, stored, without_rows
from .text import Texts, column_texts, mix, pair_names, pieces, shingle_names, word_names
from .url_filter import bloom_table, filter_blocks, possible

WORDS = 5
SIMILARITY = 0.8
SAMPLES, BANDS, ROWS = 56, 40, 6
DAMPING = 0.25
DF_BITS = 18
RARE = 1 / 128
POOL_BITS = 14
LEAST_AGREEMENT = 0.55
# In buckets of so few nodes all are compared.
SMALL = 8
# Samples in each of the bands of the rounds before the exact join, and bands in a round; the join finds what they leave.
SHARP_ROWS = (16, 14, 12, 10)
SHARP_BANDS = 16
# The table that orders shingles for the exact join; it decides how many pairs are looked at, never which are found.
ORDER_BITS = 18
# What rounding may take of a similarity: of one that is looked for, and of a link.
ROUNDING, LINK_ROUNDING = 1e-5, 1e-6
# Samples that a text and the pivot of its family have in common, at least; so their sizes are alike, too.
FAMILY_AGREEMENT = 0.3


class Draws:
    """Tables of the random numbers of each sample: r and c of Gamma(2, 1) (c as its logarithm) and a uniform shift."""

    def __init__(self, seed: int = 1):
        random = np.random.default_rng(seed)
        shape = (SAMPLES, 1 << POOL_BITS)
        self.r = random.gamma(2.0, 1.0, shape).astype(np.float32) + np.float32(1e-6)
        self.log_c = np.log(random.gamma(2.0, 1.0, shape) + 1e-30).astype(np.float32)
        self.shift = random.random(shape).astype(np.float32)
        self.odd = random.integers(1 << 62, 1 << 63, SAMPLES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        # The samples of each band; a sample stands in several.
        self.bands = np.array([random.choice(SAMPLES, ROWS, replace=False) for _ in range(BANDS)])


class Shingled:
    """The distinct shingles of some texts, by text and name, with counts; those of text i are first[i]:first[i + 1]."""

    def __init__(self, texts: Texts):
        words, names = word_names(texts)
        found, offsets = shingle_names(words, names, WORDS)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        order = np.lexsort((found, owner))
        found, owner = found[order], owner[order]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(new)
        self.names, self.owner = found[starts], owner[starts]
        self.counts = np.diff(np.append(starts, len(found)))
        self.first = np.searchsorted(self.owner, np.arange(len(offsets)))


def df_bucket(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - DF_BITS)).astype(np.int64)


class Weights:
    """Damped inverse document frequencies by bucket."""

    def __init__(self, frequencies: np.ndarray, documents: int):
        # A bucket holds its shingles' documents and, on average, its part of all other shingles.
        others = np.maximum(frequencies - 1 - frequencies.sum() / len(frequencies), 0)
        share = np.clip(others / max(documents, 1), RARE, 1)
        self.table = (1 + DAMPING * np.log(share) / np.log(RARE)).astype(np.float32)

    def of(self, names: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.table[df_bucket(names)] * counts.astype(np.float32)


def document_frequencies(rows: DataFrame) -> Weights:
    """Counted over all documents in a fixed number of buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents = np.zeros(1 << DF_BITS, np.int64), 0
        for batch in batches:
            for _, _, piece in pieces(column_texts(batch.column(1))):
                found = Shingled(piece)
                total += np.bincount(df_bucket(found.names), minlength=1 << DF_BITS)
                documents += int((np.diff(found.first) > 0).sum())
        used = np.flatnonzero(total)
        columns = [pa.array(np.append(used, -1)), pa.array(np.append(total[used], documents))]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "n"])

    summed = rows.mapInArrow(lean(count), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    # The last place, bucket -1, holds the number of documents.
    table = np.zeros((1 << DF_BITS) + 1, np.int64)
    table[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return Weights(table[:-1], int(table[-1]))


def samples(found: Shingled, weights: Weights, draws: Draws) -> np.ndarray:
    """For each text with shingles one row of sample names."""
    filled = np.flatnonzero(np.diff(found.first))
    starts = found.first[filled]
    sizes = np.diff(np.append(starts, len(found.names)))
    out = np.zeros((len(filled), SAMPLES), np.uint32)
    if not len(filled):
        return out
    log_weight = np.log(weights.of(found.names, found.counts))
    group = np.repeat(np.arange(len(filled)), sizes)
    for k in range(SAMPLES):
        at = ((found.names * draws.odd[k]) >> np.uint64(64 - POOL_BITS)).astype(np.int64)
        r, shift = draws.r[k][at], draws.shift[k][at]
        level = np.floor(log_weight / r + shift)
        value = draws.log_c[k][at] - r * (level - shift + 1)
        least = np.minimum.reduceat(value, starts)
        hit = np.flatnonzero(value == least[group])
        hit = hit[np.concatenate(([True], np.diff(group[hit]) > 0))]
        name = pair_names(found.names[hit], level[hit].astype(np.int64).view(np.uint64))
        out[:, k] = (name >> np.uint64(32)).astype(np.uint32)
    return out


def _sketch(batches: Iterator[pa.RecordBatch], weights: Weights, draws: Draws) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end, piece in pieces(column_texts(batch.column(1))):
            found = Shingled(piece)
            filled = np.flatnonzero(np.diff(found.first))
            if not len(filled):
                continue
            signature = samples(found, weights, draws)
            starts = found.first[filled]
            counted = pair_names(found.names, found.counts.astype(np.uint64))
            content = [np.add.reduceat(mix(counted + np.uint64(salt)), starts).view(np.int64) for salt in (1, 2)]
            keys = np.full((len(filled), BANDS), 1, np.uint64) * np.arange(1, BANDS + 1, dtype=np.uint64)
            for row in range(ROWS):
                keys = pair_names(keys, signature[:, draws.bands[:, row]].astype(np.uint64))
            ids = batch.column(0).slice(begin, end - begin).take(pa.array(filled))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(content[0]),
                    pa.array(content[1]),
                    pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                    pa.array(list(signature.view(np.int32)), pa.list_(pa.int32())),
                ],
                names=["id", "content_a", "content_b", "bands", "signature"],
            )


SKETCH = "id long, content_a long, content_b long, bands array<long>, signature array<int>"


def agreement(one: Column, other: Column) -> Column:
    same = F.zip_with(one, other, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x) / SAMPLES


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end, piece in pieces(column_texts(batch.column(1))):
            found = Shingled(piece)
            bounds = list(zip(found.first[:-1], found.first[1:], strict=True))
            more = found.counts > 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(begin, end - begin),
                    pa.array([found.names[a:b].tobytes() for a, b in bounds], pa.binary()),
                    pa.array(
                        [
                            np.stack((np.flatnonzero(more[a:b]), found.counts[a:b][more[a:b]])).astype(np.int32).tobytes()
                            for a, b in bounds
                        ],
                        pa.binary(),
                    ),
                ],
                names=["id", "names", "repeats"],
            )


def _vector(names: bytes, repeats: bytes, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(names, np.uint64)
    counts = np.ones(len(own), np.int64)
    at, more = np.frombuffer(repeats, np.int32).reshape(2, -1)
    counts[at] = more
    return own, weights.of(own, counts)


def weighted_jaccard(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller over sum of larger weights; names are sorted and distinct on each side."""
    at = np.minimum(np.searchsorted(other[0], one[0]), max(len(other[0]) - 1, 0))
    if not len(one[0]) or not len(other[0]):
        return 0.0
    hit = other[0][at] == one[0]
    shared = float(np.minimum(one[1][hit], other[1][at[hit]]).sum(dtype=np.float64))
    return shared / (float(one[1].sum(dtype=np.float64)) + float(other[1].sum(dtype=np.float64)) - shared)


def _rows_of(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of the distinct `ids`."""
    # The filter, whose size has a bound, keeps most other texts out of the shuffle; the join decides.
    blocks = filter_blocks(ids.count())
    table = bloom_table(ids.select(F.xxhash64("id").alias("key")), blocks)
    few = possible(rows.withColumn("key", F.xxhash64("id")), table, blocks).drop("key")
    return few.join(ids, "id", "left_semi")


def _paired(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) with the shingles of both. Only documents in a pair are made vectors."""
    involved = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "involved")
    vectors = _rows_of(involved, rows).mapInArrow(lean(_vectors), "id long, names binary, repeats binary")
    left = vectors.select(F.col("id").alias("a"), F.col("names").alias("na"), F.col("repeats").alias("ra"))
    right = vectors.select(F.col("id").alias("b"), F.col("names").alias("nb"), F.col("repeats").alias("rb"))
    return pairs.select("a", "b").join(right, "b").join(left, "a")


def verified(pairs: DataFrame, rows: DataFrame, weights, similarity: float) -> DataFrame:
    """The pairs (a, b) of at least this weighted Jaccard similarity."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, ra, nb, rb in zip(*[batch.column(c) for c in ("na", "ra", "nb", "rb")], strict=True):
                one, other = (_vector(n.as_py(), r.as_py(), weights.value) for n, r in ((na, ra), (nb, rb)))
                keep.append(weighted_jaccard(one, other) >= similarity - LINK_ROUNDING)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _paired(pairs, rows).mapInArrow(lean(check), "a long, b long")


def _members(nodes: DataFrame) -> DataFrame:
    """(band, node, size) in buckets of two nodes or more."""
    keys = nodes.select("node", F.explode("bands").alias("band"))
    sizes = keys.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    joined = keys.withColumn("key", F.struct("band")).join(sizes.select(F.struct("band").alias("key"), "size"), "key")
    return stored(joined.select(F.col("key.band").alias("band"), "node", "size"), "members")


def _led(labelled: DataFrame, round_number: int) -> DataFrame:
    """Pairs (a, b) of every node with one leader of another class: that of its largest bucket, later of any by hash."""
    first = round_number == 0
    draw = F.col("node") if first else F.xxhash64(F.lit(round_number), F.col("node"))
    leaders = labelled.groupBy("band").agg(F.min(F.struct(draw.alias("order"), "node", "label"))["node"].alias("leader"),
                                           F.min(F.struct(draw.alias("order"), "node", "label"))["label"].alias("led"))
    leaders = leaders.select(F.struct("band").alias("key"), "leader", "led")
    joined = labelled.withColumn("key", F.struct("band")).join(leaders, "key").where("led <> label")
    rank = F.struct("size", "band") if first else F.struct(F.xxhash64(F.lit(round_number), "band").alias("order"), "band")
    best = joined.groupBy("node").agg(F.max(F.struct(rank.alias("rank"), "leader"))["leader"].alias("leader"))
    return best.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _mixed(labelled: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one class."""
    classes = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return labelled.withColumn("key", F.struct("band")).join(classes.select(F.struct("band").alias("key")), "key", "left_semi").drop("key")


def _within(labelled: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of different classes in buckets of at most `SMALL` nodes: a few for each member."""
    buckets = labelled.where(F.col("size") <= SMALL).groupBy("band").agg(F.array_sort(F.collect_list(F.struct("node", "label"))).alias("own"))
    pairs = buckets.select("own", F.explode("own").alias("one")).select("one", F.explode("own").alias("other"))
    pairs = pairs.where("one.node < other.node AND one.label <> other.label")
    return pairs.select(F.col("one.node").alias("a"), F.col("other.node").alias("b")).distinct()


def _order_bucket(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


def _order(rows: DataFrame, names_of) -> np.ndarray:
    """How many of the rows have a name of each bucket, in a fixed number of buckets; `names_of` gives a batch's, in parts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            for names in names_of(batch):
                np.add.at(total, _order_bucket(names), 1)
        used = np.flatnonzero(total)
        for at in range(0, len(used), 1 << 16):
            own = used[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["bucket", "n"])

    summed = rows.mapInArrow(lean(count), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    summed = summed.where("n > 1").toArrow()
    table = np.ones(1 << ORDER_BITS, np.int32)
    table[summed["bucket"].to_numpy()] = np.minimum(summed["n"].to_numpy(), np.iinfo(np.int32).max)
    return table


def _shingle_order(rows: DataFrame) -> np.ndarray:
    return _order(rows, lambda batch: (Shingled(piece).names for _, _, piece in pieces(column_texts(batch.column(1)))))


def first_shingles(found: Shingled, weights: Weights, order: np.ndarray, similarity: float):
    """(text, name, total, left) of the shingles under which a text is looked up, rare ones first.

    `left` is the weight of this and all later shingles: two texts share no more than the smaller `left` of their first
    common shingle. Shingles that leave less than `similarity` of the text's weight can be first for no pair.
    """
    weight = weights.of(found.names, found.counts).astype(np.float64)
    by_rarity = np.lexsort((found.names, order[_order_bucket(found.names)], found.owner))
    owner, weight = found.owner[by_rarity], weight[by_rarity]
    total = np.bincount(owner, weight, len(found.first))
    sums = np.concatenate(([0.0], np.cumsum(weight)))
    left = total[owner] - (sums[:-1] - sums[found.first[owner]])
    keep = left >= similarity * total[owner]
    return owner[keep], found.names[by_rarity][keep], total[owner][keep], left[keep]


def _entries(unsettled: DataFrame, rows: DataFrame, weights, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(node, name, total, left) of the first shingles of the nodes' texts; and these texts."""
    own = stored(_rows_of(unsettled.select(F.col("node").alias("id")), rows), "unsettled_rows")
    order = rows.sparkSession.sparkContext.broadcast(_shingle_order(own))
    least = similarity - ROUNDING

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, piece in pieces(column_texts(batch.column(1))):
                at, names, total, left = first_shingles(Shingled(piece), weights.value, order.value, least)
                ids = batch.column(0).slice(begin, end - begin).take(pa.array(at))
                columns = [ids, pa.array(names.view(np.int64)), pa.array(total), pa.array(left)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "name", "total", "left"])

    entries = stored(own.mapInArrow(lean(look_up), "node long, name long, total double, left double"), "first_shingles")
    order.destroy()
    return entries, own


def _families(entries: DataFrame, crowded: DataFrame) -> DataFrame:
    """(node, pivot) of nodes that stand under crowded shingles together: the pivot, left out, is the one most like all of them.

    Nodes are tied to one leader of each crowded shingle where some of their samples agree. Of what hangs together the most
    frequent samples are counted, and the node with most of these is the pivot of all that are like it.
    """
    leaders = entries.groupBy("name").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("node").alias("order"), "node"))["node"].alias("leader"))
    leaders = leaders.where(F.col("size") > SMALL).select(F.struct("name").alias("key"), "leader")
    tied = entries.select("node", F.struct("name").alias("key")).join(leaders, "key").where("node <> leader").select("node", "leader").distinct()

    def alike(pairs: DataFrame, end: str) -> DataFrame:
        ends = [crowded.select(F.col("node").alias(c), F.col("signature").alias(f"s{c}")) for c in ("node", end)]
        # As structs, so that what leads very many nodes is a key that Spark may split.
        ends[1] = ends[1].select(F.struct(end).alias("key"), f"s{end}")
        both = pairs.join(ends[0], "node").withColumn("key", F.struct(end)).join(ends[1], "key")
        return both.where(agreement(F.col("snode"), F.col(f"s{end}")) >= FAMILY_AGREEMENT).select("node", end)

    links = stored(alike(tied, "leader").select(F.col("node").alias("a"), F.col("leader").alias("b")), "tied")
    tied = components(links)
    members = stored(crowded.join(tied, "node").select("node", "signature", F.col("label").alias("family")), "families")
    votes = members.select("family", F.posexplode("signature").alias("at", "value")).groupBy("family", "at", "value").agg(F.count("*").alias("n"))
    votes = votes.groupBy("family", "at").agg(F.max(F.struct("n", "value"))["value"].alias("value"))
    usual = votes.groupBy("family").agg(F.array_sort(F.collect_list(F.struct("at", "value")))["value"].alias("usual"))
    keyed = members.withColumn("key", F.struct("family"))
    scored = keyed.join(usual.select(F.struct("family").alias("key"), "usual"), "key")
    scored = scored.select("family", "node", agreement(F.col("signature"), F.col("usual")).alias("score"))
    pivots = scored.groupBy("family").agg(F.min(F.struct((-F.col("score")).alias("order"), "node"))["node"].alias("pivot"))
    led = keyed.join(pivots.select(F.struct("family").alias("key"), "pivot"), "key").where("node <> pivot").select("node", "pivot").distinct()
    found = stored(alike(led, "pivot").distinct(), "pivots")
    discard(links, tied, members)
    return found


def difference(one: tuple[np.ndarray, np.ndarray], pivot: tuple[np.ndarray, np.ndarray], pivot_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, weight) of what a vector has more and less than the pivot's: names tell pivots, and more from less, apart."""
    names = np.union1d(one[0], pivot[0])
    change = np.zeros(len(names))
    change[np.searchsorted(names, one[0])] = one[1]
    change[np.searchsorted(names, pivot[0])] -= pivot[1]
    used = np.flatnonzero(change)
    sign = (change[used] > 0).astype(np.uint64)
    within = pair_names(np.full(len(used), pivot_id, np.int64).view(np.uint64), sign)
    return pair_names(names[used], within), np.abs(change[used])


DIFFERENCE = "node long, pivot long, size double, base double, apart double, names binary, weights binary"


def _differences(families: DataFrame, rows: DataFrame, weights) -> DataFrame:
    """Of each node but the pivots, how it differs from its pivot: its weight, the pivot's, the sum of differences, and these."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[] for _ in range(5)]
            for pivot_id, na, ra, nb, rb in zip(*[batch.column(c) for c in ("b", "na", "ra", "nb", "rb")], strict=True):
                one, pivot = (_vector(n.as_py(), r.as_py(), weights.value) for n, r in ((na, ra), (nb, rb)))
                names, change = difference(one, pivot, pivot_id.as_py())
                row = (one[1].sum(dtype=np.float64), pivot[1].sum(dtype=np.float64), change.sum(), names.tobytes(), change.tobytes())
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            kinds = [pa.float64()] * 3 + [pa.binary()] * 2
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["node", "pivot", "size", "base", "apart", "names", "weights"]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *arrays], names=names)

    pairs = families.select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    return stored(_paired(pairs, rows).mapInArrow(lean(compare), DIFFERENCE), "differences")


def _linked(similarity: float) -> Column:
    """Whether a node has at least this weighted Jaccard similarity to its pivot."""
    return F.col("apart") <= _apart(similarity) * (F.col("size") + F.col("base"))


def _apart(similarity: float) -> float:
    """How far apart texts may be, as a share of both weights."""
    return (1 - similarity) / (1 + similarity)


def _pivot_links(differences: DataFrame, similarity: float) -> DataFrame:
    near = differences.where(_linked(similarity - LINK_ROUNDING))
    return near.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))


def _pivots(differences: DataFrame, similarity: float) -> DataFrame:
    """(node, pivot) of the pivots themselves, and of nodes with differences, less those that rounding could make a link."""
    sure = _linked(similarity - LINK_ROUNDING) | ~_linked(similarity - ROUNDING)
    found = differences.groupBy("node").agg(F.min("pivot").alias("pivot"), F.bool_and(sure).alias("sure")).where("sure").drop("sure")
    return found.unionByName(found.select(F.col("pivot").alias("node"), "pivot").distinct())


def _difference_entries(differences: DataFrame, similarity: float) -> DataFrame:
    """(node, name, far, need, left, first, second) of the differences under which a node is looked up, rare ones first.

    Texts x and y of one pivot are as far apart as their differences from it, |dx| + |dy| less twice what these share. With
    r = (1 - s) / (1 + s) they reach the similarity s if that is at most r (|x| + |y|), so if the differences share
    need(x) + need(y), where need(x) = (|dx| - r |x|) / 2. Nodes that are links of the pivot are one class, so of a pair one
    node, the `first`, is far from the pivot, and its need at least r |p| / 2 and that of a far `second`.
    """
    least = similarity - ROUNDING
    r = _apart(least)
    unpack = lambda batch, column, kind: np.frombuffer(b"".join(batch.column(column).to_pylist()), kind)
    order = differences.sparkSession.sparkContext.broadcast(_order(differences, lambda batch: [unpack(batch, "names", np.uint64)]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, weight = unpack(batch, "names", np.uint64), unpack(batch, "weights", np.float64)
            size, base, apart = (batch.column(c).to_numpy() for c in ("size", "base", "apart"))
            counts = np.array([len(x) // 8 for x in batch.column("names").to_pylist()], np.int64)
            owner = np.repeat(np.arange(len(counts)), counts)
            by_rarity = np.lexsort((names, order.value[_order_bucket(names)], owner))
            names, weight = names[by_rarity], weight[by_rarity]
            starts = np.cumsum(counts) - counts
            sums = np.concatenate(([0.0], np.cumsum(weight)))
            left = apart[owner] - (sums[:-1] - sums[starts[owner]])
            need, far = (apart - r * size) / 2, apart > r * (size + base)
            # What any other node needs at least: it weighs size / s at most, and its need is no less than the pivot's.
            least_first = np.maximum(apart - size * (1 - least) / least, need - r * base / 2)
            least_second = need + np.maximum(need, r * base / 2)
            first = far[owner] & (left >= least_first[owner])
            second = left >= least_second[owner]
            keep = first | second
            ids = batch.column("node").take(pa.array(owner[keep]))
            columns = [ids, *(pa.array(c[keep]) for c in (names.view(np.int64), far[owner], need[owner], left, first, second))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "name", "far", "need", "left", "first", "second"])

    schema = "node long, name long, far boolean, need double, left double, first boolean, second boolean"
    entries = stored(differences.mapInArrow(lean(look_up), schema), "first_differences")
    order.destroy()
    return entries


def _family_pairs(entries: DataFrame) -> DataFrame:
    """Pairs of nodes of two classes with one pivot, among them all that reach the similarity; entries have labels."""
    one, other = entries.where("first").alias("one"), entries.where("second").alias("other")
    further = "(NOT other.far OR one.need > other.need OR one.need = other.need AND one.node > other.node)"
    fits = f"one.name = other.name AND {further} AND one.label <> other.label AND least(one.left, other.left) >= one.need + other.need"
    return _by_nodes(one.join(other, F.expr(fits)), "one.need + other.need")


def _crowded(entries: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, signature) of the nodes that stand under a shingle with more than `SMALL` of them."""
    sizes = entries.groupBy("name").agg(F.count("*").alias("size")).where(F.col("size") > SMALL)
    under = entries.withColumn("key", F.struct("name")).join(sizes.select(F.struct("name").alias("key")), "key", "left_semi")
    return stored(nodes.select("node", "signature").join(under.select("node").distinct(), "node", "left_semi"), "crowded")


def _sharp(crowded: DataFrame, labels: DataFrame | None, round_number: int) -> DataFrame:
    """Pairs (a, b) of a node and a leader of another class with which it shares a band of more samples."""
    random = np.random.default_rng(round_number)

    def band(number: int) -> Column:
        chosen = random.choice(SAMPLES, SHARP_ROWS[round_number], replace=False)
        return F.xxhash64(F.lit(number), *[F.col("signature")[int(k)] for k in chosen])

    keyed = _labelled(crowded, labels).select("node", "label", F.explode(F.array(*map(band, range(SHARP_BANDS)))).alias("band"))
    order = F.xxhash64(F.lit(round_number), "node").alias("order")
    leaders = keyed.groupBy("band").agg(F.min(F.struct(order, "node", "label")).alias("led"), F.min("label").alias("low"), F.max("label").alias("high"))
    leaders = leaders.where("low <> high").select(F.struct("band").alias("key"), F.col("led.node").alias("leader"), F.col("led.label").alias("led"))
    joined = keyed.withColumn("key", F.struct("band")).join(leaders, "key").where("led <> label")
    return joined.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _by_nodes(pairs: DataFrame, needed: str) -> DataFrame:
    """Distinct pairs, with the labels and by how much the pair may reach the similarity."""
    a, b = [F.struct(F.col(f"{side}.node").alias("node"), F.col(f"{side}.label").alias("label")) for side in ("one", "other")]
    margin = F.least("one.left", "other.left") - F.expr(needed)
    pairs = pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), margin.alias("margin"))
    pairs = pairs.groupBy("a", "b").agg(F.max("margin").alias("margin"))
    return pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.label").alias("la"), F.col("b.label").alias("lb"), "margin")


def _exact_pairs(entries: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs of nodes of two classes, among them all of at least this weighted Jaccard similarity.

    Pairs meet under a shared shingle, in a join whose large keys Spark may split. Only those are rows of it whose
    weights from there on could still reach the similarity: sharing c of the weights x and y needs c / (x + y - c).
    Nodes of the same pivot do not meet here.
    """
    least = similarity - ROUNDING
    # Of two texts the lighter one has its first common shingle while yet more of it is left. So it is looked up under fewer.
    lighter = entries.where(f"left >= {2 * least / (1 + least)!r} * total")
    # It meets each other family that stands there, and the nodes without one (null).
    families = entries.groupBy("name").agg(F.collect_set("pivot").alias("pivots"), F.bool_or(F.isnull("pivot")).alias("lone"))
    families = families.where("lone OR size(pivots) > 1").select(F.struct("name").alias("key"), "pivots", "lone")
    targets = F.filter("pivots", lambda x: ~x.eqNullSafe(F.col("pivot")))
    targets = F.when(F.col("lone"), F.array_append(targets, F.lit(None).cast("long"))).otherwise(targets)
    lighter = lighter.withColumn("key", F.struct("name")).join(families, "key")
    lighter = lighter.select("node", "name", "total", "left", "label", F.explode(targets).alias("target"))
    one, other = entries.alias("one"), lighter.alias("other")
    needed = f"{least / (1 + least)!r} * (one.total + other.total)"
    heavier = "(one.total > other.total OR one.total = other.total AND one.node > other.node)"
    fits = f"one.name = other.name AND one.pivot <=> other.target AND {heavier} AND one.label <> other.label AND least(one.left, other.left) >= {needed}"
    return _by_nodes(one.join(other, F.expr(fits)), needed)


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose samples agree often enough to be verified."""
    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    joined = pairs.join(right, "b").join(left, "a")
    return joined.where(agreement(F.col("sa"), F.col("sb")) >= LEAST_AGREEMENT).select("a", "b")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """`rows` with the label of their node's class; a node without links is its own."""
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _merged_labels(links: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(node, label) of all nodes with links, old and new. Only links between classes are followed, each pair of them once."""
    ends = stored(_labelled(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), labels), "ends")
    near = links.join(ends.select(F.col("node").alias("a"), F.col("label").alias("la")), "a")
    near = near.join(ends.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b").where("la <> lb")
    between = stored(near.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(), "between")
    roots = components(between)
    every = ends if labels is None else labels.unionByName(ends).distinct()
    # As structs, so that the label of a very large class is a key that Spark may split.
    keyed = every.select("node", F.struct("label").alias("key"))
    joined = keyed.join(roots.select(F.struct(F.col("node").alias("label")).alias("key"), F.col("label").alias("root")), "key", "left")
    merged = stored(joined.select("node", F.coalesce("root", "key.label").alias("label")), "labels")
    discard(ends, between, roots)
    return merged


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """`id_col` and class_id, the smallest id of the class, for every row of `docs`."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.where("id IS NOT NULL AND text IS NOT NULL")
    weights = spark.sparkContext.broadcast(document_frequencies(rows))
    draws = spark.sparkContext.broadcast(Draws())
    sketches = stored(rows.mapInArrow(lean(lambda b: _sketch(b, weights.value, draws.value)), SKETCH), "sketches")
    content = ["content_a", "content_b"]
    one = F.min(F.struct("id", "bands", "signature")).alias("one")
    nodes = sketches.groupBy(*content).agg(one).select(*content, F.col("one.id").alias("node"), "one.bands", "one.signature")
    nodes = stored(nodes, "nodes")
    members = _members(nodes)
    labels = None

    def merge(links: DataFrame) -> None:
        """Merge the classes of links."""
        nonlocal labels
        if not links.isEmpty():
            labels, past = _merged_labels(links, labels), labels
            discard(*([past] if past is not None else []))
        discard(links)

    def settle(pairs: DataFrame) -> None:
        """Verify pairs and merge the classes of those that are links."""
        if not pairs.isEmpty():
            merge(stored(verified(pairs, rows, weights, similarity), "links"))
        discard(pairs)

    settle(stored(_likely(_led(_labelled(members, labels), 0), nodes), "likely"))
    left = stored(_mixed(_labelled(members, labels)), "mixed")
    settle(stored(_likely(_led(left, 1).unionByName(_within(left)).distinct(), nodes), "likely"))
    large = _mixed(_labelled(left.where(F.col("size") > SMALL).select("band", "node"), labels))
    unsettled = stored(large.select("node").distinct(), "unsettled")
    if not unsettled.isEmpty():
        entries, own = _entries(unsettled, rows, weights, similarity)
        crowded = _crowded(entries, nodes)
        if crowded.isEmpty():
            labelled = stored(_labelled(unsettled, labels).withColumn("pivot", F.lit(None).cast("long")), "labelled")
            pairs = stored(_exact_pairs(entries.join(labelled, "node"), similarity), "pairs")
        else:
            families = _families(entries, crowded)
            differences = _differences(families, own, weights)
            merge(stored(_pivot_links(differences, similarity), "links"))
            for number in range(len(SHARP_ROWS)):
                settle(stored(_likely(_sharp(crowded, labels, number), nodes), "likely"))
            within = _difference_entries(differences, similarity)
            labelled = stored(_labelled(unsettled, labels).join(_pivots(differences, similarity), "node", "left"), "labelled")
            pairs = _exact_pairs(entries.join(labelled, "node"), similarity)
            pairs = stored(pairs.unionByName(_family_pairs(within.join(labelled, "node"))), "pairs")
            discard(families, differences, within)
        # Of two classes the likeliest pair first; all other pairs of what is then still apart.
        best = pairs.groupBy(F.least("la", "lb").alias("low"), F.greatest("la", "lb").alias("high"))
        best = best.agg(F.max(F.struct("margin", "a", "b")).alias("best"))
        settle(stored(best.select("best.a", "best.b"), "likely"))
        ends = [_labelled(pairs.select(F.col(end).alias("node")).distinct(), labels) for end in ("a", "b")]
        ends = [e.select(F.col("node").alias(end), F.col("label").alias(f"l{end}")) for e, end in zip(ends, ("a", "b"), strict=True)]
        rest = pairs.select("a", "b").join(ends[0], "a").join(ends[1], "b").where("la <> lb").select("a", "b")
        settle(stored(rest, "rest"))
        discard(pairs, own, entries, crowded, labelled)
    discard(members, left, unsettled)
    # All that used them is written.
    weights.destroy()
    draws.destroy()
    release()
    named = nodes.select(*content, "node")
    if labels is not None:
        named = named.join(labels, "node", "left").withColumn("node", F.coalesce("label", "node")).drop("label")
    # A content that very many documents share is a large key of this join only.
    named = named.select(F.struct(*content).alias("content"), F.col("node").alias("class_id"))
    classed = sketches.select("id", F.struct(*content).alias("content")).join(named, "content").select("id", "class_id")
    classed = classed.groupBy("id").agg(F.min("class_id").alias("class_id")).withColumnRenamed("id", "__id")
    joined = docs.select(F.col(id_col)).join(classed, F.col(id_col) == F.col("__id"), "left")
    return joined.select(id_col, F.coalesce("class_id", F.col(id_col).cast("long")).alias("class_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` less the rows whose class has a row with a smaller id; rows with a null id are kept.

    Rows are told apart by a 64-bit name of id and text, so other texts under the same id are judged on their own.
    """
    key = F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col), F.col(text_col)))
    rows = docs.select(key.alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    classes = near_classes(rows, "key", "text")
    owned = classes.where("key IS NOT NULL").join(rows.select("key", "id").distinct(), "key")
    owned = stored(owned.select("class_id", "key", "id").distinct(), "classes")
    first = owned.groupBy("class_id").agg(F.min(F.struct("id", "key"))["key"].alias("first"), F.count("*").alias("n")).where("n > 1")
    # As structs, so that one very large class is a key that Spark may split.
    members = owned.select(F.struct("class_id").alias("class"), "key").join(first.select(F.struct("class_id").alias("class"), "first"), "class")
    return without_rows(docs, members.where("key <> first"), key)
