"""Benchmark decontamination with an FM-index per shard of the corpus.

A shard is a run of documents in one Arrow batch. Its words become symbols: only words that occur in the benchmark have
one, and only runs of such words that are long enough for a phrase enter the index, each ended by a separator of its own.
The index is the Burrows-Wheeler transform of the runs, held as a wavelet matrix for ranks; all phrases are searched
backwards at once, the occurrences are walked back to sampled suffix positions, and the spans they cover are merged per
document. Words are told apart by 64-bit names.

A phrase is 13 consecutive words of a benchmark item; an item of fewer words, but not none, is one phrase. Benchmarks
beyond `BLOCK_WORDS` words are searched in blocks, so what a task is sent has a bound; every block meets all documents.

Null and empty texts have no words and are clean. Rows that repeat are judged one by one. Items with a null id or no words
are ignored; an empty benchmark finds nothing. Columns of the documents other than id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import lean, row_key, without_rows
from .text import NameSet, column_texts, pieces, word_names

PHRASE_WORDS = 13
BLOCK_WORDS = 2_000_000
SAMPLE = 8
# Words of an item in any case, counted to size the blocks.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class Phrases:
    """The distinct phrases of a block of benchmark items, as rows of symbols (0: no word) aligned at the right."""

    def __init__(self, items: list[tuple[int, str]], size: int = PHRASE_WORDS):
        self.ids = np.array([i for i, _ in items], np.int64)
        words, names = word_names(column_texts(pa.array([t for _, t in items], pa.string())))
        vocabulary = np.unique(names)
        self.vocabulary = vocabulary
        symbols = np.searchsorted(vocabulary, names) + 1
        rows, owner = [], []
        for i in range(len(items)):
            own = symbols[words.first[i] : words.first[i + 1]]
            if 0 < len(own) < size:
                rows.append(np.concatenate((np.zeros(size - len(own), np.int64), own))[None])
            elif len(own):
                rows.append(np.lib.stride_tricks.sliding_window_view(own, size))
            owner += [i] * (len(rows[-1]) if len(own) else 0)
        table = np.concatenate(rows) if rows else np.zeros((0, size), np.int64)
        self.rows, which = np.unique(table, axis=0, return_inverse=True)
        pairs = np.unique(np.stack((which.ravel(), np.array(owner, np.int64)), 1), axis=0) if len(table) else table[:, :2]
        self.items = pairs[:, 1]
        self.item_first = np.searchsorted(pairs[:, 0], np.arange(len(self.rows) + 1))
        self.lengths = (self.rows > 0).sum(1)
        self.shortest = int(self.lengths.min()) if len(self.rows) else 0


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; every run ends in a separator of its own, so ties end there."""
    rank, step, n = np.unique(text, return_inverse=True)[1].ravel(), 1, len(text)
    while True:
        later = np.zeros(n, np.int64)
        later[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of symbols: one bit row for each bit of a symbol, highest first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in reversed(range(bits)):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(len(bit) - int(bit.sum()))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        start, end = np.zeros_like(end), end.copy()
        for row, level in enumerate(reversed(range(self.bits))):
            one = ((symbol >> level) & 1).astype(bool)
            ones_start, ones_end = self.ones[row][start], self.ones[row][end]
            start = np.where(one, self.zeros[row] + ones_start, start - ones_start)
            end = np.where(one, self.zeros[row] + ones_end, end - ones_end)
        return end - start


class FMIndex:
    """Backward search over runs of symbols from 1 on, joined by separators (0 in `text`)."""

    def __init__(self, text: np.ndarray, symbols: int):
        separators = text == 0
        runs = int(separators.sum())
        ordered = np.where(separators, np.cumsum(separators) - 1, text + runs - 1)
        self.suffixes = suffix_array(ordered)
        self.transform = text[self.suffixes - 1]  # of the first suffix: the last separator
        self.matrix = WaveletMatrix(self.transform, max(1, int(symbols).bit_length()))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1))))
        self.sampled = (self.suffixes % SAMPLE == 0) | (self.transform == 0)

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.matrix.rank(symbol, row)

    def search(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that start with each phrase; one with a symbol that the text lacks is not searched."""
        low = np.zeros(len(rows), np.int64)
        high = np.zeros(len(rows), np.int64)
        occurs = np.append(True, np.diff(self.before)[1:] > 0)
        able = np.arange(len(rows))
        for column in range(rows.shape[1]):
            able = able[occurs[rows[able, column]]]
        high[able] = len(self.transform)
        for column in reversed(range(rows.shape[1])):
            live = able[(rows[able, column] > 0) & (low[able] < high[able])]
            if not len(live):
                break
            symbol = rows[live, column]
            low[live], high[live] = self.step(symbol, low[live]), self.step(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk to the next sampled one, counting the steps."""
        at, steps, out = row.copy(), 0, np.zeros(len(row), np.int64)
        left = np.arange(len(row))
        while len(left):
            done = self.sampled[at]
            out[left[done]] = self.suffixes[at[done]] + steps
            left, at = left[~done], at[~done]
            at = self.step(self.transform[at], at)
            steps += 1
        return out


def occurrences(symbols: np.ndarray, first: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, word position) of every occurrence; words of text i are symbols[first[i]:first[i + 1]]."""
    none = np.zeros(0, np.int64)
    if not len(phrases.rows) or not len(symbols):
        return none, none
    known = symbols > 0
    joined = np.zeros(len(known) + 1, bool)
    joined[1:] = known
    joined[first[:-1]] = False
    starts = np.flatnonzero(known & ~joined[:-1])
    joined = np.zeros(len(known) + 1, bool)
    joined[:-1] = known
    joined[first] = False
    sizes = np.flatnonzero(known & ~joined[1:]) + 1 - starts
    starts, sizes = starts[sizes >= phrases.shortest], sizes[sizes >= phrases.shortest]
    if not len(starts):
        return none, none
    places = np.concatenate(([0], np.cumsum(sizes + 1)))
    text, origin = np.zeros(places[-1], np.int64), np.zeros(places[-1], np.int64)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.repeat(places[:-1], sizes) + within
    origin[at] = np.repeat(starts, sizes) + within
    text[at] = symbols[origin[at]]
    index = FMIndex(text, len(phrases.vocabulary))
    low, high = index.search(phrases.rows)
    found = np.repeat(np.arange(len(low)), high - low)
    row = np.arange(len(found)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[found]
    return found, origin[index.locate(row)]


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(zip(starts.tolist(), ends.tolist(), strict=True)):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


SPANS = "array<struct<word:bigint,end_word:bigint,first:bigint,last:bigint>>"


def _scan(batches: Iterator[pa.RecordBatch], phrases: Phrases) -> Iterator[pa.RecordBatch]:
    vocabulary = NameSet(phrases.vocabulary)
    span = pa.list_(pa.struct([(name, pa.int64()) for name in ("word", "end_word", "first", "last")]))
    for batch in batches:
        texts = column_texts(batch.column(1))
        for begin, end, piece in pieces(texts):
            words, names = word_names(piece)
            symbols = np.zeros(len(names), np.int64)
            where, which = vocabulary.find(names)
            symbols[where] = which + 1
            phrase, at = occurrences(symbols, words.first, phrases)
            doc = np.searchsorted(words.first, at, "right") - 1
            order = np.argsort(doc, kind="stable")
            phrase, at, doc = phrase[order], at[order], doc[order]
            spans: list[list] = [[] for _ in range(end - begin)]
            items: list[list] = [[] for _ in range(end - begin)]
            hits = np.zeros(end - begin, np.int64)
            bounds = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1], [True]))) if len(doc) else [0]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                d = int(doc[a])
                runs = merged(at[a:b], at[a:b] + phrases.lengths[phrase[a:b]])
                hits[d] = sum(y - x for x, y in runs)
                spans[d] = [
                    {
                        "word": int(x - words.first[d]),
                        "end_word": int(y - words.first[d]),
                        "first": int(words.starts[x] - piece.offsets[d]),
                        "last": int(words.ends[y - 1] - piece.offsets[d]),
                    }
                    for x, y in runs
                ]
                own = {i for p in set(phrase[a:b].tolist()) for i in phrases.items[slice(*phrases.item_first[p : p + 2])]}
                items[d] = sorted({str(phrases.ids[i]) for i in own})
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(begin, end - begin),
                    pa.array(np.diff(words.first), pa.int64()),
                    pa.array(hits, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(spans, span),
                ],
                names=["id", "n_words", "n_hit", "items", "spans"],
            )


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple]]:
    """The benchmark's items in blocks of about `block_words` words, one at a time on the driver."""
    block, words = [], 0
    rows = benchmark.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(id_col, text_col)
    for item, text in rows.toLocalIterator():
        block.append((item, text))
        words += len(WORD.findall(text))
        if words >= block_words:
            yield block
            block, words = [], 0
    if block:
        yield block


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document: n_words, n_hit (words inside an occurrence of a phrase), items (ids with occurrences, sorted as
    strings), spans (byte spans to remove, merged), and contaminated: hit words are at least a twentieth of all."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_words long, n_hit long, items array<string>, spans {SPANS}"
    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = []
    for block in benchmark_blocks(benchmark, item_id_col, item_text_col, block_words):
        found.append(pairs.sparkSession.sparkContext.broadcast(Phrases(block)))
    if not found:
        found.append(pairs.sparkSession.sparkContext.broadcast(Phrases([])))
    if len(found) == 1:
        result = pairs.mapInArrow(lean(lambda batches, p=found[0]: _scan(batches, p.value)), schema)
    else:
        result = _over_blocks(pairs, found, schema)
    share = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return result.withColumn("contaminated", share).withColumnRenamed("id", id_col)


def _over_blocks(pairs: DataFrame, blocks: list, schema: str) -> DataFrame:
    """Hits of several benchmark blocks. No text is shuffled: rows meet again by id and a hash of their text, and rows
    equal in both have equal hits."""
    keyed = pairs.withColumn("key", F.struct("id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("hash")))
    keyed = keyed.select(F.col("key").alias("id"), "text")
    kind = keyed.schema["id"].dataType.simpleString()
    schema = schema.replace(schema.split(",")[0], f"id {kind}", 1)
    scans = [keyed.mapInArrow(lean(lambda batches, p=p: _scan(batches, p.value)), schema) for p in blocks]
    hits = reduce(DataFrame.unionByName, [s.where("n_hit > 0").select("id", "items", "spans") for s in scans])
    gathered = hits.groupBy("id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
    )
    gathered = gathered.withColumn("spans", F.aggregate("spans", F.array().cast(SPANS), _append_span))
    rows = keyed.mapInArrow(lean(lambda batches, p=blocks[0]: _scan(batches, p.value)), schema).select("id", "n_words")
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["word"])
    joined = rows.join(gathered, rows["id"].eqNullSafe(gathered["id"]), "left").drop(gathered["id"])
    return joined.select(
        F.col("id.id").alias("id"),
        "n_words",
        F.coalesce(size, F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
    )


def _append_span(done, span):
    last = F.element_at(done, -1)
    grown = F.struct(
        last["word"].alias("word"),
        F.greatest(last["end_word"], span["end_word"]).alias("end_word"),
        last["first"].alias("first"),
        F.greatest(last["last"], span["last"]).alias("last"),
    )
    touches = (F.size(done) > 0) & (span["word"] <= last["end_word"])
    return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(
        F.concat(done, F.array(span))
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` less the contaminated rows; every other row stays as it is, also under an id that repeats."""
    rows = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    judged = contamination(rows, benchmark, "key", "text")
    return without_rows(docs, judged.where("contaminated AND key.id IS NOT NULL"), row_key(id_col, text_col))
