"""Removal of repeated byte strings by bucket-pointer refinement.

Positions with equal first q bytes share a bucket. A bucket's identifier is a 64-bit name of those bytes, the same in
every task, so no task needs the ranks of another. Buckets are refined by the identifiers of later offsets, and every
refinement is reused by the next: 10 bytes and the 10 after them give 20, twice 20 give 40, and 40 with the last 10 give
50. The names of 50 bytes are pairs of two independent names.

All documents are spread over batches of some megabytes by a hash of their id, and the text is shuffled once. Three rounds
follow; in each, batches send the distinct names they have with the smallest id of each, parts of the name space sort what
they get, and answer each batch in the order it sent.

1. Seeds: the smallest 20-byte bucket of each window of 50 bytes, so equal windows choose alike. Answer: is it shared?
2. Runs: neighbouring windows with one shared seed are sent as one name, that of all their bytes. Answer: the smallest id
   with the same run, and whether the seed has other runs as well. A run that a smaller id has is covered.
3. Windows: where a seed has several runs, the first document of each run sends the 50-byte names in it. Answer: the
   smallest id with the same window.

Within a batch a name is sent once, so a string in a third of all documents is one entry per batch. Seeds are cut to 48
bits: two that are taken for one only cost a look in round two. Runs and windows have 96 bits.

Null and empty texts have no bytes. Equal ids do not remove each other's strings, and a row with a null id neither loses
bytes nor takes any. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import text_bytes
from .text import NameSet, Texts, column_texts, gram_names, mix, pair_names, pieces, prefix_sums, span_names

LENGTH = 50
SEED_BYTES = 10
SEED_BITS = 48
BATCH_BYTES = 2 << 20
# Bytes worked on at once, so few that the names of their positions stay in the processor's cache.
CACHED_BYTES = 1 << 18
PART_ENTRIES = 1 << 18
ORDERED = np.uint64(0x9E3779B97F4A7C15)
NO_ID = np.iinfo(np.int64).min
SCRAMBLE = mix(np.arange(256, dtype=np.uint64)).astype(np.uint8)

SEEDS, RUNS, WINDOWS = range(3)
# The columns of a name in each round; the first one is sorted on.
NAME_TYPES = {SEEDS: (np.uint64,), RUNS: (np.uint64, np.uint64, np.uint32), WINDOWS: (np.uint64, np.uint32)}


def pack(*columns: np.ndarray) -> bytes:
    """Byte planes: equal high bytes stand together, where compression finds them."""
    return b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)


def unpack(data: bytes, count: int, *kinds) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, count * size, at).reshape(size, count)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += count * size
    return out


class Buckets:
    """Bucket names of the positions of some texts: 20 bytes, refined from two times 10, and the runs they form."""

    def __init__(self, texts: Texts):
        n = len(texts.data)
        self.count = max(0, n - LENGTH + 1)
        edges = np.zeros(n + 1, np.int8)
        long = np.flatnonzero(np.diff(texts.offsets) >= LENGTH)
        np.add.at(edges, texts.offsets[long], 1)
        np.add.at(edges, texts.offsets[long + 1] - LENGTH + 1, -1)
        self.inside = np.cumsum(edges, dtype=np.int8)[: self.count].astype(bool)
        self.texts, self.sums = texts, prefix_sums(texts.data)
        ten = gram_names(self.sums, SEED_BYTES)
        # The names of 10 bytes are mixed already; here only the order of the two has to count.
        self.twenty = mix(ten[: max(0, n - 19)] * ORDERED + ten[10 : max(10, n - 9)])

    def chosen(self) -> np.ndarray:
        """For each window of 50 bytes the smallest of the 31 buckets of 20 bytes in it."""
        low = self.twenty
        for step in (1, 2, 4, 8):
            low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        return np.minimum(low[: self.count], low[15 : 15 + self.count])

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Neighbouring windows of one document with one seed: first window, last window + 1, seed."""
        if not self.count:
            none = np.zeros(0, np.int64)
            return none, none, none.astype(np.uint64)
        low, change = self.chosen(), np.ones(self.count, bool)
        change[1:] = (low[1:] != low[:-1]) | (self.inside[1:] != self.inside[:-1])
        change[self.texts.offsets[:-1][self.texts.offsets[:-1] < self.count]] = True
        first = np.flatnonzero(change)
        last = np.append(first[1:], self.count)
        real = self.inside[first]
        # Smallest values crowd at zero; mixed again, the parts of the name space get equal shares.
        return first[real], last[real], mix(low[first[real]]) >> np.uint64(64 - SEED_BITS)

    def run_names(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = last + LENGTH - 1
        other = span_names(prefix_sums(SCRAMBLE[self.texts.data]), first, ends)
        return span_names(self.sums, first, ends), (other >> np.uint64(32)).astype(np.uint32)


def window_names(texts: Texts, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of the 50-byte windows at `at`, refined from 10 to 20, 40 and 50 bytes."""
    sums = prefix_sums(texts.data)
    tens = [span_names(sums, at + k, at + k + SEED_BYTES) for k in range(0, LENGTH, SEED_BYTES)]
    low, high = pair_names(tens[0], tens[1]), pair_names(tens[2], tens[3])
    other = pair_names(mix(high + np.uint64(7)), low)
    second = pair_names(tens[4], other) >> np.uint64(32)
    return pair_names(pair_names(low, high), tens[4]), second.astype(np.uint32)


class Sent:
    """The distinct names that a batch sends, in order, with the smallest id of each."""

    def __init__(self, names: list[np.ndarray], ids: np.ndarray):
        order, starts, self.several = ordered_groups(names, ids)
        self.names, self.ids = [n[order[starts]] for n in names], ids[order[starts]]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))

    def rows(self, batch: int, parts: int, kind: int) -> Iterator[dict]:
        """One row per part of the name space."""
        bits = SEED_BITS if kind != WINDOWS else 64
        part = self.names[0] // np.uint64(min(-(-(1 << bits) // parts), (1 << 64) - 1))
        bounds = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else [0]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            first = np.diff(self.names[0][a:b], prepend=np.uint64(0))
            columns = [first, *[n[a:b] for n in self.names[1:]]] + ([] if kind == SEEDS else [self.ids[a:b]])
            flags = np.packbits(self.several[a:b]).tobytes()
            yield {"part": int(part[a]), "batch": batch, "count": int(b - a), "entries": pack(*columns) + flags}


def ordered_groups(names: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by names and id; where each name starts in it; and whether a name has more than one id."""
    order = np.lexsort((ids, *names[::-1]))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([n[order[1:]] != n[order[:-1]] for n in names], axis=0)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(order)) - 1
    return order, starts, ids[order[starts]] < ids[order[ends]] if len(order) else np.zeros(0, bool)


ENTRY = "part long, batch long, count long, entries binary"
ENTRY_SCHEMA = pa.schema([("part", pa.int64()), ("batch", pa.int64()), ("count", pa.int64()), ("entries", pa.binary())])
ANSWER = "batch long, kind long, part long, count long, answer binary"
ANSWER_SCHEMA = pa.schema(
    [("batch", pa.int64()), ("kind", pa.int64()), ("part", pa.int64()), ("count", pa.int64()), ("answer", pa.binary())]
)


def _answer(kind: int) -> Callable[[pa.Table], pa.Table]:
    """Sorts one part's entries and answers every row of them: flags, and for runs and windows the smallest ids."""

    def answer(entries: pa.Table) -> pa.Table:
        rows = entries.to_pylist()
        # A seed is shared when two batches have it, as no id is in two, or when one batch says so: ids are not sent.
        kinds = NAME_TYPES[kind] + (() if kind == SEEDS else (np.int64,))
        columns, several = [], []
        for row in rows:
            own = unpack(row["entries"], row["count"], *kinds)
            own[0] = np.cumsum(own[0], dtype=np.uint64)
            if kind == SEEDS:
                own.append(np.full(row["count"], row["batch"], np.int64))
            columns.append(own)
            used = row["count"] * sum(np.dtype(k).itemsize for k in kinds)
            several.append(np.unpackbits(np.frombuffer(row["entries"], np.uint8, -1, used), count=row["count"]).astype(bool))
        *names, ids = [np.concatenate(c) for c in zip(*columns, strict=True)]
        order, starts, shared = ordered_groups(names, ids)
        group = np.empty(len(order), np.int64)
        group[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        shared[group[np.concatenate(several)]] = True
        smallest = ids[order[starts]]
        flags = shared
        if kind == RUNS:
            seeds = names[0][order[starts]]
            same = np.zeros(len(seeds) + 1, bool)
            same[1:-1] = seeds[1:] == seeds[:-1]
            flags = same[1:] | same[:-1]
        out, at = [], 0
        for row in rows:
            mine = group[at : at + row["count"]]
            at += row["count"]
            data = np.packbits(flags[mine]).tobytes()
            if kind != SEEDS:
                data = pack(smallest[mine]) + data
            out.append({"batch": row["batch"], "kind": kind, "part": row["part"], "count": row["count"], "answer": data})
        return pa.Table.from_pylist(out, schema=ANSWER_SCHEMA)

    return answer


class Batch:
    """One batch of documents, and what the answers so far say about it."""

    def __init__(self, docs: pa.Table, answers: pa.Table | None):
        self.docs = docs
        self.number = docs["batch"][0].as_py()
        ids = docs["id"].combine_chunks()
        self.known = ~np.asarray(ids.is_null())
        self.ids = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.answers = sorted(answers.to_pylist(), key=lambda r: r["part"]) if answers is not None else []

    def pieces(self) -> Iterator[tuple[int, int, Texts]]:
        yield from pieces(column_texts(self.docs["text"]), CACHED_BYTES)

    def answer(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Flags and smallest ids, in the order in which this batch sent its names."""
        flags, ids = [np.zeros(0, bool)], [np.zeros(0, np.int64)]
        for row in self.answers:
            if row["kind"] == kind:
                used = 0 if kind == SEEDS else 8 * row["count"]
                if used:
                    ids += unpack(row["answer"], row["count"], np.int64)
                packed = np.frombuffer(row["answer"], np.uint8, -1, used)
                flags.append(np.unpackbits(packed, count=row["count"]).astype(bool))
        return np.concatenate(flags), np.concatenate(ids)

    def runs(self) -> list[tuple]:
        """Per piece its runs: first window, last window + 1, row, seed, and the two names of the run's bytes."""
        out = []
        for begin, _, piece in self.pieces():
            buckets = Buckets(piece)
            first, last, seed = buckets.runs()
            row = np.searchsorted(piece.offsets, first, "right") - 1 + begin
            keep = self.known[row]
            first, last, seed, row = first[keep], last[keep], seed[keep], row[keep]
            out.append((first, last, row, seed, *buckets.run_names(first, last)))
        return out

    def seeds(self, runs: list[tuple]) -> Sent:
        return Sent([np.concatenate([r[3] for r in runs])], self.ids[np.concatenate([r[2] for r in runs])])

    def sent_runs(self) -> tuple[list[tuple], Sent]:
        """The runs with a shared seed, and what the batch sends of them."""
        runs = self.runs()
        sent, lift = self.seeds(runs), np.uint64(64 - SEED_BITS)
        shared = NameSet(sent.names[0][self.answer(SEEDS)[0]] << lift)
        kept = []
        for run in runs:
            at, _ = shared.find(run[3] << lift)
            kept.append(tuple(column[at] for column in run))
        names = [np.concatenate([k[c] for k in kept]) for c in (3, 4, 5)]
        return kept, Sent(names, self.ids[np.concatenate([k[2] for k in kept])])

    def open_windows(self) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[tuple[np.ndarray, np.ndarray]], Sent]:
        """Per piece the covered runs and the windows still in question (position, row); and the names of the latter."""
        found, sent = self.sent_runs()
        flags, smallest = self.answer(RUNS)
        flags, smallest = flags[sent.place], smallest[sent.place]
        covered, windows, names, ids, at = [], [], [], [], 0
        for (_, _, piece), (first, last, row, *_) in zip(self.pieces(), found, strict=True):
            several, low = flags[at : at + len(first)], smallest[at : at + len(first)]
            at += len(first)
            later = low < self.ids[row]
            covered.append((first[later], last[later] + LENGTH - 1))
            asked = ~later & several
            size = (last - first)[asked]
            spot = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[asked], size)
            windows.append((spot, np.repeat(row[asked], size)))
            if len(spot):
                names.append(window_names(piece, spot))
                ids.append(self.ids[windows[-1][1]])
        columns = [np.concatenate(c) for c in zip(*names, strict=True)] if names else [np.zeros(0, t) for t in NAME_TYPES[WINDOWS]]
        return covered, windows, Sent(columns, np.concatenate(ids) if ids else np.zeros(0, np.int64))


def _send(kind: int, parts: int) -> Callable:
    def send(docs: pa.Table, answers: pa.Table | None = None) -> pa.Table:
        rows: Iterator[dict] = iter(())
        if docs.num_rows:
            batch = Batch(docs, answers)
            sent = (lambda: batch.seeds(batch.runs()), lambda: batch.sent_runs()[1], lambda: batch.open_windows()[2])[kind]()
            rows = sent.rows(batch.number, parts, kind)
        return pa.Table.from_pylist(list(rows), schema=ENTRY_SCHEMA)

    return send


SPAN = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
MARKED = pa.schema(
    [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", SPAN), ("kept", pa.binary())]
)


def _mark(docs: pa.Table, answers: pa.Table) -> pa.Table:
    if not docs.num_rows:
        return MARKED.empty_table()
    batch = Batch(docs, answers)
    covered, windows, sent = batch.open_windows()
    smallest = batch.answer(WINDOWS)[1][sent.place]
    out, at = [], 0
    for (begin, end, piece), runs, (spot, row) in zip(batch.pieces(), covered, windows, strict=True):
        n = len(piece.data)
        hit = spot[smallest[at : at + len(spot)] < batch.ids[row]]
        at += len(spot)
        cover = np.zeros(n + 1, np.int64)
        for place, change in ((runs[0], 1), (runs[1], -1), (hit, 1), (hit + LENGTH, -1)):
            np.add.at(cover, place, change)
        inside = np.cumsum(cover)[:n] > 0
        edge = np.zeros(n + 1, bool)
        edge[1:n] = inside[1:] != inside[:-1]
        edge[piece.offsets] = True
        for a, b in zip(piece.offsets[:-1], piece.offsets[1:], strict=True):
            mine, kept, spans = inside[a:b], piece.data[a:b], []
            removed = int(mine.sum())
            if removed:
                cuts = np.append(np.flatnonzero(edge[a:b]), b - a)
                spans = [{"first": int(x), "last": int(y)} for x, y in zip(cuts[:-1], cuts[1:], strict=True) if mine[x]]
                kept = kept[~mine]
            out.append((int(b - a), removed, spans, kept.tobytes()))
    columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), list(MARKED)[1:], strict=True)]
    return pa.Table.from_arrays([docs["id"].combine_chunks(), *columns], schema=MARKED)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_bytes, n_removed, spans (maximal removed runs of bytes) and kept (the other bytes, in order).

    A byte is removed when a 50-byte string covers it that also starts in a document with a smaller id.
    """
    total = text_bytes(docs, text_col)
    batches = max(1, -(-total // BATCH_BYTES))
    parts = max(1, -(-total // (12 * PART_ENTRIES)))
    number, text = F.col(id_col).cast("long"), F.col(text_col)
    # A null id gives every row the same hash: such rows are spread by their text instead.
    spread = F.when(number.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(number))
    rows = docs.select(F.pmod(spread, F.lit(batches)).alias("batch"), number.alias("id"), text.alias("text"))
    by_batch = rows.groupBy("batch")

    def ask(kind: int, sent: DataFrame) -> DataFrame:
        return sent.groupBy("part").applyInArrow(_answer(kind), ANSWER)

    def with_answers(answers: DataFrame):
        return by_batch.cogroup(answers.groupBy("batch"))

    seeds = ask(SEEDS, by_batch.applyInArrow(lambda t: _send(SEEDS, parts)(t), ENTRY))
    send_runs, send_windows = _send(RUNS, parts), _send(WINDOWS, parts)
    runs = ask(RUNS, with_answers(seeds).applyInArrow(lambda d, a: send_runs(d, a), ENTRY))
    heard = seeds.unionByName(runs)
    windows = ask(WINDOWS, with_answers(heard).applyInArrow(lambda d, a: send_windows(d, a), ENTRY))
    schema = "id long, n_bytes long, n_removed long, spans array<struct<first:bigint,last:bigint>>, kept binary"
    marked = with_answers(heard.unionByName(windows)).applyInArrow(_mark, schema)
    return marked.withColumnRenamed("id", id_col)
