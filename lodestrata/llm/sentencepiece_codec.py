"""SentencePiece encoding and decoding by a streaming Viterbi search over a given vocabulary.

A text is a stream of bytes in which every blank is the meta sign; one meta sign goes before the text. The best path is
the one of largest total score. The stream is read in windows, and ids are committed as soon as the backpointer paths of all
survivors meet at one boundary; what follows it is carried into the next window. A survivor is a position that a later piece
may begin at, so there are never more of them than the longest piece has bytes. Two ways find where they meet:

- A position that no piece of the vocabulary spans is passed by every path. Segments between such positions are short in
  most texts and are searched side by side in numpy. Pieces are found there by a trie, from all positions at once: at each
  byte only the positions go on whose bytes still begin a piece.
- Elsewhere (one letter repeated, encoded data) the search goes byte by byte in steps. It keeps the scores of the survivors
  alone, and for each step the survivors of the step before that still have a descendant; where one is left, all paths meet.
  Where they never meet, as in a text of one letter, six bytes are kept for each byte until the text ends.

Where no piece has a meta sign after another character, paths also meet before every blank that follows another
character: the parts between, words mostly, are searched once per task and looked up after that, within a bound on bytes.
Arrow tells the distinct parts of a batch, so that Python handles each of them once, not each time it occurs.

Bytes that no piece covers become byte pieces, a meta sign that stands in the text itself among them, so decoding gives
back every text exactly. Scores of a unigram model are used as they are; a BPE model has ranks instead, which Zipf's law
turns into log probabilities. Of equal paths the one with the longer last piece wins; scores lie
on a fine binary grid, so sums are exact and ties fall the same way wherever a window ends.

Null stays null, the empty text has no pieces, rows that repeat are encoded alike, further columns stay as they are, and an
empty table gives an empty one. A very long text is searched whole, in the memory of its ids and a window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .frames import lean, ship, with_field

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
META = "▁".encode()
# Stand-ins, never part of UTF-8, for the bytes of a meta sign that the text itself has.
ESCAPED = b"\xf8\xf9\xfa"
ORIGINAL = dict(zip(ESCAPED, META, strict=True))
WINDOW_BYTES = 1 << 16
STEP_BYTES = 1 << 12
# Longer segments are searched byte by byte: side by side, each of their bytes would cost a round of numpy calls.
SIDE_BY_SIDE = 512
# Remembered parts, each with its entry in the table, take about this much memory in a task.
REMEMBERED_BYTES = 32 << 20
ENTRY_BYTES = 120
DECODED_AT_ONCE = 512
# Fixed values of the scores made from ranks: Zipf's law with this offset, and the cost of a byte piece.
ZIPF_OFFSET = 10.0
BYTE_COST = 30.0
# Scores are multiples of 1 / GRID.
GRID = 1 << 24


def _on_grid(score: float) -> float:
    return round(score * GRID) / GRID


class Vocabulary:
    """Pieces as bytes, their scores, and the ids of the 256 byte pieces; its size is that of the model file."""

    def __init__(self, pieces: list[bytes], scores: list[float], kinds: list[str]):
        """Kinds are "piece", "byte" (given as the byte itself) or "other" (decoded as nothing)."""
        self.pieces = [p.replace(META, b" ") if k == "piece" else p if k == "byte" else b"" for p, k in zip(pieces, kinds, strict=True)]
        self.is_byte = np.array([k == "byte" for k in kinds], bool)
        # For decoding many ids at once.
        self.table = pa.array(self.pieces, pa.large_binary())
        self.byte_ids = np.full(256, -1)
        for i, (piece, kind) in enumerate(zip(pieces, kinds, strict=True)):
            if kind == "byte":
                self.byte_ids[piece[0]] = i
        for stand_in, byte in ORIGINAL.items():
            self.byte_ids[stand_in] = self.byte_ids[byte]
        normal = [i for i, k in enumerate(kinds) if k == "piece" and pieces[i]]
        scores = [_on_grid(score) for score in scores]
        self.by_length = {}
        for length in sorted({len(pieces[i]) for i in normal}):
            own = [i for i in normal if len(pieces[i]) == length]
            self.by_length[length] = ([pieces[i] for i in own], np.array(own), np.array([scores[i] for i in own]))
        self.longest = max(self.by_length, default=1)
        self.byte_score = min((scores[i] for i in normal), default=0.0) - BYTE_COST
        self.splits = not any(re.search(b"[^ ] ", self.pieces[i].rstrip(b" ") + b" ") and b" " in self.pieces[i].lstrip(b" ") for i in normal)
        self.trie = Trie(self)


class Trie:
    """The pieces as a double array: the child of a node for a byte is `base[node] + byte`, if `parent` has the node there.

    Nodes below 256 are the bytes themselves, as pieces of one byte or else byte pieces; nodes of two bytes are in `pairs`.
    """

    def __init__(self, vocabulary: Vocabulary):
        known = {p: (i, s) for own in vocabulary.by_length.values() for p, i, s in zip(*own, strict=True)}
        children: dict[bytes, set[int]] = {}
        for piece in known:
            for k in range(2, len(piece)):
                children.setdefault(piece[:k], set()).add(piece[k])
        nodes = {bytes([b]): b for b in range(256)}
        free, begin, base = bytearray(b"\0" * 256), {}, {}
        # The largest families first, each at the first place where all of its bytes are free.
        for prefix, family in sorted(children.items(), key=lambda c: -len(c[1])):
            last, *rest = sorted(family, reverse=True)
            at = begin.get(len(family), 0)
            while True:
                free += b"\1" * (at + 512 - len(free))
                at = free.index(1, at)
                if at >= last and all(at - last + b >= 256 and free[at - last + b] for b in rest):
                    break
                at += 1
            begin[len(family)] = at
            base[prefix] = at - last
            for b in family:
                free[at - last + b] = 0
                nodes[prefix + bytes([b])] = at - last + b
        pairs = {p[:2] for p in known if len(p) > 1}
        nodes |= {p: i for i, p in enumerate(pairs, start=len(free))}
        size = len(free) + len(pairs) + 256
        self.base, self.parent = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.pairs = np.zeros(1 << 16, np.int32)
        self.ids, self.scores = np.full(size, -1), np.full(size, -np.inf)
        self.lengths, self.is_piece = np.zeros(size, np.int32), np.zeros(size, bool)
        self.ids[:256], self.scores[:256], self.lengths[:256] = vocabulary.byte_ids, vocabulary.byte_score, 1
        for prefix, place in base.items():
            self.base[nodes[prefix]] = place
            for b in children[prefix]:
                self.parent[place + b] = nodes[prefix]
        for p in pairs:
            self.pairs[p[0] << 8 | p[1]] = nodes[p]
        for p, (i, score) in known.items():
            node = nodes[p]
            self.ids[node], self.scores[node], self.lengths[node], self.is_piece[node] = i, score, len(p), True

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece in the data starts, and its node; shorter ones first, byte pieces included."""
        n = len(data)
        starts, nodes = [np.arange(n, dtype=np.int32)], [data.astype(np.int32)]
        node = self.pairs[(nodes[0][:-1] << 8) | nodes[0][1:]]
        at = np.flatnonzero(node).astype(np.int32)
        node, size = node[at], 2
        while len(at):
            own = np.flatnonzero(self.is_piece[node])
            starts.append(at[own])
            nodes.append(node[own])
            inside = int(np.searchsorted(at, np.int32(n - size)))
            at, node = at[:inside], node[:inside]
            child = self.base[node] + data[at + size]
            own = np.flatnonzero(self.parent[child] == node)
            at, node, size = at[own], child[own], size + 1
        return np.concatenate(starts), np.concatenate(nodes)


def load(path: str = DEFAULT_MODEL) -> Vocabulary:
    """The vocabulary of a SentencePiece model file, read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces, kinds, ranks = [], [], []
    for i in ids:
        text = model.id_to_piece(i)
        if model.is_byte(i):
            pieces.append(bytes([int(text[3:5], 16)]))
            kinds.append("byte")
        else:
            pieces.append(text.encode())
            kinds.append("other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "piece")
        ranks.append(model.get_score(i))
    normal = [r for r, k in zip(ranks, kinds, strict=True) if k == "piece"]
    if all(float(r).is_integer() for r in normal):
        total = np.log1p(len(normal) / ZIPF_OFFSET)
        ranks = [-float(np.log((ZIPF_OFFSET - r) * total)) for r in ranks]
    return Vocabulary(pieces, ranks, kinds)


def _matches(data: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, id, score) of every piece in the data, byte pieces included."""
    trie = vocabulary.trie
    start, node = trie.find(data)
    return start, start + trie.lengths[node], trie.ids[node], trie.scores[node]


def _meeting_points(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions 0..n that no match spans: all paths go through them. Of matches with one start the longest is the last."""
    reach = np.zeros(n + 1, np.int32)
    reach[starts + 1] = ends
    return np.flatnonzero(np.maximum.accumulate(reach) <= np.arange(n + 1))


def _best_path(points: np.ndarray, start: np.ndarray, node: np.ndarray, trie: Trie) -> tuple[np.ndarray, np.ndarray]:
    """End positions and ids of the best path from the first to the last meeting point, in order."""
    n = int(points[-1])
    inside = np.flatnonzero(start < n)
    start, node = start[inside], node[inside]
    # Positions equally deep in their segments are worked off together: no two pieces from them have the same end.
    depth = (np.arange(n) - np.repeat(points[:-1], np.diff(points))).astype(np.uint16)[start]
    order = np.argsort(depth, kind="stable")
    start, node = start[order], node[order]
    end, score = start + trie.lengths[node], trie.scores[node]
    bounds = np.concatenate(([0], np.cumsum(np.bincount(depth)))).tolist()
    best, back = np.full(n + 1, -np.inf), np.zeros(n + 1, np.int32)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        value = best[start[a:b]] + score[a:b] if a else score[:b]
        # From the front on, a later piece has to be better: of equal values the longest piece stays.
        own = np.flatnonzero(value > best[end[a:b]])
        to = end[a:b][own]
        best[to] = value[own]
        back[to] = node[a:b][own]
    root, on_path = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    root[points] = True
    at = points[1:]
    while len(at):
        on_path[at] = True
        at = at - trie.lengths[back[at]]
        at = at[~root[at]]
    ends = np.flatnonzero(on_path)
    return ends, trie.ids[back[ends]]


def _steps(data: np.ndarray, at: int, vocabulary: Vocabulary, window: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """End positions and ids of the best path from `at` on, up to the first boundary behind `window` bytes where the paths
    of all survivors meet, or to the end of the data."""
    far = vocabulary.longest
    step = max(step, far)
    scores, done = [0.0], at
    sizes, ids = [np.zeros(1, np.uint16)], [np.zeros(1, np.int32)]
    # For each step: the survivors at its end with their ancestors at the end of the step before, and those still needed.
    ancestors, needed = [{at: at}], [{at}]
    while True:
        upto, low = min(done + step, len(data)), max(at, done + 1 - far)
        start, end, piece, score = _matches(data[low:upto], vocabulary)
        new = np.flatnonzero(end > done - low)
        new = new[np.lexsort((start[new], end[new]))]
        start, end, piece = start[new], end[new], piece[new]
        best = scores[len(scores) - (done - low) - 1 :] + [-np.inf] * (upto - done)
        back = [0] * len(best)
        for i, (s, e, v) in enumerate(zip(start.tolist(), end.tolist(), score[new].tolist(), strict=True)):
            value = best[s] + v
            if value > best[e]:
                best[e], back[e] = value, i
        chosen = np.array(back[done - low + 1 :], np.int64)
        sizes.append((end[chosen] - start[chosen]).astype(np.uint16))
        ids.append(piece[chosen].astype(np.int32))
        origin = {}
        for p, size in enumerate(sizes[-1].tolist(), start=done + 1):
            origin[p] = p - size if p - size <= done else origin[p - size]
        if upto == len(data):
            return _traced(at, upto, sizes, ids)
        kept = range(upto + 1 - far, upto + 1)
        # Only differences count; on the grid they stay exact.
        scores = [v - best[-1] for v in best[-far:]]
        ancestors.append({p: origin[p] for p in kept})
        needed.append(set(kept))
        met = None
        for k in range(len(needed) - 1, 1, -1):
            alive = {ancestors[k][p] for p in needed[k]}
            if alive == needed[k - 1]:
                break
            needed[k - 1] = alive
        if upto - at >= window:
            met = next((min(s) for s in reversed(needed[1:]) if len(s) == 1), None)
        if met is not None:
            return _traced(at, met, sizes, ids)
        done = upto


def _traced(at: int, end: int, sizes: list[np.ndarray], ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The path from `end` back to `at`, in order."""
    size, own = np.concatenate(sizes), np.concatenate(ids)
    ends = []
    while end > at:
        ends.append(end - at)
        end -= int(size[end - at])
    places = np.array(ends[::-1], np.int64)
    return places + at, own[places].astype(np.int64)


def stream(
    data: np.ndarray, vocabulary: Vocabulary, window: int = WINDOW_BYTES, step: int = STEP_BYTES
) -> tuple[np.ndarray, np.ndarray]:
    """End positions and ids of the best path over `data`, window by window."""
    ends, ids, at, window = [], [], 0, max(window, 2 * vocabulary.longest)
    while at < len(data):
        part = data[at : at + window]
        start, node = vocabulary.trie.find(part)
        points = _meeting_points(len(part), start, start + vocabulary.trie.lengths[node])
        if at + window < len(data):
            # A piece that begins here may end beyond the window: only what no such piece can span is settled.
            points = points[points <= len(part) - vocabulary.longest + 1]
        points = points[: 1 + int(np.argmax(np.append(np.diff(points) > SIDE_BY_SIDE, True)))]
        if len(points) < 2:
            found, own = _steps(data, at, vocabulary, window, step)
            at = int(found[-1])
        else:
            found, own = _best_path(points, start, node, vocabulary.trie)
            found = found + at
            at += int(points[-1])
        ends.append(found)
        ids.append(own)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *ends]), np.concatenate([none, *ids])


def _parts(texts: list[bytes], splits: bool) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The parts of all texts, and the offsets of each text's own: blanks with the other characters that follow, and the
    blanks at the end of a text; without `splits`, whole texts."""
    joint = b"".join(texts)
    data = np.frombuffer(joint, np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    first = np.zeros(len(data) + 1, bool)
    if splits:
        blank = data == ord(" ")
        np.greater(blank[1:], blank[:-1], out=first[1:-1])
    first[bounds] = True
    starts = np.flatnonzero(first)
    parts = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(joint)])
    return parts.dictionary_encode(), np.searchsorted(starts, bounds)


class Encoder:
    """Encodes texts; parts between certain meeting points are remembered."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, parts: list[bytes]) -> None:
        """Search the new parts, those that end in another character than a blank in one stream: paths meet where such a
        part ends and the next begins. A piece may span the blanks at the end of a text and those of a next part."""
        joint = [p for p in parts if self.vocabulary.splits and not p.endswith(b" ")]
        alone = [p for p in parts if not self.vocabulary.splits or p.endswith(b" ")]
        sizes = np.array([len(p) + 2 * p.count(b" ") for p in joint], np.int64)
        ends, ids = stream(np.frombuffer(b"".join(joint).replace(b" ", META), np.uint8), self.vocabulary)
        solved = [stream(np.frombuffer(p.replace(b" ", META), np.uint8), self.vocabulary)[1] for p in alone]
        counts = np.searchsorted(ends, np.cumsum(sizes), "right")
        counts = np.concatenate((counts, len(ids) + np.cumsum([len(s) for s in solved], dtype=np.int64)))
        self.known.update(zip(joint + alone, range(len(self.first) - 1, len(self.first) - 1 + len(parts)), strict=True))
        self.held += ENTRY_BYTES * len(parts) + 5 * sum(map(len, parts))
        self.first = np.concatenate((self.first, self.first[-1] + counts))
        self.ids = np.concatenate((self.ids, ids.astype(np.int32), *[s.astype(np.int32) for s in solved]))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of each text's own."""
        if self.held > REMEMBERED_BYTES:
            self.__init__(self.vocabulary)
        marked = [b" " + t.replace(META, ESCAPED) if t else t for t in texts]
        parts, offsets = _parts(marked, self.vocabulary.splits)
        distinct = parts.dictionary.to_pylist()
        new = [p for p in distinct if p not in self.known]
        if new:
            self.learn(new)
        which = np.array([self.known[p] for p in distinct], np.int64)[parts.indices.to_numpy()]
        sizes = self.first[which + 1] - self.first[which]
        total = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(total[-1]) + np.repeat(self.first[which] - total[:-1], sizes)
        return self.ids[at], total[offsets]


def decode_lists(ids: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> pa.LargeBinaryArray:
    """The bytes of each list ids[offsets[i]:offsets[i + 1]].

    The blank before a text is dropped; ids outside the vocabulary stand for nothing.
    """
    known = (ids >= 0) & (ids < len(vocabulary.pieces))
    lists = np.concatenate(([0], np.cumsum(known)))[offsets]
    own = ids[known]
    data, ends = np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if len(own):
        _, places, joint = vocabulary.table.take(pa.array(own)).buffers()
        ends = np.frombuffer(places, np.int64)[: len(own) + 1]
        data = np.frombuffer(joint or b"", np.uint8)[: ends[-1]]
    bounds = ends[lists]
    filled = np.flatnonzero(bounds[1:] > bounds[:-1])
    blank = filled[(data[bounds[filled]] == ord(" ")) & ~vocabulary.is_byte[own[lists[filled]]]]
    data = np.delete(data, bounds[blank])
    shorter = np.zeros(len(bounds), np.int64)
    shorter[blank + 1] = 1
    bounds = bounds - np.cumsum(shorter)
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def decode_ids(ids, vocabulary: Vocabulary) -> str:
    """The text of a list of ids."""
    return decode_lists(np.asarray(ids, np.int64), np.array([0, len(ids)]), vocabulary)[0].as_py().decode("utf-8", "replace")


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text_col: str = "text",
    out_col: str = "piece_ids",
    check_col: str | None = None,
) -> DataFrame:
    """`docs` with the ids of each text in `out_col`.

    With `check_col` the ids are decoded again where they were made; the column says whether that gave back the text.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    added = [c for c in (out_col, check_col) if c is not None]
    rows = docs.select(*[c for c in docs.columns if c not in added])
    place = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for start, stop in _slices(batch.column(place)):
                part = batch.slice(start, stop - start)
                ids, offsets = encoder.encode(_texts(part.column(place)))
                nulls = np.asarray(part.column(place).is_null())
                bounds = pa.array(np.append(offsets[:-1], offsets[-1]), pa.int32(), mask=np.append(nulls, False))
                lists = pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32()))
                columns = [*part.columns, lists]
                if check_col is not None:
                    decoded = decode_lists(ids, offsets, shared.value)
                    same = pc.equal(decoded, part.column(place).cast(pa.large_binary()))
                    columns.append(same.fill_null(True))
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *added])

    schema = with_field(rows, out_col, T.ArrayType(T.IntegerType()))
    if check_col is not None:
        schema = T.StructType([*schema.fields, T.StructField(check_col, T.BooleanType())])
    return rows.mapInArrow(lean(run), schema)


def _slices(column: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    sizes = np.cumsum(pc.binary_length(column.fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        used = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, used + limit, "right")))
        yield start, min(stop, len(column))
        start = stop


def decode(docs: DataFrame, vocabulary: Vocabulary, ids_col: str = "piece_ids", out_col: str = "decoded") -> DataFrame:
    """`docs` with the text of each list of ids in `out_col`."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(*[c for c in docs.columns if c != out_col])
    place = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in (b.slice(at, DECODED_AT_ONCE) for b in batches for at in range(0, b.num_rows, DECODED_AT_ONCE)):
            texts = _decoded(batch.column(place), own)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, out_col])

    return rows.mapInArrow(lean(run), with_field(rows, out_col, T.StringType()))


def _decoded(column: pa.Array, vocabulary: Vocabulary) -> pa.Array:
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0]).fill_null(-1).to_numpy(zero_copy_only=False)
    found = decode_lists(values, offsets - offsets[0], vocabulary)
    try:
        texts = found.cast(pa.string())
    except pa.ArrowInvalid:  # ids that no text has may make bytes that are not UTF-8
        texts = pa.array([t.decode("utf-8", "replace") for t in found.to_pylist()], pa.string())
    return pc.if_else(column.is_null(), pa.scalar(None, pa.string()), texts)
