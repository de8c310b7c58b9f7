"""Text as bytes in numpy, for the insides of Arrow batches. Nothing here knows Spark."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# A batch is worked on in pieces of about this many bytes, so that memory follows the piece, not the batch.
# A text longer than that is a piece of its own.
PIECE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_MIX_BLOCK = 1 << 14

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes of the given inclusive ranges."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


# Digits, letters a to z and every byte of a character beyond ASCII.
WORD_BYTES = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    if np.ndim(x) != 1 or len(x) <= _MIX_BLOCK:
        return _mixed(x)
    # In blocks, the values stay in the processor's cache between the steps.
    out = np.empty(len(x), np.uint64)
    for at in range(0, len(x), _MIX_BLOCK):
        out[at : at + _MIX_BLOCK] = _mixed(x[at : at + _MIX_BLOCK])
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    y = x >> np.uint64(30)
    y ^= x
    y *= _MIX[0]
    y ^= y >> np.uint64(27)
    y *= _MIX[1]
    y ^= y >> np.uint64(31)
    return y


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def at_least(cls, n: int) -> None:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up))
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            for name, base in (("up", _BASE), ("down", inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: the name of any span of `data` follows from two of them."""
    Powers.at_least(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * Powers.up[: len(data)], out=out[1:])
    return out


def span_names(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit name for each span, equal for equal bytes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * Powers.down[starts])


def gram_names(sums: np.ndarray, size: int) -> np.ndarray:
    """The name of the `size` bytes from each position on."""
    n = max(0, len(sums) - size)
    return mix((sums[size:] - sums[:n]) * Powers.down[:n])


def pair_names(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A name for two neighbouring spans, from the names of both."""
    return mix(first * _BASE + mix(second + _MIX[0]))


class Texts(NamedTuple):
    """Texts one after the other: text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray


def column_texts(column: pa.Array) -> Texts:
    """The bytes of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if len(bounds) == 0:
        bounds = np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[bounds[0] : bounds[-1]], bounds - bounds[0])


def pieces(texts: Texts, limit: int = PIECE_BYTES, most: int = 1 << 14) -> Iterator[tuple[int, int, Texts]]:
    """Runs of at most `most` whole texts of about `limit` bytes: first index, last index + 1, and the texts."""
    n, start = len(texts.offsets) - 1, 0
    while start < n:
        stop = int(np.searchsorted(texts.offsets, texts.offsets[start] + limit, "right")) - 1
        stop = min(n, start + most, max(start + 1, stop))
        low, high = texts.offsets[start], texts.offsets[stop]
        yield start, stop, Texts(texts.data[low:high], texts.offsets[start : stop + 1] - low)
        start = stop


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # words of text i are first[i]:first[i + 1]

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_words(texts: Texts, is_word: np.ndarray = WORD_BYTES, folded: np.ndarray | None = None) -> Words:
    """Maximal runs of word bytes; a word never spans two texts."""
    data, offsets = (texts.data if folded is None else folded), texts.offsets
    inside = is_word[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets[:-1]] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def word_codes(texts: Texts, is_word: np.ndarray) -> tuple[Words, np.ndarray, pa.Array]:
    """The maximal runs of word bytes, a number for each, equal for equal bytes, and the distinct words by number."""
    words = find_words(texts, is_word)
    bounds = np.concatenate(([0], np.cumsum(words.ends - words.starts)))
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(texts.data[is_word[texts.data]])]
    coded = pa.Array.from_buffers(pa.large_binary(), len(words.starts), buffers).dictionary_encode()
    return words, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def word_names(texts: Texts, is_word: np.ndarray = WORD_BYTES) -> tuple[Words, np.ndarray]:
    """The words of lower-cased (A to Z) texts and their 64-bit names."""
    folded = LOWER[texts.data]
    words = find_words(texts, is_word, folded)
    return words, span_names(prefix_sums(folded), words.starts, words.ends)


def shingle_names(words: Words, names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all runs of `size` words, and the offsets of each text's own; a shorter text is one shingle."""
    counts = np.diff(words.first)
    own = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    offsets = np.concatenate(([0], np.cumsum(own)))
    text = np.repeat(np.arange(len(own)), own)
    at = np.arange(offsets[-1]) - offsets[text] + words.first[text]
    out = np.zeros(len(at), np.uint64)
    for step in range(size):
        there = at + step < words.first[text + 1]
        part = np.where(there, names[np.minimum(at + step, max(len(names) - 1, 0))], np.uint64(0)) if len(names) else out
        out = pair_names(out, part)
    return out, offsets


class NameSet:
    """Membership in a sorted set of names: a bit table rules most out, a binary search decides the rest."""

    def __init__(self, names: np.ndarray, bits: int = 20):
        self.names, self.bits = np.unique(names), bits
        self.table = np.zeros(1 << bits, bool)
        self.table[self._slot(self.names)] = True

    def _slot(self, names: np.ndarray) -> np.ndarray:
        return (names >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in `names` that are members, and where each stands in the sorted set."""
        maybe = np.flatnonzero(self.table[self._slot(names)])
        if not len(maybe) or not len(self.names):
            return maybe[:0], maybe[:0]
        at = np.searchsorted(self.names, names[maybe])
        at = np.minimum(at, len(self.names) - 1)
        hit = self.names[at] == names[maybe]
        return maybe[hit], at[hit]


def bucket_counts(texts: int, text_of: np.ndarray, buckets: np.ndarray, size: int) -> np.ndarray:
    """How often each text has each of `size` buckets, as one dense row per text."""
    flat = np.bincount(text_of * size + buckets, minlength=texts * size)
    return flat.reshape(texts, size).astype(np.float32)
