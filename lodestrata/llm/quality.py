"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document is one sparse vector: its words hashed into buckets (counts of length one), statistics of its bytes, words and
lines, and the metadata column `n_chars` where there is one. Besides a weight, every feature has a short vector; the
interaction of all pairs is half of (sum of vectors) squared less the sum of squared vectors, which takes time linear in
the features. Trained by mini-batches in numpy on a sample of about `per_class` rows of each class.

Null is the empty text, which gets the score of its statistics. Rows that repeat are scored alike. Without labelled rows
every score is one half. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learning import Adagrad, bounded_sample, sigmoid, with_texts
from .text import Texts, bucket_counts, byte_class, column_texts, pieces, word_names

BITS = 13
SIZE = 1 << BITS
RANK = 8

_CLASSES = {
    "upper": byte_class((65, 90)),
    "lower": byte_class((97, 122)),
    "digit": byte_class((48, 57)),
    "blank": byte_class((9, 13), (32, 32)),
    "line": byte_class((10, 10)),
    "mark": byte_class((33, 47), (58, 64), (91, 96), (123, 126)),
    "stop": byte_class((46, 46), (63, 63)),
    "shout": byte_class((33, 33)),
    "bar": byte_class((124, 124)),
    "wide": byte_class((128, 255)),
}
STATISTICS = len(_CLASSES) + 7


def _share(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def features(texts: Texts, n_chars: np.ndarray) -> np.ndarray:
    """One dense row per text: word buckets of length one, then the raw statistics."""
    n = len(texts.offsets) - 1
    words, names = word_names(texts)
    owner = words.text_of()
    counts = bucket_counts(n, owner, (names >> np.uint64(64 - BITS)).astype(np.int64), SIZE)
    data, offsets, count = texts.data, texts.offsets, np.diff(words.first)
    shares = [_share(table[data], offsets) for table in _CLASSES.values()]
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & _CLASSES["mark"][data[1:]]
    chars = np.concatenate(([0], np.cumsum(words.ends - words.starts)))
    filled = (counts > 0).sum(1)
    more = [
        _share(same, offsets),
        np.log1p(np.diff(offsets)),
        np.log1p(count),
        (chars[words.first[1:]] - chars[words.first[:-1]]) / np.maximum(count, 1),
        filled / np.maximum(count, 1),
        counts.max(1) / np.maximum(count, 1),
        np.log1p(np.maximum(np.nan_to_num(n_chars), 0)),
    ]
    statistics = np.stack(shares + more, 1).astype(np.float32)
    length = np.sqrt((counts * counts).sum(1, keepdims=True))
    return np.concatenate((counts / np.maximum(length, 1), statistics), 1)


class FactorisationMachine:
    def __init__(self, seed: int = 11):
        random = np.random.default_rng(seed)
        width = SIZE + STATISTICS
        self.params = {
            "bias": np.zeros(1, np.float32),
            "weights": np.zeros(width, np.float32),
            "vectors": random.normal(0, 0.02, (width, RANK)).astype(np.float32),
        }
        self.center, self.spread = np.zeros(STATISTICS, np.float32), np.ones(STATISTICS, np.float32)

    def prepared(self, x: np.ndarray) -> np.ndarray:
        x = x.copy()
        x[:, SIZE:] = np.clip((x[:, SIZE:] - self.center) / self.spread, -4, 4) / np.sqrt(STATISTICS)
        return x

    def raw(self, x: np.ndarray) -> np.ndarray:
        """The machine's value, in time linear in the features."""
        vectors = self.params["vectors"]
        total = x @ vectors
        pairs = 0.5 * (total * total - (x * x) @ (vectors * vectors)).sum(1)
        return self.params["bias"][0] + x @ self.params["weights"] + pairs

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(self.prepared(x)))

    def fit(self, rows: list[tuple[int, float, np.ndarray, np.ndarray, np.ndarray]], epochs: int = 8, seed: int = 5):
        """Rows are (label, weight, buckets, values, statistics)."""
        if not rows:
            return self
        statistics = np.stack([r[4] for r in rows])
        self.center, self.spread = statistics.mean(0), statistics.std(0) + 1e-3
        labels, weights = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32)
        random, optimiser = np.random.default_rng(seed), Adagrad(0.1)
        for _ in range(epochs):
            order = random.permutation(len(rows))
            for start in range(0, len(order), 64):
                at = order[start : start + 64]
                x = np.zeros((len(at), SIZE + STATISTICS), np.float32)
                for i, r in enumerate(at):
                    x[i, rows[r][2]] = rows[r][3]
                    x[i, SIZE:] = rows[r][4]
                x = self.prepared(x)
                vectors = self.params["vectors"]
                error = (sigmoid(self.raw(x)) - labels[at]) * weights[at] / weights[at].sum()
                weighted = x * error[:, None]
                square = (x * weighted).sum(0)[:, None]
                slope = {
                    "bias": error.sum(keepdims=True),
                    "weights": weighted.sum(0) + 1e-5 * self.params["weights"],
                    "vectors": weighted.T @ (x @ vectors) - square * vectors + 1e-5 * vectors,
                }
                for name, gradient in slope.items():
                    optimiser.step(name, self.params[name], gradient.astype(np.float32))
        return self


def _rows(docs: DataFrame, text_col: str, *columns) -> DataFrame:
    chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select(*columns, F.col(text_col).alias("text"), F.coalesce(chars, F.lit(0.0)).alias("n_chars"))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    per_class: int = 1500,
) -> FactorisationMachine:
    """Fit on a bounded sample of the labelled rows: about `per_class` of each class."""
    sample = bounded_sample(labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")), per_class)
    joined = with_texts(docs, sample, id_col)
    rows = _rows(joined, text_col, F.col("__label").cast("int").alias("label"), F.col("__weight").alias("weight"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars = batch.column(3).to_numpy()
            for begin, end, piece in pieces(column_texts(batch.column(2)), most=256):
                x = features(piece, chars[begin:end])
                found = [np.flatnonzero(row[:SIZE]) for row in x]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        batch.column(1).slice(begin, end - begin),
                        pa.array([f.astype(np.uint16).tobytes() for f in found], pa.binary()),
                        pa.array([row[f].tobytes() for row, f in zip(x, found, strict=True)], pa.binary()),
                        pa.array([row[SIZE:].tobytes() for row in x], pa.binary()),
                    ],
                    names=["label", "weight", "buckets", "amounts", "statistics"],
                )

    taken = rows.mapInArrow(take, "label int, weight double, buckets binary, amounts binary, statistics binary").collect()
    kinds = (np.uint16, np.float32, np.float32)
    parts = [(r[0], r[1], *[np.frombuffer(r[k + 2], t) for k, t in enumerate(kinds)]) for r in taken]
    parts = sorted(parts, key=lambda r: (r[0], r[2].tobytes(), r[3].tobytes()))
    return FactorisationMachine().fit([(a, w, b.astype(np.int64), v, s) for a, w, b, v, s in parts])


def score(docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its score, the chance of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            chars = batch.column(2).to_numpy()
            for begin, end, piece in pieces(column_texts(batch.column(1)), most=256):
                found = own.score(features(piece, chars[begin:end])).astype(float)
                ids = batch.column(0).slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found)], names=["id", "score"])

    rows = _rows(docs, text_col, F.col(id_col).alias("id"))
    return rows.mapInArrow(judge, f"id {kind}, score double").withColumnRenamed("id", id_col)
