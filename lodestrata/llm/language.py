"""Language identification: averaged hashed subword embeddings and a linear softmax, trained in numpy.

A text's subwords are its three-byte strings, lower-cased (A to Z) with every other ASCII sign as a blank, hashed into
buckets. Their embeddings are averaged and classified by a linear softmax; both are trained by stochastic gradient
descent on a sample of about `per_language` rows of each language. A temperature fitted on a fifth of the sample makes
the scores probabilities. A document is rejected when it has no letter, or when its score is below the threshold that
`rejects` of the held-back rows fall short of, but never above one half.

Null texts and texts without a letter are `und` with score 0; a letter alone gets the classes' prior. Rows that repeat
are judged alike. With no labelled row at all everything is `und`. Other columns are ignored or, in `in_known_language`,
kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import lean
from .learning import Adagrad, bounded_sample, with_texts
from .text import LOWER, Texts, bucket_counts, column_texts, pieces

BITS = 14
SIZE = 1 << BITS
WIDTH = 16
UNKNOWN = "und"

FOLD = LOWER.copy()
FOLD[: ord("a")] = np.where((FOLD[: ord("a")] >= ord("a")), FOLD[: ord("a")], 32)
FOLD[ord("z") + 1 : 128] = 32


def subword_counts(texts: Texts) -> np.ndarray:
    n = len(texts.offsets) - 1
    data = FOLD[texts.data].astype(np.uint32)
    if len(data) < 3:
        return np.zeros((n, SIZE), np.float32)
    grams = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    buckets = ((grams * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)
    text_of = np.repeat(np.arange(n), np.diff(texts.offsets))[: len(grams)]
    inside = texts.offsets[text_of + 1] - np.arange(len(grams)) >= 3
    return bucket_counts(n, text_of[inside], buckets[inside], SIZE)


def averaged(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class LanguageModel:
    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, threshold: float):
        self.languages, self.table, self.bias = languages, table, bias
        self.temperature, self.threshold = temperature, threshold

    def scores(self, texts: Texts) -> np.ndarray:
        return softmax((averaged(subword_counts(texts)) @ self.table + self.bias) * self.temperature)


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]], rejects: float, epochs: int = 12, seed: int = 7) -> LanguageModel:
    """`samples` are (language, buckets, counts) in any order."""
    languages = sorted({s[0] for s in samples})
    if not languages:
        return LanguageModel([], np.zeros((SIZE, 1), np.float32), np.zeros(1, np.float32), 1.0, 0.0)
    number = {name: i for i, name in enumerate(languages)}
    labels = np.array([number[s[0]] for s in samples])
    random = np.random.default_rng(seed)
    order = random.permutation(len(samples))
    held = order[: len(samples) // 5] if len(samples) >= 50 else order
    train = order[len(samples) // 5 :] if len(samples) >= 50 else order
    params = {
        "embedding": random.normal(0, 0.1, (SIZE, WIDTH)).astype(np.float32),
        "weights": random.normal(0, 0.1, (WIDTH, len(languages))).astype(np.float32),
        "bias": np.zeros(len(languages), np.float32),
    }

    def dense(rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), SIZE), np.float32)
        for i, r in enumerate(rows):
            x[i, samples[r][1]] = samples[r][2]
        return averaged(x)

    optimiser = Adagrad(0.3)
    for _ in range(epochs):
        train = random.permutation(train)
        for start in range(0, len(train), 64):
            rows = train[start : start + 64]
            x = dense(rows)
            hidden = x @ params["embedding"]
            error = softmax(hidden @ params["weights"] + params["bias"])
            error[np.arange(len(rows)), labels[rows]] -= 1
            error /= len(rows)
            slope = {"weights": hidden.T @ error, "bias": error.sum(0), "embedding": x.T @ (error @ params["weights"].T)}
            for name, gradient in slope.items():
                optimiser.step(name, params[name], gradient)
    table = params["embedding"] @ params["weights"]
    logits = np.concatenate([dense(held[i : i + 256]) @ table + params["bias"] for i in range(0, len(held), 256)])
    truth = labels[held]
    losses = {t: -np.log(softmax(logits * t)[np.arange(len(held)), truth] + 1e-12).mean() for t in np.geomspace(0.1, 10, 41)}
    temperature = min(losses, key=losses.get)
    best = softmax(logits * temperature).max(1)
    return LanguageModel(languages, table, params["bias"], temperature, min(0.5, float(np.quantile(best, rejects))))


def train(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = 600, rejects: float = 0.001,
) -> LanguageModel:
    """Fit on a bounded sample of `labelled`: about `per_language` rows for each of its languages."""
    usable = labelled.where(has_letter(F.col(text_col)))
    sample = bounded_sample(usable.select(F.col(id_col).alias("id"), F.col(lang_col).alias("label")), per_language)
    rows = with_texts(usable.select(id_col, text_col), sample, id_col).select("__label", text_col)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, piece in pieces(column_texts(batch.column(1)), most=256):
                counts = subword_counts(piece)
                found = [np.flatnonzero(row) for row in counts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        pa.array([f.astype(np.uint16).tobytes() for f in found], pa.binary()),
                        pa.array([c[f].astype(np.float32).tobytes() for c, f in zip(counts, found, strict=True)], pa.binary()),
                    ],
                    names=["label", "buckets", "counts"],
                )

    taken = rows.mapInArrow(lean(features), "label string, buckets binary, counts binary").collect()
    samples = [(r[0], np.frombuffer(r[1], np.uint16).astype(np.int64), np.frombuffer(r[2], np.float32)) for r in taken]
    return fit(sorted(samples, key=lambda s: (s[0], s[1].tobytes(), s[2].tobytes())), rejects)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _judged(piece: Texts, letters: np.ndarray, own: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Predicted language, its probability, and whether the model rejects each text."""
    known = letters & bool(own.languages)
    chances = own.scores(piece)
    best = chances.argmax(1)
    score = np.where(known, chances[np.arange(len(best)), best], 0.0).astype(float)
    names = [own.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
    return names, score, ~known | (score < own.threshold)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: lang_pred, score (the predicted language's probability) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column(2).to_numpy(zero_copy_only=False)
            for begin, end, piece in pieces(column_texts(batch.column(1)), most=256):
                names, score, rejected = _judged(piece, letters[begin:end], shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                    names=["id", "lang_pred", "score", "rejected"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), has_letter(F.col(text_col)).alias("letters"))
    judged = rows.mapInArrow(lean(judge), f"id {kind}, lang_pred string, score double, rejected boolean")
    return judged.withColumnRenamed("id", id_col)


def in_known_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """`docs` less the rows that the model rejects. Each row is judged where it lies, by its text alone; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *own, letters = batch.columns
            letters = letters.to_numpy(zero_copy_only=False)
            rows = pa.RecordBatch.from_arrays(own, names=batch.schema.names[:-1])
            for begin, end, piece in pieces(column_texts(rows.column(text_col)), most=256):
                rejected = _judged(piece, letters[begin:end], shared.value)[2]
                yield rows.slice(begin, end - begin).filter(pa.array(~rejected))

    return docs.select("*", has_letter(F.col(text_col)).alias("__letters")).mapInArrow(lean(keep), docs.schema)
