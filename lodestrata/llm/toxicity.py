"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses and each clause becomes a string of word classes: insult, threat, target, negation, reporting
verb, other. Weighted transducers rewrite that string one after the other: negation turns an insult or threat within three
words into its denied form, reported speech turns everything after a reporting verb of the clause into its quoted form, and
the target transducer tells insults and threats near a person, up to three words before or after, from loose ones. Each of
them weighs what it rewrites. The transducers are composed, weights multiplied, into one deterministic machine, which reads
each clause once and emits what it matched; a match counts its word's weight times the weight of its path. A document's
strength is the sum over its matched words of their strongest match, so a word alone never decides: where and how it stands
does. A logistic curve of it, fitted on a bounded labelled sample, is the score.

Words and their weights are learned from the same sample in every language alike: a word's weight is the lower bound of its
log odds ratio between toxic and other documents, and words above `LEAST_LIFT` with `LEAST_CONTEXTS` contexts are insults.
Evidence is counted in distinct contexts (the two neighbours), since copies of one document say nothing new. The smallest
support is a constant and does not grow with the sample. A listed insult that the sample contradicts is dropped. The curve is
fitted on the strengths that each half of the sample gets from the words learned on the other half. Target, negation and
reporting words are listed for English; elsewhere a match is a plain one.

Null and empty texts match nothing and get the base rate, as any text without a match. Rows that repeat are scored alike, and
equal strengths get equal scores. Without labelled rows the grammar's own weights decide. Texts are worked on whole, very long
ones in some twenty times their bytes. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learning import bounded_sample, sigmoid, with_texts
from .text import LOWER, NameSet, Texts, byte_class, column_texts, pair_names, pieces, word_codes, word_names

# The words of each class.
INSULTS = (
    "airhead bastard bitch bonehead brainless buffoon clown coward cretin crook deadbeat degenerate dimwit dirtbag "
    "disgusting dolt douchebag dumb dumbass dunce fool foolish freak garbage halfwit hypocrite idiot idiotic idiots "
    "ignorant imbecile jackass jerk lame liar loser losers lowlife lunatic maggot moron moronic morons nitwit numbskull "
    "parasite pathetic pig psycho rat repulsive scum scumbag skank slut sleazy stupid subhuman swine thug trash troll "
    "twit ugly useless vermin vile weirdo whore worthless"
).split()
THREATS = "kill hurt destroy murder beat strangle stab shoot punch hang burn crush annihilate exterminate".split()
TARGETS = "you your yours he him his she her they them their we us who anyone everyone people this these those".split()
NEGATIONS = "not no never none nobody nothing neither nor isn aren wasn weren don doesn didn cannot without".split()
REPORTS = "said says say told tells claimed claims wrote writes quoted quotes reported reports called alleged".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "o", "i", "t", "y", "n", "r"
CLASSES = {INSULT: INSULTS, THREAT: THREATS, TARGET: TARGETS, NEGATION: NEGATIONS, REPORT: REPORTS}
NEAR = 3
LETTERS = byte_class((0x61, 0x7A), (0x80, 0xFF))
CLAUSE_ENDS = np.frombuffer(b".!?;:\n", np.uint8)

# The weights of a listed word without evidence, and of the paths on which a match may stand.
LISTED = {INSULT: 3.0, THREAT: 1.5}
DENIED, QUOTED, AIMED = 0.25, 0.25, 1.25
MATCHES = ("insult", "aimed insult", "threat", "aimed threat", "denied", "quoted")

# A learned word has so many contexts in toxic documents and so high a lower bound of its log odds ratio (97.5 %, one-sided).
LEAST_CONTEXTS = 3
LEAST_LIFT = 1.0
DEVIATIONS = 1.96
# The curve of the score without labelled rows; fitted curves are held near it.
CURVE = (2.2, -5.0)


class Transducer:
    """A deterministic weighted transducer: `step` tells state and symbol to state, emitted symbol and weight.

    `end` tells what a state still emits at the end of the string.
    """

    def __init__(self, start, step, end=lambda state: ()):
        self.start, self.step, self.end = start, step, end

    def then(self, other: Transducer) -> Transducer:
        """The composition: `other` reads what this one emits; weights are multiplied."""

        def step(state, symbol):
            mine, emitted, weight = self.step(state[0], symbol)
            theirs, out, more = other.step(state[1], (emitted, weight))
            return (mine, theirs), out, more

        return Transducer((self.start, other.start), step, lambda state: other.end(state[1]))

    def compiled(self, alphabet: Iterable) -> tuple[list[dict], list]:
        """All reachable states as tables: symbol to (state number, what is emitted); and what each emits at the end."""
        numbers, queue, tables = {self.start: 0}, [self.start], []
        for state in queue:
            moves = {}
            for symbol in alphabet:
                after, out, _ = self.step(state, symbol)
                if after not in numbers:
                    numbers[after] = len(numbers)
                    queue.append(after)
                moves[symbol] = (numbers[after], out)
            tables.append(moves)
        return tables, [self.end(state) for state in queue]


def _negation(left: int, symbol: str):
    """Within NEAR words after a negation an insult or threat is denied; state: words left."""
    if symbol == NEGATION:
        return NEAR, OTHER, 1.0
    denied = left and symbol in (INSULT, THREAT)
    return max(0, left - 1), symbol + "!" if denied else symbol, DENIED if denied else 1.0


def _reported(quoting: bool, read: tuple[str, float]):
    """After a reporting verb the rest of the clause is quoted."""
    symbol, weight = read
    if symbol == REPORT:
        return True, OTHER, 1.0
    quoted = quoting and symbol[0] in (INSULT, THREAT)
    return quoting, symbol + '"' if quoted else symbol, weight * QUOTED if quoted else weight


KIND = {INSULT: "insult", THREAT: "threat"}


def _aimed(state: tuple[int, tuple], read: tuple[str, float]):
    """Matches, each as (words back, kind, weight); an insult or threat within NEAR words of a target is aimed.

    State: words left after a target, and the matches that still wait for one, with the words read since.
    """
    (left, waiting), (symbol, weight) = state, read
    waiting = tuple((own, age + 1) for own, age in waiting)
    if symbol == TARGET:
        return (NEAR, ()), tuple((age, f"aimed {KIND[own]}", AIMED) for own, age in waiting), 1.0
    out = [(age, KIND[own], 1.0) for own, age in waiting if age == NEAR]
    waiting = tuple((own, age) for own, age in waiting if age < NEAR)
    if len(symbol) > 1:
        out.append((0, "quoted" if '"' in symbol else "denied", weight))
    elif symbol in KIND:
        if left:
            out.append((0, f"aimed {KIND[symbol]}", AIMED))
        else:
            waiting += ((symbol, 0),)
    return (max(0, left - 1), waiting), tuple(out), 1.0


def _loose(state: tuple[int, tuple]):
    return tuple((age, KIND[own], 1.0) for own, age in state[1])


GRAMMAR = Transducer(0, _negation).then(Transducer(False, _reported)).then(Transducer((0, ()), _aimed, _loose))


def read_clause(symbols: Iterable[str], machine: tuple[list[dict], list]) -> list[tuple[int, str, float]]:
    """(place of the word, kind, weight of the path) of every match of a clause."""
    (tables, ends), state, found, place = machine, 0, [], -1
    for place, symbol in enumerate(symbols):
        state, out = tables[state][symbol]
        found += [(place - back, kind, weight) for back, kind, weight in out]
    return found + [(place - back, kind, weight) for back, kind, weight in ends[state]]


class Lexicon:
    """Word names, their classes and weights."""

    def __init__(self, learned: dict[str, float] | None = None, dropped: Iterable[str] = ()):
        learned, dropped = learned or {}, set(dropped)
        words = {w: c for c, own in CLASSES.items() for w in own} | {w: INSULT for w in learned if w not in THREATS}
        words = {w: c for w, c in words.items() if w not in dropped}
        texts = sorted(words)
        _, names = word_names(column_texts(pa.array(texts, pa.string())), LETTERS)
        order = np.argsort(names)
        self.set = NameSet(names)
        self.classes = np.array([words[t] for t in texts])[order]
        self.weights = np.array([learned.get(t, LISTED.get(words[t], 0.0)) for t in texts])[order]
        self.serious = np.isin(self.classes, (INSULT, THREAT))
        self.machine = GRAMMAR.compiled((OTHER, *CLASSES))


def matched(texts: Texts, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """The strength of each text, and how often it has each kind of match. Only clauses with an insult or threat are read."""
    n = len(texts.offsets) - 1
    counts, strength = np.zeros((n, len(MATCHES)), np.int64), np.zeros(n)
    words, names = word_names(texts, LETTERS)
    at, which = lexicon.set.find(names)
    if not lexicon.serious[which].any():
        return strength, counts
    classes, weights = np.full(len(names), OTHER), np.zeros(len(names))
    classes[at], weights[at] = lexicon.classes[which], lexicon.weights[which]
    ends = np.zeros(len(texts.data) + 1, np.int64)
    ends[1:] = np.cumsum(np.isin(texts.data, CLAUSE_ENDS))
    owner = words.text_of()
    clause = ends[words.starts] + owner
    wanted = np.unique(clause[at[lexicon.serious[which]]])
    first, last = np.searchsorted(clause, wanted, "left"), np.searchsorted(clause, wanted, "right")
    best: dict[tuple[int, int], float] = {}
    for a, b in zip(first, last, strict=True):
        for place, kind, weight in read_clause(classes[a:b], lexicon.machine):
            counts[owner[a], MATCHES.index(kind)] += 1
            key = (int(owner[a]), int(names[a + place]))
            best[key] = max(best.get(key, 0.0), weight * weights[a + place])
    for (text, _), value in best.items():
        strength[text] += value
    return strength, counts


class ToxicityModel:
    def __init__(self, lexicon: Lexicon, slope: float, bias: float):
        self.lexicon, self.slope, self.bias = lexicon, slope, bias

    def judge(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        strength, counts = matched(texts, self.lexicon)
        return sigmoid(self.slope * np.log2(1 + strength) + self.bias), counts


def fit_curve(strength: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and bias of the logistic curve over log2(1 + strength), by Newton steps; the slope is held near the grammar's."""
    curve = np.array(CURVE)
    if not len(labels):
        return float(curve[0]), float(curve[1])
    x = np.stack((np.log2(1 + strength), np.ones(len(labels))), axis=1)
    share, hold = weights / weights.sum(), np.diag([2e-3, 2e-4])
    for _ in range(40):
        p = sigmoid(x @ curve)
        gradient = x.T @ ((p - labels) * share) + hold @ (curve - CURVE)
        curvature = (x * (p * (1 - p) * share)[:, None]).T @ x + hold
        curve = curve - np.clip(np.linalg.solve(curvature, gradient), -1, 1)
    return float(max(curve[0], 0.0)), float(curve[1])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of a document once for every pair of neighbours it has there."""
    for batch in batches:
        labels, folds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for begin, end, piece in pieces(column_texts(batch.column(2))):
            folded = Texts(LOWER[piece.data], piece.offsets)
            words, codes, distinct = word_codes(folded, LETTERS)
            names = word_names(folded, LETTERS)[1]
            owner = words.text_of()
            sides = []
            for near in (np.arange(len(codes)) - 1, np.arange(len(codes)) + 1):
                inside = np.clip(near, 0, max(len(codes) - 1, 0))
                same = (near == inside) & (owner[inside] == owner) if len(codes) else np.zeros(0, bool)
                sides.append(np.where(same, names[inside], np.uint64(0)) if len(codes) else names)
            context = pair_names(*sides)
            group = 2 * labels[begin:end][owner] + folds[begin:end][owner]
            once = np.unique(np.stack((codes.view(np.uint64), context, group.astype(np.uint64))), axis=1)
            yield pa.RecordBatch.from_arrays(
                [distinct.take(pa.array(once[0].view(np.int64))).cast(pa.string()), pa.array(once[1].view(np.int64)), pa.array(once[2].astype(np.int32))],
                names=["word", "context", "grp"],
            )


def evidence(sampled: DataFrame, text_col: str) -> list:
    """Of words that matter: distinct contexts in toxic (h) and other (f) documents, by half of the sample and in all.

    A learned word has `LEAST_CONTEXTS` contexts in toxic documents, so what is collected is bounded by the sample.
    """
    rows = sampled.select(F.col("__label").cast("int").alias("label"), "fold", F.col(text_col).alias("text"))
    found = rows.mapInArrow(_contexts, "word string, context long, grp int")
    seen = [F.max(F.when(F.col("grp") == g, 1).otherwise(0)).alias(name) for g, name in enumerate(("f0", "f1", "h0", "h1"))]
    contexts = found.groupBy("word", "context").agg(*seen)
    sums = [F.sum(c).alias(c) for c in ("f0", "f1", "h0", "h1")]
    sums += [F.sum(F.greatest(f"{c}0", f"{c}1")).alias(c) for c in ("f", "h")]
    listed = F.col("word").isin([*INSULTS, *THREATS])
    return contexts.groupBy("word").agg(*sums).where((F.col("h") >= LEAST_CONTEXTS) | listed).collect()


def lift(h: float, f: float, toxic: int, other: int) -> float:
    """The lower bound of the log odds ratio of a word with h and f contexts among so many documents."""
    deviation = np.sqrt(1 / (h + 0.5) + 1 / (f + 0.5))
    return float(np.log((h + 0.5) / (f + 0.5)) - np.log((toxic + 0.5) / (other + 0.5)) - DEVIATIONS * deviation)


def learned_lexicon(found: list, half: str, toxic: int, other: int) -> Lexicon:
    """From the evidence of half "0" or "1" of the sample, or of all of it, "": words to learn, listed words to drop."""
    learned, dropped, listed = {}, [], {*INSULTS, *THREATS}
    for row in found:
        h, f = row[f"h{half}"], row[f"f{half}"]
        value = lift(h, f, toxic, other)
        if h >= LEAST_CONTEXTS and value >= LEAST_LIFT:
            learned[row["word"]] = value
        elif row["word"] in listed and h + f >= LEAST_CONTEXTS and h * other < f * toxic:
            dropped.append(row["word"])
    return Lexicon(learned, dropped)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    per_class: int = 10_000,
) -> ToxicityModel:
    """Fit on a bounded sample of the labelled rows: about `per_class` of each class."""
    sample = bounded_sample(labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")), per_class)
    sampled = with_texts(docs.select(id_col, text_col), sample.where("label IN (0, 1)"), id_col)
    sampled = sampled.withColumn("fold", F.pmod(F.xxhash64(F.lit("half"), F.col(id_col)), F.lit(2)).cast("int"))
    sizes = {(r["__label"], r["fold"]): r["count"] for r in sampled.groupBy("__label", "fold").count().collect()}
    found = evidence(sampled, text_col)

    def learned(folds: tuple[int, ...], half: str) -> Lexicon:
        return learned_lexicon(found, half, *(sum(sizes.get((label, k), 0) for k in folds) for label in (1, 0)))

    lexicon, halves = learned((0, 1), ""), [learned((k,), str(k)) for k in (0, 1)]
    shared = docs.sparkSession.sparkContext.broadcast(halves)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds = batch.column(2).to_numpy()
            for begin, end, piece in pieces(column_texts(batch.column(3))):
                # A row is judged by the words of the half it does not belong to.
                strength = np.where(folds[begin:end] == 0, *(matched(piece, shared.value[k])[0] for k in (1, 0)))
                own = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(strength)], names=["label", "weight", "strength"])

    rows = sampled.select(F.col("__label").cast("int").alias("label"), F.col("__weight").alias("weight"), "fold", text_col)
    taken = sorted(tuple(r) for r in rows.mapInArrow(take, "label int, weight double, strength double").collect())
    slope, bias = fit_curve(*(np.array([r[k] for r in taken], float) for k in (2, 0, 1)))
    return ToxicityModel(lexicon, slope, bias)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its score, and how often its clauses matched each kind of pattern."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, piece in pieces(column_texts(batch.column(1))):
                found, counts = shared.value.judge(piece)
                matches = [[(name, int(n)) for name, n in zip(MATCHES, row, strict=True) if n] for row in counts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), pa.array(found, pa.float64()), pa.array(matches, pa.map_(pa.string(), pa.int64()))],
                    names=["id", "score", "matches"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(judge, f"id {kind}, score double, matches map<string,bigint>")
    return scored.withColumnRenamed("id", id_col)
