"""Chat formatting: a hidden Markov model recovers the turns of raw transcripts before they are rendered canonically.

The states are a role and whether a line begins a turn. What is seen of a line is its speaker marker, whether a blank line
stands before it, whether it is the first, and whether it asks something. The model's probabilities are counted over all
transcripts whose roles are known, in a table of fixed size; a line sequence is decoded by Viterbi, and lines of one turn
are put together, less the marker.

Null and empty transcripts have no turns. Blank lines inside a turn stay. Rows that repeat are parsed alike. A text that
contains the canonical brackets gets a space in them, so that rendered turns can always be told apart. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import ship, with_field

ROLES = ("system", "user", "assistant")
# Names that open a line of each role.
NAMES = {
    "system": ("system", "context", "setup"),
    "user": ("user", "human", "q", "question", "prompt", "instruction", "customer"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "response", "agent"),
}
ROLE_OF = {name: role for role, names in NAMES.items() for name in names}
MARKER = re.compile(r"^[#*\[<\s]*([A-Za-z]{1,12})[\]*>\s]*:\s?(.*)$", re.DOTALL)
OPENING, CLOSING = "<|{}|>\n", "<|end|>\n"

TURNS = T.ArrayType(T.StructType().add("role", T.StringType()).add("text", T.StringType()))
STATES = [(role, begins) for role in range(len(ROLES)) for begins in (False, True)]
SEEN = 4 * 2 * 2 * 2


def observed(text: str | None) -> list[tuple[int, int, str]]:
    """Per line that is not blank: what is seen of it, the blank lines before it, and its text without a marker."""
    out, blank = [], 0
    for line in (text or "").split("\n"):
        if not line.strip():
            blank += 1
            continue
        match = MARKER.match(line)
        role = ROLE_OF.get(match[1].lower()) if match else None
        mark = 1 + ROLES.index(role) if role else 0
        seen = ((mark * 2 + bool(blank)) * 2 + (not out)) * 2 + line.rstrip().endswith("?")
        out.append((seen, blank, match[2] if role else line))
        blank = 0
    return out


class TranscriptModel:
    """Log probabilities of the first state, of the next state, and of what is seen, from counts with one added."""

    def __init__(self, counts: np.ndarray):
        """`counts` has a row per earlier state (the last row: none) of next states, then of what is seen per state."""
        n = len(STATES)
        moves, seen = counts[: (n + 1) * n].reshape(n + 1, n) + 0.01, counts[(n + 1) * n :].reshape(n, SEEN) + 0.01
        for i, (role, _) in enumerate(STATES):
            for j, (later, begins) in enumerate(STATES):
                if not begins and later != role:
                    moves[i, j] = 1e-12
        moves[n, [j for j, (_, begins) in enumerate(STATES) if not begins]] = 1e-12
        moves, seen = np.log(moves / moves.sum(1, keepdims=True)), np.log(seen / seen.sum(1, keepdims=True))
        self.first, self.next, self.seen = moves[n], moves[:n], seen

    def states(self, seen: list[int]) -> list[int]:
        """The likeliest states."""
        if not seen:
            return []
        value, back = self.first + self.seen[:, seen[0]], []
        for symbol in seen[1:]:
            reach = value[:, None] + self.next
            back.append(reach.argmax(0))
            value = reach.max(0) + self.seen[:, symbol]
        path = [int(value.argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]

    def turns(self, text: str | None) -> list[tuple[str, str]]:
        """(role, text) of each turn."""
        lines, out = observed(text), []
        for state, (_, blank, content) in zip(self.states([s for s, _, _ in lines]), lines, strict=True):
            role, begins = STATES[state]
            if begins or not out:
                out.append([ROLES[role], content])
            else:
                out[-1][1] += "\n" * (blank + 1) + content
        return [tuple(turn) for turn in out]


def rendered(turns: Column) -> Column:
    """Canonical text of an array of (role, text)."""
    safe = lambda text: F.replace(text, F.lit("<|"), F.lit("< |"))
    each = F.transform(
        turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), safe(t["text"]), F.lit("\n" + CLOSING))
    )
    return F.array_join(each, "")


def train(labelled: DataFrame, text_col: str = "transcript", turns_col: str = "turns") -> TranscriptModel:
    """Count over all rows with a transcript and its true turns, an array of (role, lines): lines that are not blank."""
    ship(labelled.sparkSession)
    n = len(STATES)
    rows = labelled.select(F.col(text_col).alias("text"), F.col(turns_col).alias("turns"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n + 1) * n + n * SEEN, np.int64)
        for batch in batches:
            for text, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                states = [2 * ROLES.index(t["role"]) + (k == 0) for t in turns or [] if t["role"] in ROLES for k in range(t["lines"])]
                seen = [s for s, _, _ in observed(text)]
                if len(seen) != len(states):
                    continue
                for before, state, symbol in zip([n, *states], states, seen, strict=False):
                    total[before * n + state] += 1
                    total[(n + 1) * n + state * SEEN + symbol] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["place", "n"])

    summed = rows.mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((n + 1) * n + n * SEEN)
    for row in summed:
        counts[row["place"]] = row["n"]
    return TranscriptModel(counts)


def parse(transcripts: DataFrame, model: TranscriptModel, text_col: str = "transcript", out_col: str = "parsed") -> DataFrame:
    """`transcripts` with their turns, an array of (role, text), in `out_col`, and the canonical text in `rendered`."""
    spark = transcripts.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = transcripts.drop(out_col, "rendered")
    place = rows.columns.index(text_col)
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"role": role, "text": content} for role, content in shared.value.turns(text)]
                for text in batch.column(place).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, turn)], names=[*batch.schema.names, out_col])

    parsed = rows.mapInArrow(run, with_field(rows, out_col, TURNS))
    return parsed.withColumn("rendered", rendered(F.col(out_col)))


MOST_TURNS = 512


def raw_transcripts(turns: DataFrame) -> DataFrame:
    """Raw transcripts of a table of turns (conv_id, turn, role, text), with speaker markers of several styles.

    One turn in five, by hash, has no marker and stands after a blank line. Rows equal in all columns are one turn. A
    conversation is cut into parts of `MOST_TURNS` turns by number, and a part that still has more, as rows share a number, is
    cut further by a hash of the text, so no conversation is ever gathered whole. Null texts are empty; a null role has no
    marker and counts for no role.
    """
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("block", F.floor(F.coalesce("turn", F.lit(0)) / MOST_TURNS))
    sizes = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n")).where(F.col("n") > 2 * MOST_TURNS)
    large = sizes.select(F.struct("conv_id", "block").alias("key"), F.ceil(F.col("n") / MOST_TURNS).alias("cuts"))
    rows = rows.withColumn("key", F.struct("conv_id", "block")).join(large, "key", "left")
    cut = F.coalesce(F.pmod(F.xxhash64("turn", "text"), F.col("cuts")), F.lit(0))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    word = F.when(F.col("role") == "system", "System")
    pairs = (("User", "Assistant"), ("Human", "AI"), ("Q", "A"), ("Question", "Answer"))
    for number, (asks, answers) in enumerate(pairs):
        word = word.when((F.col("role") == "user") & (style == number), asks)
        word = word.when((F.col("role") == "assistant") & (style == number), answers)
    bare = (F.pmod(F.xxhash64("conv_id", "turn", "text"), F.lit(5)) == 0) | word.isNull()
    opening = F.when(bare, F.lit("\n")).otherwise(F.concat(F.when(style == 1, F.lit("### ")).otherwise(F.lit("")), word, F.lit(": ")))
    filled = F.filter(F.split("text", "\n"), lambda line: F.length(F.trim(line)) > 0)
    line = F.struct(
        "turn", F.concat(opening, F.col("text")).alias("line"), "role", F.greatest(F.size(filled), F.when(bare, 0).otherwise(1)).alias("lines")
    )
    gathered = rows.groupBy("conv_id", "block", cut.alias("cut")).agg(F.sort_array(F.collect_list(line)).alias("all"))
    return gathered.select(
        "conv_id",
        "block",
        "cut",
        F.array_join(F.transform("all", lambda t: t["line"]), "\n").alias("transcript"),
        F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["lines"].alias("lines"))).alias("turns"),
    )
