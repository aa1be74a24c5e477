"""Toxicity by a weighted grammar of clauses.

Five small transducers read the words of a clause as classes (insult, threat, target, negation,
reported speech, other). Each gives a factor for every class it reads. Their composition, a
machine over the product of their states, weighs what is matched: an insult aimed at somebody
counts more, one that is negated or reported counts less, a threat counts if it meets a target.
A document is scored by its matched clauses, not by words alone. Insults are word beginnings and
whole words learned from labels; the other classes are short lists.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import as_bytes, cut, pieces, texts_of, words_of

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Labelled documents learned from at most.
SAMPLE = 20_000
#: Insult patterns kept at most, those of highest odds.
PATTERNS = 20_000
PREFIXES = range(3, 9)
LEAST_SUPPORT, LEAST_ODDS = 4, 2.5

SEEDS = {
    THREAT: "kill hurt destroy murder beat burn shoot stab crush töten umbringen tuer frapper matar "
    "golpear",
    TARGET: "you your yours he she they him her them du dich dir ihr euch tu toi vous tú usted ustedes",
    NEGATION: "not never no nobody isn't aren't don't nicht kein keine nie ne pas jamais nunca jamás",
    REPORT: "said says wrote writes quoted called calls sagte schrieb nannte dit écrit appelé dijo escribió",
}
CLASSES = {word: kind for kind, words in SEEDS.items() for word in words.split()}


# --- transducers


@dataclass(frozen=True)
class Transducer:
    """``step[state][class]`` is the next state and the factor given for reading that class."""

    step: tuple[tuple[tuple[int, float], ...], ...]


def transducer(states: int, moves: dict[tuple[int, int], tuple[int, float]], rest: list[int]) -> Transducer:
    """Moves by (state, class); any other class leads to ``rest[state]`` with factor 1."""
    return Transducer(
        tuple(
            tuple(moves.get((s, c), (rest[s], 1.0)) for c in range(6)) for s in range(states)
        )
    )


def insult() -> Transducer:
    """Only insults count."""
    return transducer(1, {(0, c): (0, 1.0 if c == INSULT else 0.0) for c in range(6)}, [0])


def threat(weight: float = 4.0, reach: int = 4) -> Transducer:
    """A target within ``reach`` words after a threat counts."""
    moves: dict = {}
    for s in range(reach + 1):
        after = max(0, s - 1)
        moves |= {(s, c): (after, 0.0) for c in range(6)}
        moves[s, THREAT] = (reach, 0.0)
        if s:
            moves[s, TARGET] = (0, weight)
    return transducer(reach + 1, moves, [0] * (reach + 1))


def target(bonus: float = 1.5, reach: int = 4) -> Transducer:
    """An insult within ``reach`` words after a target counts more."""
    moves = {(s, TARGET): (reach, 1.0) for s in range(reach + 1)}
    moves |= {(s, INSULT): (s - 1, bonus) for s in range(1, reach + 1)}
    return transducer(reach + 1, moves, [max(0, s - 1) for s in range(reach + 1)])


def negation(factor: float = 0.4, reach: int = 2) -> Transducer:
    """Insults and threatened targets within ``reach`` words after a negation count less."""
    moves = {(s, NEGATION): (reach, 1.0) for s in range(reach + 1)}
    for s in range(1, reach + 1):
        moves |= {(s, INSULT): (s - 1, factor), (s, TARGET): (s - 1, factor)}
    return transducer(reach + 1, moves, [max(0, s - 1) for s in range(reach + 1)])


def reported(factor: float = 0.5) -> Transducer:
    """What follows a word of reported speech in the clause counts less."""
    moves = {(0, REPORT): (1, 1.0), (1, INSULT): (1, factor), (1, TARGET): (1, factor)}
    return transducer(2, moves, [0, 1])


def compose(*machines: Transducer) -> Transducer:
    """All machines read side by side: states are combined, factors multiplied."""
    sizes = [range(len(m.step)) for m in machines]
    number = {s: i for i, s in enumerate(itertools.product(*sizes))}
    out = []
    for states in number:
        row = []
        for c in range(6):
            moves = [m.step[s][c] for m, s in zip(machines, states)]
            row.append((number[tuple(n for n, _ in moves)], math.prod(f for _, f in moves)))
        out.append(tuple(row))
    return Transducer(tuple(out))


INSULTS = compose(insult(), target(), negation(), reported())
THREATS = compose(threat(), negation(), reported())


def clause_weight(classes: list[int], weights: list[float]) -> float:
    """Weight of one clause: the insults' own weights and the threats, by their factors."""
    total, a, b = 0.0, 0, 0
    for kind, weight in zip(classes, weights):
        a, factor = INSULTS.step[a][kind]
        b, gain = THREATS.step[b][kind]
        total += factor * weight + gain
    return total


# --- model

_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def patterns_of(word: str) -> list[str]:
    """The word's beginnings, and the word itself marked with its end."""
    return [word[:n] for n in PREFIXES if n <= len(word)] + [word + "$"]


@dataclass
class Model:
    """Weights of insult patterns, and the logistic function of a document's features."""

    patterns: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    slopes: tuple[float, ...] = (2.0, 0.5, 0.0)

    def kind(self, token: str) -> tuple[int, float]:
        word = _EDGES.sub("", token)
        if word in CLASSES:
            return CLASSES[word], 0.0
        weight = max((self.patterns.get(p, 0.0) for p in patterns_of(word)), default=0.0)
        return (INSULT, weight) if weight else (OTHER, 0.0)


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.string()))


def features(texts: pa.Array, model: Model, known: dict | None = None) -> np.ndarray:
    """For each text: log of the summed clause weights, of the largest, and of the number of them."""
    words = words_of(lowered(texts), lower=False)
    known = {} if known is None else known
    names = words.distinct.to_pylist()
    for w in names:
        if w not in known:
            known[w] = (*model.kind(w), w[-1:] in ".,;:!?")
    kinds = np.array([known[w][0] for w in names], np.int8)
    out = np.zeros((len(texts), 3))
    own = kinds[words.codes] if len(names) else np.zeros(0, np.int8)
    if not len(own):
        return out
    ends = np.array([known[w][2] for w in names], bool)[words.codes]
    ends[words.starts[1:][words.counts > 0] - 1] = True
    clause = np.cumsum(ends) - ends
    first = np.concatenate(([0], np.flatnonzero(ends) + 1))
    doc_of = np.searchsorted(words.starts, first, side="right") - 1
    found = set(clause[own == INSULT].tolist())
    found |= set(clause[own == THREAT].tolist()) & set(clause[own == TARGET].tolist())
    for c in sorted(found):
        span = words.codes[first[c] : first[c + 1]]
        rows = [known[names[i]] for i in span]
        weight = clause_weight([r[0] for r in rows], [r[1] for r in rows])
        d = doc_of[c]
        out[d] += (weight, 0, weight > 0)
        out[d, 1] = max(out[d, 1], weight)
    return np.log1p(out)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, tuple[float, ...]]:
    """Bias and slopes by Newton's method with a small penalty on the slopes."""
    design = np.column_stack((np.ones(len(x)), x))
    penalty = np.diag([1e-3] + [ridge] * x.shape[1])
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + penalty @ w
        step = np.linalg.solve((design.T * (p * (1 - p))) @ design + penalty + 1e-9 * np.eye(len(w)), grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max(initial=0) < 1e-8:
            break
    return float(w[0]), tuple(map(float, w[1:]))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % parts


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, training: Column, sample: int
) -> DataFrame:
    """``doc_id``, ``text``, ``y`` of at most ``sample`` training rows, those of smallest id hash.

    Rows without id or label are left out; of several labels of a document the largest counts.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    chosen = rows.where("doc_id is not null and y is not null").where(training)
    chosen = chosen.groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` rows of two numbers are sent to all tasks.
    return texts_of(docs).join(F.broadcast(chosen), "doc_id")


def unlike(rows: DataFrame) -> DataFrame:
    """The rows without most near copies: of each of two MinHash values of word triples the row
    with the smallest doc_id stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            first, second = [], []
            for text in as_bytes(piece.column("text")):
                w = text.split()
                runs = {b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))}
                for out, seed in ((first, 1), (second, 2)):
                    out.append(min(xxhash.xxh64_intdigest(r, seed) for r in runs) >> 1)
            columns = [piece.column(c) for c in ("doc_id", "text", "y")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(first, pa.int64()), pa.array(second, pa.int64())],
                ["doc_id", "text", "y", "first", "second"],
            )

    marked = rows.mapInArrow(run, "doc_id long, text string, y int, first long, second long")
    for value in ("first", "second"):
        least = F.min_by(F.struct(*marked.columns), "doc_id").alias("row")
        marked = marked.groupBy(value).agg(least).select("row.*")
    return marked.select("doc_id", "text", "y")


def learn(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    sample: int = SAMPLE,
    patterns: int = PATTERNS,
) -> Model:
    """Insult patterns and their weights (log odds) from two thirds of the sample, the logistic
    function from the rest. Without labels of both kinds nothing is an insult.

    The sample has at most ``sample`` labelled rows, and the model at most ``patterns`` patterns, those
    of highest odds: that bounds what is sent to the tasks.
    """
    rows = cut(unlike(labelled(docs, labels, "toxic", training, sample)))
    third = F.xxhash64("doc_id") % 3 == 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            counts: Counter = Counter()
            words = words_of(lowered(piece.column("text")), lower=False)
            names = [_EDGES.sub("", w) for w in words.distinct.to_pylist()]
            for y, a, b in zip(piece.column("y").to_pylist(), words.starts, words.starts[1:]):
                own = {names[c] for c in words.codes[a:b]}
                counts.update((p, y) for p in {p for w in own for p in patterns_of(w)})
            p, y = zip(*counts) if counts else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.string()), pa.array(y, pa.int32()), pa.array(counts.values(), pa.int64())],
                ["pattern", "y", "n"],
            )

    size = {r[0]: r[1] for r in rows.where(~third).groupBy("y").count().collect()}
    if not size.get(0) or not size.get(1):
        return Model()
    found = rows.where(~third).mapInArrow(run, "pattern string, y int, n long")
    odds = F.log((F.col("bad") + 0.5) / (size[1] + 1)) - F.log((F.col("good") + 0.5) / (size[0] + 1))
    counted = (
        found.groupBy("pattern")
        .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("bad"),
             F.sum(F.when(F.col("y") == 1, 0).otherwise(F.col("n"))).alias("good"))
        .where(F.col("bad") >= LEAST_SUPPORT)
        .select("pattern", odds.alias("odds"))
        .where(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc("odds"), "pattern")
        .limit(patterns)
    )
    model = Model({r.pattern: r.odds for r in counted.collect()})

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            x = features(piece.column("text"), model)
            yield pa.RecordBatch.from_arrays(
                [piece.column("y"), *(pa.array(c) for c in x.T)], ["y", "a", "b", "c"]
            )

    seen = rows.where(third).mapInArrow(measure, "y int, a double, b double, c double").collect()
    y = np.array([r.y for r in seen], float)
    if len(set(y.tolist())) == 2:
        model.bias, model.slopes = logistic(np.array([r[1:] for r in seen]), y)
    return model


def _scorer(docs: DataFrame, model: Model):
    """A function for tasks: the scores of some texts."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # as many entries as learned patterns

    def scores(texts: pa.Array, known: dict) -> np.ndarray:
        if len(known) > 300_000:
            known.clear()
        x = features(texts, sent.value, known)
        z = sent.value.bias + x @ np.array(sent.value.slopes)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    return scores


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) of every row, repeated ones too.

    Null and empty texts score as texts without a match. Other columns are ignored.
    """
    scores = _scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for piece in pieces(batches):
            score = pa.array(scores(piece.column("text"), known))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), score], ["doc_id", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, most: float = 0.5) -> DataFrame:
    """The rows, with all their columns, that score below ``most``: decided where they are read."""
    scores = _scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for piece in pieces(batches):
            texts = pc.fill_null(piece.column("text").cast(pa.string()), "")
            yield piece.filter(pa.array(scores(texts, known) < most))

    return docs.mapInArrow(run, docs.schema)
