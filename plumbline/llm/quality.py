"""Quality by a linear classifier on Naive Bayes features.

N-grams of words and of word shapes are indicators, scaled by the ratio of their log counts in
the two classes. A linear hinge loss is fitted to them by dual coordinate descent, and its margin
is turned into a probability by a logistic function of held-back rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame

from plumbline.llm.common import cut, mixed, pieces, texts_of, words_of
from plumbline.llm.toxicity import labelled, logistic, unlike

#: Labelled documents learned from at most, and the weights of a model.
SAMPLE = 8_000
SLOTS = 1 << 18


def shape(word: str) -> str:
    """Runs of upper-case letters, lower-case letters and digits as A, a and 0; the rest as it is.
    The whole word counts, however long."""
    out, last = [], ""
    for c in word:
        kind = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
        if kind != last or kind not in "Aa0":
            out.append(kind)
        last = kind
    return "".join(out)


def ngrams(texts: pa.Array, known: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams that each text has, each once: (slots, first place of each text).

    Words and pairs of words, shapes in runs of one to three, and whether words repeat the one
    before, in runs of one to three.
    """
    words = words_of(texts, lower=False)
    known = {} if known is None else known
    names = words.distinct.to_pylist()
    for w in names:
        if w not in known:
            known[w] = (xxhash.xxh64_intdigest(w.lower()), xxhash.xxh64_intdigest(shape(w), 1))
    both = np.array([known[w] for w in names], np.uint64).reshape(-1, 2)[words.codes]
    word, form = both[:, 0].copy(), both[:, 1].copy()
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), words.counts)
    left = np.repeat(words.starts[1:], words.counts) - np.arange(len(word))
    same = np.zeros(len(word), np.uint64)
    same[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    keys = []
    for salt, source, most in ((1, word, 2), (2, form, 3), (3, same, 3)):
        h = np.zeros(len(word), np.uint64)
        for n in range(1, most + 1):
            many = max(0, len(word) - n + 1)
            h = h[:many] * np.uint64(0x9E3779B97F4A7C15) + source[n - 1 : n - 1 + many] + np.uint64(1)
            at = left[:many] >= n
            slot = mixed(h[at] + np.uint64(salt * 16 + n)) & np.uint64(SLOTS - 1)
            keys.append(doc[:many][at] * np.uint64(SLOTS) + slot)
    own = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    starts = np.searchsorted(own, np.arange(len(texts) + 1, dtype=np.uint64) * np.uint64(SLOTS))
    return (own & np.uint64(SLOTS - 1)).astype(np.int64), starts


@dataclass
class Model:
    """A weight for each slot (the class ratio times the hinge weight), and the logistic function."""

    weights: np.ndarray
    bias: float
    scale: float
    offset: float

    def margins(self, slots: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Margin of each text; its indicators have unit length together."""
        total = np.concatenate(([0.0], np.cumsum(self.weights[slots])))
        n = np.diff(starts)
        return (total[starts[1:]] - total[starts[:-1]]) / np.sqrt(np.maximum(n, 1)) + self.bias

    def scores(self, slots: np.ndarray, starts: np.ndarray) -> np.ndarray:
        z = self.scale * self.margins(slots, starts) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def log_ratios(rows: list[np.ndarray], y: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Log ratio of each indicator's share in class 1 and in class 0, with one added to counts."""
    counts = np.ones((2, slots))
    for own, kind in zip(rows, y):
        counts[int(kind), own] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def hinge(
    rows: list[np.ndarray],
    values: list[np.ndarray],
    y: np.ndarray,
    c: np.ndarray,
    slots: int,
    epochs: int = 12,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge loss, by dual coordinate descent.

    ``c`` bounds the dual variable of each row. The bias is the weight of a constant indicator.
    """
    w, bias, alpha = np.zeros(slots), 0.0, np.zeros(len(rows))
    square = np.array([float(v @ v) + 1 for v in values])
    order, turn = np.arange(len(rows)), np.random.default_rng(0)
    for _ in range(epochs):
        turn.shuffle(order)
        moved = 0.0
        for i in order:
            sign = 1.0 if y[i] else -1.0
            gradient = sign * (float(w[rows[i]] @ values[i]) + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), c[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, bias


def fit(rows: list[np.ndarray], y: np.ndarray, held: np.ndarray, cost: float = 1.0) -> Model:
    """A model of the rows that are not ``held``; the logistic function is fitted to those that are.

    Rows of either class weigh as much together.
    """
    flat = Model(np.zeros(SLOTS), 0.0, 0.0, 0.0)
    if not len(y):
        return flat
    share = (y.sum() + 1) / (len(y) + 2)
    flat.offset = float(np.log(share / (1 - share)))
    learned = [i for i in range(len(y)) if not held[i]]
    if len(set(y[learned].tolist())) < 2:
        return flat
    own, kinds = [rows[i] for i in learned], y[learned]
    ratio = log_ratios(own, kinds)
    values = [ratio[r] / np.sqrt(max(1, len(r))) for r in own]
    weigh = np.where(kinds == 1, 0.5 / kinds.mean(), 0.5 / (1 - kinds.mean()))
    w, bias = hinge(own, values, kinds, cost * weigh, SLOTS)
    model = Model(w * ratio, bias, 1.0, 0.0)
    tested = [i for i in range(len(y)) if held[i]]
    if len(set(y[tested].tolist())) == 2:
        flat_rows = np.concatenate([rows[i] for i in tested])
        starts = np.concatenate(([0], np.cumsum([len(rows[i]) for i in tested])))
        margin = model.margins(flat_rows, starts)
        model.offset, (model.scale,) = logistic(margin[:, None], y[tested].astype(float), 0.01)
    return model


def learn(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled rows without most near copies.

    Without labels the score is one half; with labels of one class, that class's smoothed share.
    """
    chosen = cut(unlike(labelled(docs, labels, "quality", training, sample)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            slots, starts = ngrams(piece.column("text"))
            own = [slots[a:b].astype("<i4").tobytes() for a, b in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("y"), pa.array(own, pa.binary())],
                ["doc_id", "y", "slots"],
            )

    # At most ``sample`` rows reach the driver.
    found = sorted(chosen.mapInArrow(run, "doc_id long, y int, slots binary").collect())
    y = np.array([r.y for r in found], int)
    held = np.array([xxhash.xxh64_intdigest(str(r.doc_id)) % 4 == 0 for r in found], bool)
    return fit([np.frombuffer(r.slots, "<i4").astype(np.int64) for r in found], y, held)


def quality(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) of every row, repeated ones too.

    Null and empty texts score as texts without any n-gram. Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for piece in pieces(batches):
            if len(known) > 300_000:
                known.clear()
            score = sent.value.scores(*ngrams(piece.column("text"), known))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id long, score double")
