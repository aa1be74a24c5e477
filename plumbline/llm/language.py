"""Language identification by cross-parsing with suffix automata.

A suffix automaton of some labelled text of each language recognises every substring of it. A
text is parsed against it into longest matches, one after another; the number of phrases, times
the logarithm of the sample's length and divided by the length of the text, estimates the cross
entropy. The language that needs the fewest normalised phrases wins.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import open_folder, pieces, shared_folder, texts_of
from plumbline.llm.toxicity import lowered

#: Characters of the labelled sample of a language, and of the pieces that it is made of.
SAMPLE_CHARS, PIECE_CHARS = 24_000, 400
#: Pieces looked at for each one that fits the sample, so that near copies can be left out.
SPARE = 4
#: Languages whose automata a task holds at a time.
HELD_LANGUAGES = 100
#: Characters parsed as one run; phrases do not cross its ends, alike for all languages.
RUN = 512
SPACE, UNKNOWN = 0, 1
UNDETERMINED = "und"

_LETTER = np.zeros(0x110000, bool)


def is_letter() -> np.ndarray:
    """Whether each code point is a letter; made once in a process."""
    if not _LETTER.any():
        _LETTER[:] = [chr(i).isalpha() for i in range(0x110000)]
    return _LETTER


def transitions(codes: list[int]) -> list[dict[int, int]]:
    """The next state by symbol for each state of the suffix automaton of a text."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return moves


@dataclass
class Steps:
    """An automaton's transitions laid over one another in one array.

    The step of state s by symbol c is at ``base[s] + c`` if ``owner`` is s there. ``first`` has
    the state after the first letter of a phrase; 0 where the sample lacks the letter.
    """

    base: np.ndarray
    owner: np.ndarray
    after: np.ndarray
    first: np.ndarray


def steps_of(moves: list[dict[int, int]], alphabet: int) -> Steps:
    """``moves`` in cells of their own: states of many steps first, each where all its cells are free."""
    cells = alphabet + 2 * sum(map(len, moves))
    owner, after = np.full(2 * cells, -1, np.int32), np.zeros(2 * cells, np.int32)
    base = np.zeros(len(moves), np.int64)
    at = size = 0
    for s in sorted((s for s, row in enumerate(moves) if len(row) > 1), key=lambda s: -len(moves[s])):
        own = np.array(sorted(moves[s]), np.int64)
        if len(own) != size:  # fewer steps may fit where more did not
            at, size = int(np.argmax(owner < 0)), len(own)
        while True:
            if at + 512 + alphabet > len(owner):
                owner = np.concatenate([owner, np.full(cells, -1, np.int32)])
                after = np.concatenate([after, np.zeros(cells, np.int32)])
                continue
            room = np.flatnonzero(owner[at : at + 512] < 0) + at
            fits = room[(owner[room[:, None] + (own - own[0])] < 0).all(axis=1)]
            if len(fits):
                break
            at += 512
        base[s] = fits[0] - own[0]
        owner[base[s] + own] = s
        after[base[s] + own] = [moves[s][c] for c in own.tolist()]
    ones = [(s, *row.items()) for s, row in enumerate(moves) if len(row) == 1]
    state = np.array([s for s, _ in ones], np.int64)
    symbol, to = np.array([step for _, step in ones], np.int64).reshape(-1, 2).T
    cell = np.flatnonzero(owner < 0)[: len(ones)]  # any free cell will do
    base[state] = cell - symbol
    owner[cell], after[cell] = state, to
    first = np.zeros(alphabet, np.int32)
    for c, t in moves[0].items():
        first[c] = t
    # A base may lie before the first cell; cells are shifted so that all lookups fall inside.
    shift = alphabet
    used = int(np.flatnonzero(owner >= 0).max(initial=-1)) + 1
    edge = np.full(shift, -1, np.int32)
    return Steps(
        (base + shift).astype(np.int32),
        np.concatenate([edge, owner[:used], edge]),
        np.concatenate([edge, after[:used], edge]),
        first,
    )


@dataclass
class Model:
    """For each language the steps of its automaton and the logarithm of its sample's length.

    ``symbols`` numbers the letters that any sample has; all others are ``UNKNOWN``, which no
    sample has. A letter that a language's sample lacks matches nothing of it.
    """

    languages: list[str]
    symbols: dict[int, int]
    steps: list[Steps]
    bits: list[float]

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of lower-cased texts, other than letters as single spaces; where each text
        begins; whether it has a letter."""
        points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
        doc = np.repeat(np.arange(len(texts)), [len(p) for p in points])
        flat = np.concatenate([*points, np.zeros(0, np.uint32)]).astype(np.int64)
        number = np.where(is_letter(), UNKNOWN, SPACE).astype(np.int32)
        number[list(self.symbols)] = list(self.symbols.values())
        own = number[flat]
        kept = np.ones(len(own), bool)
        kept[1:] = (own[1:] != SPACE) | (own[:-1] != SPACE) | (doc[1:] != doc[:-1])
        counts = np.bincount(doc[kept], minlength=len(texts))
        lettered = np.bincount(doc[own != SPACE], minlength=len(texts)) > 0
        return own[kept], np.concatenate(([0], np.cumsum(counts))), lettered

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases by text and language, symbols by text, whether the text has a letter."""
        flat, starts, lettered = self.codes(texts)
        n = np.diff(starts)
        runs = -(-n // RUN)
        doc = np.repeat(np.arange(len(texts)), runs)
        number = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
        first = starts[doc] + number * RUN
        size = np.minimum(starts[doc + 1] - first, RUN)
        order = np.argsort(-size, kind="stable")
        doc, first, size = doc[order], first[order], size[order]
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        active = [int(np.searchsorted(-size, -j, side="left")) for j in range(RUN)]
        for k, steps in enumerate(self.steps):
            state = np.zeros(len(doc), np.int32)
            ended = np.ones(len(doc), np.int64)  # the phrase that the run's end closes
            for j in range(RUN):
                m = active[j]
                if not m:
                    break
                symbol = flat[first[:m] + j]
                cell = steps.base[state[:m]] + symbol
                miss = steps.owner[cell] != state[:m]
                ended[:m] += miss
                state[:m] = np.where(miss, steps.first[symbol], steps.after[cell])
            total[:, k] = np.bincount(doc, ended, minlength=len(texts)).astype(np.int64)
        return total, n, lettered

    def entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Normalised phrases by text and language, whether the text has a letter."""
        phrases, n, lettered = self.phrases(texts)
        return phrases * np.array(self.bits) / np.maximum(n, 1)[:, None], lettered


def predict(parts: Iterable[Model], texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The language of each text, by name where tied, and its share of the evidence; of all parts of
    a model."""
    names, found, lettered = [], [], np.zeros(len(texts), bool)
    for part in parts:
        if part.languages and texts:
            own, lettered = part.entropy(texts)
            found.append(own)
            names += part.languages
    if not found:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    entropy = np.concatenate(found, axis=1)
    best = entropy.argmin(axis=1)
    share = np.exp(-8 * (entropy - entropy.min(axis=1)[:, None]))
    score = np.where(lettered, 1 / share.sum(axis=1), 0.0)
    return [names[b] if x else UNDETERMINED for b, x in zip(best, lettered)], score


def _shingles(text: str) -> set[str]:
    words = text.split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def sample_of(pieces_: list[str], chars: int) -> str:
    """Letters and single spaces of pieces, in order, until ``chars`` are full; no piece of which half
    the word shingles are there already."""
    letters, seen, out, size = is_letter(), set(), [], 0
    for piece in pieces_:
        plain = "".join(c if letters[ord(c)] else " " for c in piece.lower())
        plain = " ".join(plain.split())
        own = _shingles(plain)
        if not plain or 2 * len(own & seen) > len(own):
            continue
        seen |= own
        out.append(plain)
        size += len(plain) + 1
        if size > chars:
            break
    return " ".join(out)[:chars]


def model_of(samples: dict[str, list[str]], chars: int = SAMPLE_CHARS) -> Model:
    """Automata of the samples; every letter of them has a symbol of its own."""
    texts = {name: sample_of(samples[name], chars) for name in sorted(samples)}
    found = sorted(set("".join(texts.values())) - {" "})
    symbols = {ord(c): i + 2 for i, c in enumerate(found)}
    steps, bits = [], []
    for text in texts.values():
        codes = [SPACE if c == " " else symbols[ord(c)] for c in text]
        steps.append(steps_of(transitions(codes), len(symbols) + 2))
        bits.append(float(np.log2(len(text) + 2)))
    return Model(list(texts), symbols, steps, bits)


def _pieces_of(rows: DataFrame, size: int, most: DataFrame) -> DataFrame:
    """``lang``, ``hash`` and ``piece`` of the pieces of whole texts whose hash is at most the language's
    ``most``; a task gives equal pieces once."""
    limits = {r.lang: r.most for r in most.collect()}  # a row for each language
    sent = rows.sparkSession.sparkContext.broadcast(limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = set()
        for part in pieces(batches):
            out = []
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                limit = sent.value[lang]
                for i in range(0, len(text), size):
                    piece = text[i : i + size]
                    h = xxhash.xxh64_intdigest(piece.encode("utf-8", "surrogatepass")) >> 1
                    if h <= limit and (lang, h) not in given:
                        given.add((lang, h))
                        out.append((lang, h, piece))
            columns = list(zip(*out)) if out else [[]] * 3
            kinds = (pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "hash", "piece"]
            )

    found = rows.select("lang", "text").mapInArrow(run, "lang string, hash long, piece string")
    return found.dropDuplicates(["lang", "hash"])


def learn(
    docs: DataFrame, training: Column, chars: int = SAMPLE_CHARS, piece: int = PIECE_CHARS
) -> Model:
    """A model from ``chars`` letters of each language, however many languages there are.

    Whole texts are cut into pieces of ``piece`` characters; the sample has those of smallest hash,
    some times more than fit, without near copies among them. Rows without language or text are
    left out; equal texts and equal pieces count once. The driver gets a few times ``chars``
    characters of each language.
    """
    rows = texts_of(docs, F.col("lang").cast("string").alias("lang")).where("lang is not null")
    rows = rows.where(training).where(F.col("text") != "")
    texts = rows.select(
        "lang", F.xxhash64("text").alias("hash"), F.ceil(F.length("text") / piece).alias("n")
    ).distinct()
    wanted = SPARE * -(-chars // piece)
    share = F.least(F.lit(1.0), F.lit(float(wanted)) / F.sum("n"))
    most = texts.groupBy("lang").agg((share * F.lit(float(1 << 62)) * 2).alias("most"))
    found = _pieces_of(rows, piece, most).collect()
    samples: dict[str, list[str]] = {}
    for r in sorted(found):
        samples.setdefault(r.lang, []).append(r.piece)
    return model_of(samples, chars)


def _sent(docs: DataFrame, model: Model, held: int):
    """A function for tasks: the model's parts, of ``held`` languages each. The only part is broadcast;
    several are written to the shared folder, and a task reads one after the other."""
    parts = [
        Model(model.languages[i : i + held], model.symbols, model.steps[i : i + held], model.bits[i : i + held])
        for i in range(0, max(1, len(model.languages)), held)
    ]
    if len(parts) == 1:
        sent = docs.sparkSession.sparkContext.broadcast(parts[0])
        return lambda: iter([sent.value])
    folder, files = shared_folder(docs.sparkSession), len(parts)
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    for i, part in enumerate(parts):
        with system.open_output_stream(f"{path}/{i}") as out:
            out.write(pickle.dumps(part))

    def read() -> Iterator[Model]:
        system, path = open_folder(folder)
        for i in range(files):
            with system.open_input_stream(f"{path}/{i}") as part:
                yield pickle.loads(part.read())

    return read


def languages(docs: DataFrame, model: Model, held: int = HELD_LANGUAGES) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1) of every row, repeated ones too.

    Whole texts are parsed, against ``held`` languages at a time. Texts that are null or have no
    letter are ``und`` with score 0, and so are all if nothing was learned. Ties go to the first
    name. Other columns are ignored.
    """
    parts = _sent(docs, model, held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=1 << 21):
            lang, score = predict(parts(), lowered(piece.column("text")).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return texts_of(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
