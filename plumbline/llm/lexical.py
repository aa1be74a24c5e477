"""Ranked lexical search: exact inner products through sparse ball trees.

A document is the vector of the weights of its terms, an item that of its term counts; the score is
their inner product in integers. Tasks build a ball tree over a few thousand documents at a time,
from the terms that occur in items alone. No document of a ball scores more than ``item . centre +
|item| * radius``, by Cauchy and Schwarz. As counts are not negative, only what a document has above
the centre adds to the radius, and each term's own radius above the centre gives a second bound:
the lower one counts. The search opens the most promising ball first and stops when none can reach
the tenth best score so far.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import Words, as_bytes, cut, pieces, texts_of, words_of

TOP = 10
#: Documents of one tree, and of one leaf.
TREE_ROWS, LEAF_ROWS = 4096, 8
#: Items of one search, and about how many terms they may have together.
SEARCH_ITEMS, SEARCH_TERMS = 256, 4096
#: Numbers of the centres of one tree; trees over more terms have fewer documents.
CENTRE_CELLS = 1 << 22
#: Text of the items that go to the tasks at a time; a longer item goes alone.
ITEM_CHARS = 4_000_000
#: One in so many documents is searched beforehand, for a floor under the tenth best score.
FLOOR_SHARE = 64
#: Bounds are raised by this share, far more than floating point can lose, and by one.
SLACK = 1e-9

_FOLDED = np.array(
    [
        b if b >= 128 or chr(b).isalnum() and not chr(b).isupper()
        else b + 32 if chr(b).isupper() else 32
        for b in range(256)
    ],
    np.uint8,
)


def terms_of(texts: pa.Array) -> Words:
    """Runs of letters, digits and characters beyond ASCII; A-Z lower-cased."""
    n, texts = len(texts), texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    folded = _FOLDED[raw[offsets[0] : offsets[-1]]]
    moved = (offsets - offsets[0]).astype(np.int32)
    plain = pa.StringArray.from_buffers(n, pa.py_buffer(moved), pa.py_buffer(folded))
    return words_of(plain, lower=False)


@dataclass
class Items:
    """Items of one pass: their ids, and term codes and counts; ``terms`` are all terms in order."""

    ids: list[int | None]
    codes: list[np.ndarray]
    counts: list[np.ndarray]
    terms: list[bytes]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]]) -> Items:
        found = [terms_of(pa.array([text])) for _, text in rows]
        terms = sorted({t for w in found for t in as_bytes(w.distinct) if t})
        number = {t: i for i, t in enumerate(terms)}
        codes, counts = [], []
        for w in found:
            known = np.array([number.get(t, -1) for t in as_bytes(w.distinct)], np.int64)
            own, many = np.unique(known[w.codes], return_counts=True)
            codes.append(own.astype(np.int64))
            counts.append(many.astype(np.int64))
        return cls([i for i, _ in rows], codes, counts, terms)

    def searches(self) -> list[np.ndarray]:
        """Items that are searched together."""
        groups: list[list[int]] = []
        terms: set[int] = set()
        for i, own in enumerate(self.codes):
            if not len(own):
                continue
            terms.update(own.tolist())
            if not groups or len(groups[-1]) >= SEARCH_ITEMS or len(terms) > SEARCH_TERMS:
                groups.append([])
                terms = set(own.tolist())
            groups[-1].append(i)
        return [np.array(g) for g in groups]


def vectors(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """``doc_id``, ``n`` (terms in all), ``terms`` (codes of those in the list) and ``tfs`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, many = sent.value, len(sent.value)
        for piece in pieces(batches):
            found = terms_of(piece.column("text"))
            known = np.array([number.get(t, -1) for t in as_bytes(found.distinct)], np.int64)
            own = known[found.codes] if len(found.codes) else np.zeros(0, np.int64)
            row = np.repeat(np.arange(len(piece)), found.counts)
            kept = own >= 0
            pairs, tfs = np.unique(row[kept] * many + own[kept], return_counts=True)
            row, own = (pairs // many, pairs % many) if many else (pairs, pairs)
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(piece)))))
            ends = pa.array(ends.astype(np.int32))
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (own, tfs)
            ]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(found.counts), *lists], ["doc_id", "n", "terms", "tfs"]
            )

    return texts_of(docs).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


@dataclass
class Rows:
    """Sparse vectors: row i has the columns ``at[ends[i]:ends[i + 1]]`` with ``values``; none is empty."""

    ids: np.ndarray
    ends: np.ndarray
    at: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, rows: np.ndarray) -> Rows:
        size = self.ends[rows + 1] - self.ends[rows]
        ends = np.concatenate(([0], np.cumsum(size)))
        own = np.repeat(self.ends[rows] - ends[:-1], size) + np.arange(ends[-1])
        return Rows(self.ids[rows], ends, self.at[own], self.values[own])

    def columns(self, kept: np.ndarray) -> Rows:
        """The rows that have any of the columns that ``kept`` gives a new number, -1 for none."""
        own = kept[self.at]
        row = np.repeat(np.arange(len(self)), np.diff(self.ends))[own >= 0]
        size = np.bincount(row, minlength=len(self))
        some = np.flatnonzero(size)
        ends = np.concatenate(([0], np.cumsum(size[some])))
        return Rows(self.ids[some], ends, own[own >= 0], self.values[own >= 0])

    def dot(self, vector: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.values * vector[self.at], self.ends[:-1])


class BallTree:
    """Balls over sparse rows: the ``centre`` and the ``top`` (greatest value of each term) of every ball
    as a column, the ``radius``, ``children`` of inner balls and rows of ``leaves``."""

    def __init__(self, rows: Rows, width: int, leaf_rows: int = LEAF_ROWS):
        self.children: dict[int, tuple[int, int]] = {}
        self.leaves: dict[int, Rows] = {}
        centres, tops, radii = [], [], []
        todo = [(rows, -1)]
        while todo:
            own, parent = todo.pop()
            node = len(radii)
            centre = np.bincount(own.at, weights=own.values, minlength=width) / len(own)
            top = np.zeros(width)
            np.maximum.at(top, own.at, own.values)
            over = np.maximum(own.values - centre[own.at], 0)
            centres.append(centre)
            tops.append(top)
            radii.append(math.sqrt(np.add.reduceat(over**2, own.ends[:-1]).max()))
            if parent >= 0:
                self.children[parent] = (*self.children.get(parent, ()), node)
            if len(own) <= leaf_rows:
                self.leaves[node] = own
            else:
                todo += [(half, node) for half in _halves(own, centre)]
        self.centre, self.top = (np.ascontiguousarray(np.array(x).T) for x in (centres, tops))
        self.radius = np.array(radii)

    def bounds(self, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """For each ball, a number that no inner product with a query exceeds in it. A query has
        ``counts``, none negative, in some ``columns``."""
        query = counts.astype(float)
        ball = query @ self.centre[columns] + math.sqrt(query @ query) * self.radius
        return np.minimum(ball, query @ self.top[columns]) * (1 + SLACK) + 1


def _halves(rows: Rows, centre: np.ndarray) -> list[Rows]:
    """Rows nearer to one of two that lie far apart, and the others, in halves of equal size."""

    def far(vector: np.ndarray) -> np.ndarray:
        i = int(np.argmax(squares - 2 * rows.dot(vector)))
        out = np.zeros(len(vector))
        out[rows.at[rows.ends[i] : rows.ends[i + 1]]] = rows.values[rows.ends[i] : rows.ends[i + 1]]
        return out

    squares = np.add.reduceat(rows.values.astype(float) ** 2, rows.ends[:-1])
    one = far(centre)
    order = np.argsort(rows.dot(far(one) - one), kind="stable")
    half = len(rows) // 2
    return [rows.take(np.sort(order[:half])), rows.take(np.sort(order[half:]))]


class Best:
    """The best documents of every item so far, and the score that a further one must reach."""

    def __init__(self, items: int, floors: np.ndarray | None, top: int):
        self.floors = np.ones(items, np.int64) if floors is None else floors
        self.top = top
        self.found: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]

    def least(self, item: int) -> int:
        own = self.found[item]
        return max(int(self.floors[item]), -own[-1][0] if len(own) == self.top else 1)

    def add(self, item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        kept = np.flatnonzero(scores >= self.least(item))
        if len(kept):
            new = [
                (-int(scores[k]), ids[k] is None, 0 if ids[k] is None else ids[k]) for k in kept.tolist()
            ]
            self.found[item] = heapq.nsmallest(self.top, self.found[item] + new)


def search(tree: BallTree, item: int, columns: np.ndarray, counts: np.ndarray, best: Best) -> int:
    """Adds the tree's best documents for an item; returns how many were scored."""
    bound, scored = tree.bounds(columns, counts), 0
    if bound[0] < best.least(item):
        return 0
    query = np.zeros(len(tree.centre), np.int64)
    query[columns] = counts
    open_balls = [(-bound[0], 0)]
    while open_balls:
        reach, node = heapq.heappop(open_balls)
        if -reach < best.least(item):
            break
        if node in tree.leaves:
            leaf = tree.leaves[node]
            scored += len(leaf)
            best.add(item, leaf.ids, leaf.dot(query))
        else:
            for child in tree.children[node]:
                if bound[child] >= best.least(item):
                    heapq.heappush(open_balls, (-bound[child], child))
    return scored


def _rows(batch: pa.RecordBatch, weights: np.ndarray, many: int, total: int) -> Rows:
    """Weighted vectors of a batch; ``many`` documents have ``total`` terms."""
    terms, tfs = batch.column("terms"), batch.column("tfs")
    ends = terms.offsets.to_numpy().astype(np.int64)
    at = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    tf = tfs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    length = [25 + (75 * n * many) // total if n else 25 for n in batch.column("n").to_pylist()]
    size = np.diff(ends)
    m = np.repeat(np.array(length, np.int64), size)
    values = weights[at] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
    some = np.flatnonzero(size)
    ids = np.array(batch.column("doc_id").to_pylist(), object)
    return Rows(ids[some], np.concatenate(([0], np.cumsum(size[some]))), at, values)


def _joined(parts: list[Rows]) -> Rows:
    before = np.cumsum([0] + [p.ends[-1] for p in parts])
    ends = [p.ends[1:] + n for p, n in zip(parts, before)]
    return Rows(
        np.concatenate([p.ids for p in parts]),
        np.concatenate([[0], *ends]),
        np.concatenate([p.at for p in parts]),
        np.concatenate([p.values for p in parts]),
    )


def _found(rows: DataFrame, items: Items, weights: np.ndarray, many: int, total: int, floors, top: int):
    """``item`` (its number), ``doc_id`` and ``score``: the best documents of each task for each item."""
    groups = items.searches()
    sent = rows.sparkSession.sparkContext.broadcast((items.codes, items.counts, groups, weights, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, groups, weights, floors = sent.value
        best = Best(len(codes), floors, top)

        def searched(own: Rows) -> None:
            for group in groups:
                columns = np.unique(np.concatenate([codes[i] for i in group]))
                number = np.full(len(weights), -1, np.int64)
                number[columns] = np.arange(len(columns))
                near = own.columns(number)
                step = max(LEAF_ROWS, min(TREE_ROWS, CENTRE_CELLS // len(columns) * LEAF_ROWS // 2))
                for start in range(0, len(near), step):
                    part = near.take(np.arange(start, min(len(near), start + step)))
                    tree = BallTree(part, len(columns))
                    for i in group.tolist():
                        search(tree, i, number[codes[i]], counts[i], best)

        waiting: list[Rows] = []
        for batch in batches:
            for start in range(0, batch.num_rows, TREE_ROWS):
                waiting.append(_rows(batch.slice(start, TREE_ROWS), weights, many, total))
                if sum(map(len, waiting)) >= TREE_ROWS:
                    searched(_joined(waiting))
                    waiting = []
        if sum(map(len, waiting)):
            searched(_joined(waiting))
        out = [
            (item, None if none else doc, -less)
            for item, own in enumerate(best.found)
            for less, none, doc in own
        ]
        kinds = (pa.int32(), pa.int64(), pa.int64())
        columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    found = rows.select("doc_id", "n", "terms", "tfs").mapInArrow(
        run, "item int, doc_id long, score long"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _searched(docs: DataFrame, items: Items, top: int) -> DataFrame:
    rows = cut(vectors(docs, items.terms))
    some = F.col("n") > 0
    many, total = rows.agg(F.count(F.when(some, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequencies = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(items.terms), np.int64)
    for term, df in frequencies:
        weights[term] = math.floor(1000 * math.log((2 * many + 2) / (2 * df + 1)))
    ask = rows.where(F.size("terms") > 0)
    first = ask.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(FLOOR_SHARE)) == 0)
    floors = np.ones(len(items.ids), np.int64)
    for row in _found(first, items, weights, many, total, floors, top).where(F.col("rank") == top).collect():
        floors[row["item"]] = row["score"]
    names = F.from_json(F.lit(json.dumps(items.ids)), "array<long>")
    found = _found(ask, items, weights, many, total, floors, top)
    return found.select(names[F.col("item")].alias("item_id"), "rank", "doc_id", "score")


def ranked(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``: the ``top`` documents of each item with
    a score above 0, the highest first, equal scores by ascending doc_id (null last).

    Null texts have no terms, and an item without terms no rows. Rows of ``benchmark`` equal in
    item_id and text are one item, those equal in item_id alone are ranked apart. Every row of
    ``docs`` takes part, also repeated ones. Other columns are ignored. Items go to the tasks in
    blocks of about ``ITEM_CHARS`` characters, each searched against all documents.
    """
    own = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct()
    chars = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // ITEM_CHARS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for i in range(blocks):
        items = Items.of([tuple(r) for r in own.where(block == i).orderBy("item_id", "text").collect()])
        found = _searched(docs, items, top)
        out = found if out is None else out.union(found)
    return out
