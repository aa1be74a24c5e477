"""Mixing sources to target weights by a Pfair schedule of blocks.

Each source's target grows at its weight's share of all slots; a source whose target has reached
its last block stops and the others share the slots by their weights. Block i of a source is
released in the slot in which its target passes i and due at the end of the slot in which it
reaches i + 1. Slots are given earliest deadline first among released blocks. Targets are exact
fractions of the given weights and fill every slot, so that every block meets its deadline and
after any number of slots, whichever sources have run out, each source is less than one block from
its target.

The schedule is made in segments, side by side. Which blocks lie before a segment's end is settled
first, for all segments in order: those due by then, and of those whose time goes on beyond it the
ones due first, as many as find room between their release and the end. Only these counts, a number
for each source and segment, are made by the driver; the tasks order the blocks of a segment.
"""

from __future__ import annotations

import heapq
import math
import pickle
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut, ordered_buckets

BLOCK_DOCS = 8
#: Slots of a segment at least; a segment has at least four for each source.
PERIOD = 1 << 14
#: Counts that the driver makes at most, one for each source and segment; segments grow instead.
MOST_COUNTS = 1 << 21


@dataclass
class Edge:
    """What may lie before a segment's end: whole blocks of each source, and blocks that go on."""

    whole: np.ndarray  # blocks due by the end, of each source
    open: np.ndarray  # sources with a block that goes on beyond it
    due: np.ndarray  # its deadline
    level: np.ndarray  # its place in ``room``; -1 if it was released before the segment
    room: np.ndarray  # open blocks that fit, of those at this place or before it


class Targets:
    """Exact targets of sources by slots, in whole numbers; sources in the order they run out."""

    def __init__(self, blocks: dict, weights: dict, period: int = PERIOD) -> None:
        exact = {s: Fraction(weights[s]) for s in blocks}
        unit = math.lcm(*(x.denominator for x in exact.values()))
        self.sources = sorted(blocks, key=lambda s: (blocks[s] / exact[s], s is not None, str(s)))
        self.blocks = [blocks[s] for s in self.sources]
        self.weight = [int(exact[s] * unit) for s in self.sources]
        n = len(self.sources)
        self.gone, self.rate = [0] * (n + 1), [0] * (n + 1)  # once the sources before j ran out
        for j in range(n):
            self.gone[j + 1] = self.gone[j] + self.blocks[j]
        for j in reversed(range(n)):
            self.rate[j] = self.rate[j + 1] + self.weight[j]
        self.total = self.gone[n]
        self.size = max(period, 4 * n, -(-self.total * n // MOST_COUNTS))
        self.segments = -(-self.total // self.size)

    def bounds(self, k: int) -> tuple[int, int]:
        """First slot of segment ``k`` and the one after its last."""
        return k * self.size, min(self.total, (k + 1) * self.size)

    def reached(self, slots: int) -> tuple[list[int], list[int]]:
        """Each source's target after so many slots, rounded down and up."""
        n = len(self.sources)
        j = bisect_left(
            range(n),
            True,
            key=lambda j: (slots - self.gone[j]) * self.weight[j] <= self.rate[j] * self.blocks[j],
        )
        down, up = self.blocks[:j], self.blocks[:j]
        for w in self.weight[j:]:
            whole, rest = divmod(w * (slots - self.gone[j]), self.rate[j])
            down.append(whole)
            up.append(whole + (rest > 0))
        return down, up

    def windows(self, s: int, first: int, stop: int) -> Iterator[tuple[int, int]]:
        """Release and deadline of blocks ``first`` to ``stop`` - 1 of source number ``s``."""
        w, blocks, weight = self.weight[s], self.blocks, self.weight
        j = bisect_left(range(s), True, key=lambda j: blocks[j] * w >= first * weight[j])
        release = self.gone[j] + self.rate[j] * first // w
        for i in range(first + 1, stop + 1):
            while blocks[j] * w < i * weight[j]:
                j += 1
            whole, rest = divmod(self.rate[j] * i, w)
            whole += self.gone[j]
            yield release, whole + (rest > 0)
            release = whole

    def edge(self, k: int) -> Edge:
        """The end of segment ``k``, whatever lies before the segment."""
        a, b = self.bounds(k)
        _, begun = self.reached(a)
        whole, ended = self.reached(b)
        released = np.zeros(b - a + 1, np.int64)
        goes_on = []
        for s, (i, j) in enumerate(zip(begun, whole)):
            for release, _ in self.windows(s, i, j):
                released[release - a] += 1
            if ended[s] > j:
                release, due = next(self.windows(s, j, j + 1))
                goes_on.append((s, due, max(0, release - a)))
        left = (b - a - np.arange(b - a + 1)) - np.cumsum(released[::-1])[::-1]
        levels = sorted({r for _, _, r in goes_on if r}, reverse=True)
        below = [*levels[1:], 0]
        room = [int(left[low + 1 : r + 1].min()) for r, low in zip(levels, below)]
        at = {r: x for x, r in enumerate(levels)} | {0: -1}
        found = [(s, due, at[r]) for s, due, r in goes_on]
        columns = np.array(found, np.int64).reshape(-1, 3).T
        return Edge(np.array(whole, np.int64), *columns, np.array(room, np.int64))

    def counts(self, edges: Iterator[Edge]) -> Iterator[np.ndarray]:
        """Blocks of each source before each segment's end, from the ends in order."""
        done = np.zeros(len(self.sources), np.int64)
        for k, edge in enumerate(edges):
            done = np.maximum(done, edge.whole)
            left, room = self.bounds(k)[1] - int(done.sum()), edge.room.copy()
            for x in np.lexsort((edge.open, edge.due)):
                if not left:
                    break
                s, level = edge.open[x], edge.level[x]
                if done[s] > edge.whole[s]:  # placed in an earlier segment
                    continue
                if level >= 0:
                    if room[level:].min() < 1:
                        continue
                    room[level:] -= 1
                done[s] += 1
                left -= 1
            yield done.copy()

    def order(self, k: int, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The source number of each slot of segment ``k``: earliest deadline first among released blocks."""
        a, b = self.bounds(k)
        waiting: list[tuple] = []  # release, source, deadline
        more = {}
        for s in np.flatnonzero(after > before).tolist():
            more[s] = self.windows(s, int(before[s]), int(after[s]))
            release, due = next(more[s])
            waiting.append((release, s, due))
        heapq.heapify(waiting)
        ready: list[tuple] = []
        out = np.empty(b - a, np.int32)
        for slot in range(a, b):
            while waiting and waiting[0][0] <= slot:
                _, s, due = heapq.heappop(waiting)
                heapq.heappush(ready, (min(due, b), s))
            _, s = heapq.heappop(ready)
            out[slot - a] = s
            following = next(more[s], None)
            if following:
                heapq.heappush(waiting, (following[0], s, following[1]))
        return out

    def placed(self, k: int, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Source number, block and slot of all blocks of segment ``k``, by source and block."""
        order = self.order(k, before, after)
        slots = np.argsort(order, kind="stable")
        source, own = order[slots], after - before
        return source, np.arange(len(slots)) - np.repeat(np.cumsum(own) - own - before, own), slots + self.bounds(k)[0]


@dataclass
class Stretch:
    """Blocks ``first`` to ``stop`` - 1 of a source, placed in one segment."""

    first: int
    stop: int
    slot: int  # first slot of the segment
    period: int
    places: np.ndarray  # slots of the source's blocks within the segment


def schedule(
    rows: dict, weights: dict, block: int = BLOCK_DOCS, period: int = PERIOD
) -> dict[object, list[Stretch]]:
    """Stretches of each source, in order, until all its rows are placed: the whole schedule here."""
    blocks = {s: -(-n // block) for s, n in rows.items() if n}
    out: dict[object, list[Stretch]] = {s: [] for s in blocks}
    if not blocks:
        return out
    targets = Targets(blocks, weights, period)
    before = np.zeros(len(blocks), np.int64)
    for k, after in enumerate(targets.counts(map(targets.edge, range(targets.segments)))):
        a, b = targets.bounds(k)
        source, _, slot = targets.placed(k, before, after)
        for s in np.flatnonzero(after > before):
            places = slot[np.searchsorted(source, s) : np.searchsorted(source, s, side="right")] - a
            out[targets.sources[s]].append(Stretch(int(before[s]), int(after[s]), a, b - a, places))
        before = after
    return out


def placements(spark: SparkSession, targets: Targets) -> DataFrame:
    """Every block's slot: ``_p_source``, the number of its source, ``_p_block``, ``_p_slot``."""
    sent = spark.sparkContext.broadcast(targets)
    segments = spark.range(0, targets.segments, 1, max(1, min(targets.segments, 4096)))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                edge = pa.array([pickle.dumps(sent.value.edge(k))], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([k]), edge], ["id", "edge"])

    edges = sorted(segments.mapInArrow(ends, "id long, edge binary").collect())
    none = np.zeros(len(targets.sources), np.int64)
    counts = np.array([none, *targets.counts(pickle.loads(r.edge) for r in edges)])
    counts_sent = spark.sparkContext.broadcast(counts)  # about MOST_COUNTS numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                found = sent.value.placed(k, counts_sent.value[k], counts_sent.value[k + 1])
                made = [pa.array(x.astype(np.int64)) for x in found]
                yield pa.RecordBatch.from_arrays(made, ["_p_source", "_p_block", "_p_slot"])

    return cut(segments.mapInArrow(run, "_p_source long, _p_block long, _p_slot long"))


def mix(
    docs: DataFrame,
    weights: dict | None = None,
    temperature: float = 0.5,
    block: int = BLOCK_DOCS,
    period: int = PERIOD,
    columns: list[str] | None = None,
    names: tuple[str, str, str] = ("block", "slot", "position"),
) -> DataFrame:
    """Every row with its ``block`` (of its source), ``slot`` and ``position`` in the mixture, under
    the given ``names``.

    Without ``weights`` a source weighs its number of rows to the power ``temperature``; a source
    that the weights leave out weighs as much as the least. Rows of a source are taken in
    ascending doc_id, nulls first; equal ones by a hash of the text. Null is a source of its own.
    No row is dropped or repeated. ``period`` is the least number of slots that a task orders at a
    time. ``columns`` are those of ``docs`` that are kept (default: all; they come before the new
    ones, which take the place of columns of the same names). Sources, whatever their number, are
    listed on the driver, with some counts of each. An empty table gives no row.
    """
    spark, new = docs.sparkSession, list(names)
    kept = [c for c in columns or docs.columns if c not in new]
    rows = docs.select(
        *kept,
        F.col("source").cast("string").alias("_mix_source"),
        F.col("doc_id").cast("long").alias("_mix_id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_mix_hash"),
    )
    dealt = rows.withColumn("_mix_bucket", ordered_buckets(rows, "_mix_id"))
    counts = cut(dealt.groupBy("_mix_source", "_mix_bucket").count())
    totals = {r[0]: r[1] for r in counts.groupBy("_mix_source").agg(F.sum("count")).collect()}
    if weights is None:
        weights = {s: n**temperature for s, n in totals.items()}
    least = min([w for w in weights.values() if w > 0], default=1)
    targets = Targets(
        {s: -(-n // block) for s, n in totals.items()},
        {s: weights.get(s) or least for s in totals},
        period,
    )
    places = placements(spark, targets)
    # A source's last block may be short: documents after it stand so many places earlier.
    last = places.groupBy("_p_source").agg(F.max("_p_slot").alias("slot")).orderBy("slot").collect()
    last_slots = np.array([r.slot for r in last], np.int64)
    missing = np.cumsum([0, *(-totals[targets.sources[r["_p_source"]]] % block for r in last)])

    @F.arrow_udf("long")
    def earlier(slots: pa.Array) -> pa.Array:
        return pa.array(missing[np.searchsorted(last_slots, slots.to_numpy())])

    numbers = spark.createDataFrame(list(enumerate(targets.sources)), "_mix_number long, _n string")
    before = counts.join(numbers, F.col("_mix_source").eqNullSafe(F.col("_n"))).select(
        F.col("_mix_source").alias("_s"),
        F.col("_mix_bucket").alias("_b"),
        "_mix_number",
        (
            F.sum("count").over(Window.partitionBy("_mix_source").orderBy("_mix_bucket")) - F.col("count")
        ).alias("_mix_before"),
    )
    ranked = dealt.withColumn(
        "_mix_rank",
        F.row_number().over(Window.partitionBy("_mix_source", "_mix_bucket").orderBy("_mix_id", "_mix_hash")) - 1,
    )
    rank = F.col("_mix_rank") + F.col("_mix_before")
    numbered = ranked.join(
        before, ranked["_mix_source"].eqNullSafe(before["_s"]) & (ranked["_mix_bucket"] == before["_b"])
    ).select(
        *kept,
        "_mix_number",
        ((rank - rank % block) / block).cast("long").alias("_mix_block"),
        (rank % block).cast("long").alias("_mix_within"),
    )
    placed = numbered.join(
        places,
        (numbered["_mix_number"] == places["_p_source"]) & (numbered["_mix_block"] == places["_p_block"]),
    )
    position = F.col("_p_slot") * block - earlier("_p_slot") + F.col("_mix_within")
    made = [F.col("_mix_block"), F.col("_p_slot"), position]
    return placed.select(*kept, *[c.alias(name) for c, name in zip(made, new)])
