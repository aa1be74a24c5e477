"""Near duplicates by SimHash of word shingles, linked through deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import as_bytes, cut, pieces, texts_of
from plumbline.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Fingerprints of one signature that a task compares with each other; larger sets are dealt out
#: as pairs of blocks of this size.
CELL = 1 << 14


def simhash(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if over half of the shingles' XXH64 (seed 42) have it; no word: 0."""
    own = text.lower().split()
    if not own:
        return 0
    line = b" ".join(own)
    blank = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    first = np.concatenate(([0], blank + 1))
    last = np.concatenate((blank, [len(line)]))
    n = max(1, len(own) - words + 1)
    ones = np.zeros(64, np.int64)
    each = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        stop = min(n, at + (1 << 16))
        ends = last[at + words - 1 : stop + words - 1] if len(own) >= words else last[-1:]
        spans = zip(first[at:stop].tolist(), ends.tolist())
        h = np.fromiter((each(line[i:j], 42) for i, j in spans), np.uint64, stop - at)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``text_hash`` (64 bits of the whole text) and ``fp``, the fingerprint as a long.

    Words are runs of other than blanks; A-Z are lower-cased. Null and empty texts give 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            own = np.fromiter(
                (simhash(t, words) for t in as_bytes(piece.column("text"))), np.uint64, len(piece)
            )
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("text_hash"), pa.array(own.view(np.int64))],
                ["doc_id", "text_hash", "fp"],
            )

    rows = texts_of(docs).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of the fewest segments of which one has at most one differing bit."""
    n = max_bits // 2 + 1
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def signatures(fp: Column, max_bits: int) -> Column:
    """Every segment with one of its bits blanked out, tagged with the place of that bit."""
    own = []
    for offset, width in segments(max_bits):
        part = F.shiftrightunsigned(fp, offset)
        if width < 64:
            part = part.bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        for i in range(width):
            others = (1 << 63) - 1 if i == 63 else ~(1 << i)  # as a signed number
            kept = part.bitwiseAND(F.lit(others).cast("long"))
            if width > 55:  # one segment: no room for the tag
                own.append(F.xxhash64(F.lit(i), kept))
            else:
                own.append(kept.bitwiseOR(F.lit((offset + i) << 56).cast("long")))
    return F.array(*own)


def _spanning(key: np.ndarray, fp: np.ndarray, max_bits: int) -> np.ndarray:
    """Index pairs within the radius that connect all that is connected within equal keys.

    Every pair of a key is compared, in array steps; a pair is reported only if it joins what
    was apart, so that a key with n fingerprints gives about n pairs, not their square.
    """
    group = np.arange(len(fp))
    out = []
    at, lag = np.arange(len(fp)), 0
    while True:
        lag += 1
        at = at[at + lag < len(fp)]
        at = at[key[at] == key[at + lag]]
        if not len(at):
            break
        u = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= max_bits]
        u = u[group[u] != group[u + lag]]
        if not len(u):
            continue
        v = u + lag
        out.append(np.stack((u, v)))
        while True:
            a, b = group[u], group[v]
            if (a == b).all():
                break
            np.minimum.at(group, np.maximum(a, b), np.minimum(a, b))
            while (group != group[group]).any():
                group = group[group]
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)


def _linker(max_bits: int, cell: int):
    """Reads rows sorted by key; gives links (a, b) and, of keys above ``cell``, the rows by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(key, fp):
            u, v = _spanning(key, fp, max_bits)
            return made(fp[u].view(np.int64), fp[v].view(np.int64), None, None)

        def made(a, b, key, block):
            n = len(a) if a is not None else len(key)
            none = pa.nulls(n, pa.int64())
            return pa.RecordBatch.from_arrays(
                [none if x is None else pa.array(x) for x in (a, b, key, block)],
                ["a", "b", "key", "block"],
            )

        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        spilling, filled = None, 0  # the key that is too large, and its rows so far
        for batch in batches:
            keys = np.concatenate((keys, batch.column("key").to_numpy()))
            fps = np.concatenate((fps, batch.column("fp").to_numpy().view(np.uint64)))
            if len(keys) < cell:
                continue
            if spilling is not None:
                n = int(np.searchsorted(keys, spilling, side="right"))
                if n:
                    block = (filled + np.arange(n)) // cell
                    yield made(fps[:n].view(np.int64), None, keys[:n], block)
                    filled += n
                    keys, fps = keys[n:], fps[n:]
                if len(keys):
                    spilling = None
            if len(keys):
                whole = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if whole:
                    yield links(keys[:whole], fps[:whole])
                    keys, fps = keys[whole:], fps[whole:]
                if len(keys) > cell:
                    spilling, filled = int(keys[-1]), len(keys)
                    yield made(fps.view(np.int64), None, keys, np.arange(len(keys)) // cell)
                    keys, fps = keys[:0], fps[:0]
        if spilling is not None:
            n = int(np.searchsorted(keys, spilling, side="right"))
            if n:
                block = (filled + np.arange(n)) // cell
                yield made(fps[:n].view(np.int64), None, keys[:n], block)
            keys, fps = keys[n:], fps[n:]
        if len(keys):
            yield links(keys, fps)

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, cell: int = CELL) -> DataFrame:
    """Pairs ``a``, ``b`` of fingerprints within ``max_bits`` that connect all that such pairs do.

    ``distinct`` has a column ``fp`` without repeats. Every two fingerprints within the radius
    share a signature and are compared there; of the links within one signature only those that
    connect are given. A signature that over ``cell`` fingerprints share is compared by pairs of
    blocks, each in a task of its own, so that no task holds it whole.
    """
    rows = distinct.select("fp", F.explode(signatures(F.col("fp"), max_bits)).alias("key"))
    dealt = rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
    shape = "a long, b long, key long, block long"
    found = cut(dealt.mapInArrow(_linker(max_bits, cell), shape))
    small = found.where("b is not null").select("a", "b")
    large = found.where("block is not null")
    if large.limit(1).count():
        blocks = large.groupBy("key").agg((F.max("block") + 1).alias("n"))
        pairs = large.join(blocks, "key").select(
            F.col("a").alias("fp"),
            F.explode(
                F.transform(
                    F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
                    lambda o: F.xxhash64("key", F.least("block", o), F.greatest("block", o)),
                )
            ).alias("key"),
        )
        dealt = pairs.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
        cells = dealt.mapInArrow(_linker(max_bits, 4 * cell), shape)
        small = small.union(cells.where("b is not null").select("a", "b"))
    return small.distinct()


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp``, ``component_id`` (smallest doc_id reachable) and ``root`` (a
    fingerprint that names the component, one of its smallest doc_id's) of every row.

    Fingerprints with at most ``max_bits`` differing bits are linked. Rows with equal fingerprints
    are handled as one, whatever their number. Null and empty texts have fingerprint 0 and are
    linked like any other. Rows with a null doc_id take part; a group that has no other rows has
    a null component. Repeated rows are all returned. Other columns are ignored. An empty table
    gives no row.
    """
    rows = cut(fingerprints(docs, words))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    # Nodes in the order of their smallest doc_id, so that a component's root is its answer.
    node = F.struct(F.col("least").isNull().alias("none"), "least", "fp")
    nodes = distinct.select("fp", node.alias("node"))
    near = links(distinct.select("fp"), max_bits)
    for side in ("a", "b"):
        named = nodes.select(F.col("fp").alias("own"), F.col("node").alias(f"node_{side}"))
        near = near.join(named, near[side] == named["own"]).drop("own")
    roots = components(near, "node_a", "node_b").select("node.fp", "root")
    linked = roots.select("fp", F.col("root.least").alias("component_id"), F.col("root.fp").alias("root"))
    alone = distinct.join(roots.select("fp"), "fp", "left_anti").select(
        "fp", F.col("least").alias("component_id"), F.col("fp").alias("root")
    )
    return rows.join(linked.union(alone), "fp").select(
        "doc_id", "text_hash", "fp", "component_id", "root"
    )


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents without near duplicates: of each group one row stays, with all its columns.

    It is the row with the smallest doc_id (nulls last), then the smallest hash of its text; of
    rows that repeat in both, one stays.
    """
    found = near_duplicates(docs, words, max_bits)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("best")
    kept = found.groupBy("root").agg(best)
    kept = kept.select(
        F.col("best.doc_id").alias("_kept_id"), F.col("best.text_hash").alias("_kept_hash")
    ).distinct()
    hashed = docs.withColumn(
        "_text_hash", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    ).withColumn("_doc_id", F.col("doc_id").cast("long"))
    stay = hashed.join(
        kept,
        hashed["_doc_id"].eqNullSafe(kept["_kept_id"]) & (hashed["_text_hash"] == kept["_kept_hash"]),
        "left_semi",
    )
    return stay.dropDuplicates(["_doc_id", "_text_hash"]).select(*docs.columns)
