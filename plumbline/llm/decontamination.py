"""Benchmark decontamination: which test items lie in which documents.

Items are indexed by size: a partition of the index holds the items of one power-of-two class of
shingle counts. The smallest hashes of an item, the same number throughout a partition, are its
MinHash signature, a random sample of its shingles: the share of them that a document has estimates
how much of the item it contains. An item with s shingles is contained at threshold t only if at most
s - ceil(t s) are missing, so that at most as many of the signature may be: no estimate below that
bound can belong to a contained item, and none above it is passed over. Each partition has a filter
of its signatures and asks for the fewest values that one of its items needs. A document that has
fewer is passed over where it is read; the shingles of the others that may belong to an item are
joined with the partition's items, bounded by the estimate and counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut, pieces, shingles, texts_of, without, words_of

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Most bits of the filter of all shingles, and of the filters of all partitions together.
FILTER_BITS = 1 << 26
#: Bits of a filter for each hash in it, up to the bound.
BITS_EACH = 16
PROBES = 4
#: Size classes that the number of a partition leaves room for.
CLASSES = 64


def most_missing(size: int, threshold: float) -> int:
    """Shingles that a document may lack of an item of ``size`` shingles that it contains."""
    return size - max(1, math.ceil(threshold * size - 1e-9))


def signature_size(size: int, threshold: float) -> int:
    """Smallest hashes kept of an item: twice as many as the largest of its class may lack, and two."""
    largest = (1 << size.bit_length()) - 1
    return 2 * (most_missing(largest, threshold) + 1)


def values_needed(size: int, threshold: float) -> int:
    """Signature values of an item of ``size`` shingles that a document that contains it has."""
    return min(size, signature_size(size, threshold)) - most_missing(size, threshold)


def partition_of(n: int, size: int) -> int:
    """The partition of items with ``size`` shingles of ``n`` words."""
    return n * CLASSES + size.bit_length()


def item_shingles(items: DataFrame, words: int, threshold: float) -> DataFrame:
    """The index: a row for each distinct shingle of each item, with the item's partition ``part``.

    A shingle has ``words`` words, or all of a shorter item. ``signs``: is in the signature of
    ``n_signature`` values, of which a document that contains the item has ``need``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            own, ids = words_of(piece.column("text")), piece.column("item_id").to_pylist()
            keys, names = piece.column("item").to_pylist(), own.distinct.to_pylist()
            h, out = own.hashes(), []
            for d, (a, b) in enumerate(zip(own.starts, own.starts[1:])):
                n = min(words, int(b - a))
                if not n:
                    continue
                found, at = shingles(h[a:b], np.array([0, b - a]), n)
                found, first = np.unique(found, return_index=True)
                kept = min(len(found), signature_size(len(found), threshold))
                need, part = values_needed(len(found), threshold), partition_of(n, len(found))
                for k, i in enumerate(at[first]):
                    text = " ".join(names[c] for c in own.codes[a + i : a + i + n])
                    value = int(found[k].astype(np.int64))
                    out.append((keys[d], ids[d], len(found), kept, need, part, value, text, k < kept))
            columns = list(zip(*out)) if out else [[]] * 9
            kinds = (*[pa.int64()] * 5, pa.int32(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["item", "item_id", "n_shingles", "n_signature", "need", "part", "hash", "shingle", "signs"],
            )

    rows = items.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("item", F.xxhash64("item_id", "text"))
    return rows.distinct().mapInArrow(
        run,
        "item long, item_id long, n_shingles long, n_signature long, need long, part int, hash long,"
        " shingle string, signs boolean",
    )


def _probes(h: np.ndarray, bits: int) -> np.ndarray:
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)])


def _words(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.unique(_probes(h, bits))
    return (own >> np.uint64(6)).astype(np.int64), (np.uint64(1) << (own & np.uint64(63))).view(np.int64)


def bloom(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter of the column ``hash``, built by the tasks; ``bits`` bits reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, mask = _words(batch.column("hash").to_numpy().view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask)], ["word", "mask"])

    words = hashes.select("hash").mapInArrow(run, "word long, mask long")
    table = np.zeros(bits // 64, np.int64)
    found = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table[found["word"].to_numpy()] = found["mask"].to_numpy()
    return table.view(np.uint64)


def partition_filters(index: DataFrame, bits: dict[int, int]) -> dict[int, np.ndarray]:
    """For each ``part`` a Bloom filter of ``bits[part]`` bits over its ``hash`` values, in one job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("hash").to_numpy().view(np.uint64)
            part = batch.column("part").to_numpy()
            for p in np.unique(part):
                word, mask = _words(h[part == p], bits[int(p)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(word), p)), pa.array(word), pa.array(mask)],
                    ["part", "word", "mask"],
                )

    words = index.select("part", "hash").mapInArrow(run, "part int, word long, mask long")
    found = words.groupBy("part", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    part, word, mask = (found[c].to_numpy() for c in ("part", "word", "mask"))
    tables = {}
    for p, own in bits.items():
        table = np.zeros(own // 64, np.int64)
        table[word[part == p]] = mask[part == p]
        tables[p] = table.view(np.uint64)
    return tables


def filter_size(values: int, most: int) -> int:
    """Bits of a filter of so many values: a power of two, at least a word, at most ``most``."""
    return max(64, min(most, 1 << (BITS_EACH * values).bit_length()))


def passes(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter."""
    kept = np.arange(len(h))
    for i in range(PROBES):
        step = (h[kept] >> np.uint64(32)) | np.uint64(1)
        at = (h[kept] + np.uint64(i) * step) & np.uint64(64 * len(table) - 1)
        hit = (table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)
        kept = kept[hit.astype(bool)]
    return kept


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    words: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Items of which at least ``threshold`` of the distinct shingles are in a document.

    Gives ``doc_id``, ``text_hash``, ``item_id``, ``n_shingles``, ``n_shared``, ``containment`` and
    ``estimate``, the share of the item's signature in the document, a row for each distinct
    (doc_id, text) and (item_id, text). Words are runs of other than blanks, A-Z lower-cased. An item
    shorter than a shingle is one shingle of all its words; items and documents that are null or
    empty contain and are contained in nothing. Null ids are kept. Other columns are ignored; empty
    tables give no row. ``filter_bits``, a power of two, bounds the filters; fuller ones cost a larger
    shuffle and change no result.
    """
    spark = docs.sparkSession
    index = cut(item_shingles(items, words, threshold))
    # A row for each partition: at most 64 for shingles of ``words`` words, one for each shorter length.
    classes = index.groupBy("part").agg(
        F.min("need").alias("need"), F.count("*").alias("many"), F.count_if("signs").alias("signing")
    ).collect()
    share_of_bits = filter_bits >> (len(classes) - 1).bit_length() if classes else filter_bits
    sizes = {r.part: filter_size(r.signing, share_of_bits) for r in classes}
    every = spark.sparkContext.broadcast(
        bloom(index, filter_size(sum(r.many for r in classes), filter_bits))
    )
    signing = spark.sparkContext.broadcast(partition_filters(index.where("signs"), sizes))
    needs: dict[int, list[tuple[int, int]]] = {}  # length of a shingle -> partitions
    for r in classes:
        needs.setdefault(r.part // CLASSES, []).append((r.part, r.need))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            own = words_of(piece.column("text"))
            h, found = own.hashes(), []
            for n, partitions in needs.items():
                value, at = shingles(h, own.starts, n)
                seen = passes(every.value, value)
                if not len(seen):
                    continue
                value, at = value[seen], at[seen]
                doc = np.searchsorted(own.starts, at, side="right") - 1
                once = np.unique(np.stack((doc.astype(np.uint64), value)), axis=1, return_index=True)[1]
                value, at, doc = value[once], at[once], doc[once]
                for part, need in partitions:
                    hits = np.bincount(doc[passes(signing.value[part], value)], minlength=len(own.starts))
                    of = np.flatnonzero(hits[doc] >= need)
                    part_of, n_of = np.full(len(of), part, np.int32), np.full(len(of), n)
                    found.append((doc[of], part_of, value[of], at[of], n_of))
            if not sum(len(c[0]) for c in found):
                continue
            doc, part, value, at, n = (np.concatenate(c) for c in zip(*found))
            text = [
                " ".join(own.distinct.take(pa.array(own.codes[i : i + k])).to_pylist())
                for i, k in zip(at, n)
            ]
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id").take(rows),
                    piece.column("text_hash").take(rows),
                    pa.array(part),
                    pa.array(value.view(np.int64)),
                    pa.array(text, pa.string()),
                ],
                ["doc_id", "text_hash", "part", "hash", "shingle"],
            )

    hashed = texts_of(docs).withColumn("text_hash", F.xxhash64("text"))
    hits = hashed.mapInArrow(run, "doc_id long, text_hash long, part int, hash long, shingle string")
    shared = hits.distinct().join(index, ["part", "hash", "shingle"])
    item = ("item", "item_id", "n_shingles", "n_signature", "need")
    counted = shared.groupBy("doc_id", "text_hash", *item).agg(
        F.count("*").alias("n_shared"), F.count_if("signs").alias("n_signed")
    )
    share = F.col("n_shared") / F.col("n_shingles")
    return counted.where((F.col("n_signed") >= F.col("need")) & (share >= threshold)).select(
        "doc_id", "text_hash", "item_id", "n_shingles", "n_shared", share.alias("containment"),
        (F.col("n_signed") / F.col("n_signature")).alias("estimate"),
    )


def without_items(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that contain no item."""
    return without(docs, contained_items(docs, items, **options))
