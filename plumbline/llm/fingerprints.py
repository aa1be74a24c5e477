"""Document fingerprints by SimHash of weighted words, and search by permuted block tables."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import (
    as_bytes,
    cut,
    ordered_buckets,
    packed_texts,
    pieces,
    texts_of,
    words_of,
)

BITS = 128
RADIUS = 4
#: A word counts as rare in fewer than one of so many documents, or in fewer than leave more than
#: ``MOST_FREQUENT`` others. Rare words weigh alike; the weights of the others go to the tasks.
RARE = 1 << 12
MOST_FREQUENT = 1 << 20
#: Weights are whole numbers of such parts.
WEIGHT_UNIT = 1 << 16
#: Words whose counts a task holds before it passes them on.
HELD_WORDS = 1 << 18
#: Ranges of ids for each partition of texts.
RANGES = 4
SHAPE = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)


def term_hashes(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and 128 hash bits as -1 and 1."""
    raw = b"".join(xxhash.xxh128_digest(w) for w in as_bytes(distinct))
    both = np.frombuffer(raw, np.uint8).reshape(-1, 16)
    signs = np.unpackbits(both, axis=1).astype(np.float64) * 2 - 1
    return both[:, :8].copy().view("<u8")[:, 0], signs


@dataclass
class Weights:
    """Inverse document frequencies: of frequent words by their hash, in order, and of all others."""

    hashes: np.ndarray
    values: np.ndarray
    rare: float

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), self.rare)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.values[at], self.rare)


def term_counts(texts: pa.Array):
    """For each text its distinct word codes and their counts; the words."""
    words = words_of(texts)
    many = max(1, len(words.distinct))
    doc = np.repeat(np.arange(len(texts)), words.counts)
    pair, n = np.unique(doc * many + words.codes, return_counts=True)
    starts = np.searchsorted(pair, np.arange(len(texts) + 1) * many)
    return words, pair % many, n, starts


def term_weights(docs: DataFrame, rare: int = RARE, most: int = MOST_FREQUENT) -> Weights:
    """log(1 + documents / (1 + document frequency)) of every word, over all documents.

    Frequencies are counted exactly, by 64-bit hashes of words. A word in at most t documents counts
    as if it were in t, where t is a ``rare``-th of the documents, or as many as there are pairs of
    word and document for each of ``most`` words: so at most ``most`` words occur in more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, held, texts = [], [], 0, 0

        def given() -> pa.RecordBatch:
            own, at = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]), return_inverse=True)
            many = np.concatenate([*counts, np.zeros(0, np.int64)])
            n = np.zeros(len(own), np.int64)
            np.add.at(n, at, many)
            return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n)], ["hash", "n"])

        for piece in pieces(batches):
            words, code, _, _ = term_counts(piece.column("text"))
            seen = np.bincount(code, minlength=len(words.distinct))
            own, _ = term_hashes(words.distinct)
            hashes.append(own[seen > 0])
            counts.append(seen[seen > 0])
            held += len(hashes[-1])
            texts += len(piece)
            if held > HELD_WORDS:
                yield given()
                hashes, counts, held = [], [], 0
        yield given()
        every = [pa.array([None], pa.int64()), pa.array([texts])]
        yield pa.RecordBatch.from_arrays(every, ["hash", "n"])

    found = docs.select("text").mapInArrow(run, "hash long, n long")
    counted = cut(found.groupBy("hash").agg(F.sum("n").alias("n")))
    word = F.col("hash").isNotNull()
    texts, pairs = counted.agg(
        F.coalesce(F.sum(F.when(~word, F.col("n"))), F.lit(0)),
        F.coalesce(F.sum(F.when(word, F.col("n"))), F.lit(0)),
    ).first()
    least = max(texts / rare, pairs / most)
    frequent = counted.where(word & (F.col("n") > least)).toArrow()  # ``most`` rows at most
    hashes = frequent["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    values = np.log1p(texts / (1 + frequent["n"].to_numpy()[order]))
    return Weights(hashes[order], values, float(np.log1p(texts / (1 + least))))


def simhash(texts: pa.Array, weights: Weights) -> np.ndarray:
    """128 bits of each text as 16 bytes: where its words' weighted votes are above zero.

    A word votes by its hash bits, (1 + log count) times its weight. No words: all zero.
    """
    words, code, n, starts = term_counts(texts)
    out = np.zeros((len(texts), 16), np.uint8)
    if not len(code):
        return out
    hashes, signs = term_hashes(words.distinct)
    # Whole numbers, so that their sums are exact, and equal texts alike, in any order of the words.
    weight = np.rint((1 + np.log(n)) * weights.of(hashes)[code] * WEIGHT_UNIT)
    for d, (a, b) in enumerate(zip(starts, starts[1:])):
        votes = np.zeros(BITS, np.float64)
        for i in range(a, b, 1 << 14):  # long texts in parts
            j = min(b, i + (1 << 14))
            votes += weight[i:j] @ signs[code[i:j]]
        out[d] = np.packbits(votes > 0)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=-1) / BITS


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by as many first ones of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row and of its edited text, in ascending doc_id.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``
    (16 bytes each), ``near_edited``, ``near_next``. The next document of the last is the first; a
    single row is its own. Nulls in doc_id come first, equal ids are ordered by a hash of the text.
    Null texts are empty. Texts are dealt out once, by ranges of ids.
    """
    rows = texts_of(docs)
    weights = docs.sparkSession.sparkContext.broadcast(term_weights(rows))
    many = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A partition gets some ranges, so that they even out.
    dealt = rows.withColumn("bucket", ordered_buckets(rows, "doc_id", RANGES * many))
    # The first id of each range: its row also goes to the end of the range before.
    firsts = dealt.groupBy("bucket").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("first")
    )
    order = sorted((r.bucket, r.first.doc_id) for r in firsts.collect())  # a row for each range
    before = {first: order[i - 1][0] for i, (_, first) in enumerate(order)}
    sent = docs.sparkSession.sparkContext.broadcast(before)

    @F.arrow_udf("int")
    def range_before(ids: pa.Array) -> pa.Array:
        return pa.array([sent.value.get(i) for i in ids.to_pylist()], pa.int32())

    copies = F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("ahead")),
        F.struct(range_before("doc_id").alias("bucket"), F.lit(1).alias("ahead")),
    )
    packed = packed_texts(
        dealt.select("doc_id", F.xxhash64("text").alias("text_hash"), copies.alias("to"), "text")
    )
    sent_rows = packed.select("doc_id", "text_hash", "packed", F.explode("to").alias("to"))
    ranged = (
        sent_rows.where("to.bucket is not null")
        .select("to.bucket", "to.ahead", "doc_id", "text_hash", "packed")
        .repartition(many, "bucket")
        .sortWithinPartitions("bucket", "ahead", "doc_id", "text_hash")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(ids: list, texts: list[str]) -> pa.RecordBatch:
            """All but the last text, which follows the one before it."""
            own = simhash(pa.array(texts, pa.string()), weights.value)
            changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
            new = simhash(pa.array(changed, pa.string()), weights.value)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(t) for t in texts[:-1]], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                    pa.array([x.tobytes() for x in own[:-1]], pa.binary()),
                    pa.array([x.tobytes() for x in new], pa.binary()),
                    pa.array(likeness(own[:-1], new)),
                    pa.array(likeness(own[:-1], own[1:])),
                ],
                [field.split()[0] for field in SHAPE.split(", ")],
            )

        unpack = zstandard.ZstdDecompressor()
        ids, texts, held, over = [], [], 0, None
        for piece in pieces(batches, "packed"):
            columns = [piece.column(c).to_pylist() for c in ("bucket", "ahead", "doc_id", "packed")]
            for range_, is_ahead, doc_id, packed in zip(*columns):
                if range_ == over:
                    continue  # further rows with the id of the next range's first
                text = unpack.decompress(packed).decode()
                if is_ahead:
                    yield flush(ids, [*texts, text])
                    ids, texts, held, over = [], [], 0, range_
                    continue
                if held > 1 << 20:
                    yield flush(ids, [*texts, text])
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += len(text)

    return ranged.mapInArrow(run, SHAPE)


def halves(fingerprint: Column) -> list[Column]:
    """A fingerprint as two longs."""
    text = F.hex(fingerprint)
    parts = [F.conv(F.substring(text, i, 16), 16, -10).cast("long") for i in (1, 17)]
    return [parts[0], parts[1]]


def block_tables(radius: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, ...]]]:
    """Blocks (half, offset, width) and the sets of blocks that the tables are keyed by.

    Differences of ``radius`` bits leave two of ``radius + 2`` blocks untouched, so that two
    fingerprints within the radius agree in the key of some pair of blocks.
    """
    n = radius + 2
    blocks = []
    for half, count in ((0, n // 2), (1, n - n // 2)):
        cuts = [round(64 * i / count) for i in range(count + 1)]
        blocks += [(half, a, b - a) for a, b in zip(cuts, cuts[1:])]
    return blocks, list(itertools.combinations(range(n), 2))


def _block(halves_: list[Column], block: tuple[int, int, int]) -> Column:
    half, offset, width = block
    part = F.shiftrightunsigned(halves_[half], offset)
    return part.bitwiseAND(F.lit((1 << width) - 1).cast("long")) if width < 64 else part


def neighbours(queries: DataFrame, others: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs of fingerprints that differ in at most ``radius`` bits, each pair once.

    Both tables have distinct fingerprints as two longs, ``a`` and ``b``; columns of ``others``
    are kept. Gives ``qa``, ``qb`` and the columns of ``others``. Every fingerprint is entered in
    all block tables; those with equal keys are compared, and a pair counts in the first table
    that holds it.
    """
    blocks, tables = block_tables(radius)

    def keyed(frame: DataFrame) -> DataFrame:
        own = [F.col("a"), F.col("b")]
        keys = [
            F.struct(F.lit(t).alias("t"), F.xxhash64(F.lit(t), _block(own, blocks[i]), _block(own, blocks[j])).alias("key"))
            for t, (i, j) in enumerate(tables)
        ]
        return frame.select("*", F.explode(F.array(*keys)).alias("k")).select("*", "k.t", "k.key").drop("k")

    q = keyed(queries.select("a", "b")).select(
        F.col("a").alias("qa"), F.col("b").alias("qb"), F.col("t").alias("qt"), F.col("key").alias("qk")
    )
    o = keyed(others)
    apart = [F.col("qa").bitwiseXOR(F.col("a")), F.col("qb").bitwiseXOR(F.col("b"))]
    same = [_block(apart, block) == 0 for block in blocks]
    first = F.coalesce(*[F.when(same[i] & same[j], t) for t, (i, j) in enumerate(tables)])
    near = F.bit_count(apart[0]) + F.bit_count(apart[1]) <= radius
    joined = q.join(o, (F.col("qk") == F.col("key")) & (F.col("qt") == F.col("t")) & near & (first == F.col("t")))
    return joined.drop("qt", "qk", "t", "key")


def with_neighbour_counts(prints: DataFrame, every: int = 20, radius: int = RADIUS) -> DataFrame:
    """``prints`` with ``n_near``: how many other rows lie within the radius of the row.

    The rows whose doc_id is divisible by ``every`` are the queries; n_near of the others is null.
    """
    prints = cut(prints)
    a, b = halves(F.col("fingerprint"))
    asked = F.col("doc_id") % every == 0
    distinct = cut(
        prints.groupBy("fingerprint")
        .agg(F.count("*").alias("n"), F.max(F.coalesce(asked, F.lit(False))).alias("asked"))
        .select(a.alias("a"), b.alias("b"), "n", "asked")
    )
    found = neighbours(distinct.where("asked"), distinct.select("a", "b", "n"), radius)
    near = found.groupBy("qa", "qb").agg((F.sum("n") - 1).alias("n_near"))
    ask = F.coalesce(asked, F.lit(False))
    whole = prints.where(ask).select("*", a.alias("_a"), b.alias("_b"))
    counted = whole.join(near, (F.col("_a") == F.col("qa")) & (F.col("_b") == F.col("qb")), "left")
    rest = prints.where(~ask).select(*prints.columns, F.lit(None).cast("long").alias("n_near"))
    return counted.select(*prints.columns, "n_near").union(rest)
