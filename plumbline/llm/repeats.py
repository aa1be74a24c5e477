"""Removal of long repeated byte strings by backward extension on a Burrows-Wheeler transform.

A window of ``length`` bytes is repeated if the same bytes start anywhere else. Every window is
assigned to its minimizer, the ``gram`` bytes in it with the smallest hash (the first of equal
ones); neighbouring windows with the same minimizer make a block. Equal windows have equal
minimizers at equal places, so that windows need comparing only within a minimizer's blocks.
Minimizers of one block are dropped.

The different blocks of the other minimizers, each with the number of its places, are lined up at
the minimizer and sorted by what follows it: the rows of the minimizer's interval in the suffix
order. All intervals are then extended backwards together, one byte at a time, by a stable sort on
the preceding byte. The common prefix of neighbouring rows grows by one where the byte agrees, and
rows part for good where it differs; a row of several places is its own neighbour. A row is dropped
as soon as it cannot reach ``length`` any more, and a window is repeated when its common prefix
with a neighbour has reached ``length``.

Blocks of a minimizer with very many of them are cut at fixed distances from the minimizer and
grouped by all the bytes that the windows of a cut share; equal cuts become one. Groups that are
still large are cut into single windows. Equal windows meet all the same, and no task gets more
than a bounded group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import as_bytes, cut, packed_texts, pieces, texts_of
from plumbline.llm.decontamination import bloom, passes

LENGTH = 200
GRAM = 16
#: Bits of the filter of repeated minimizers that is sent to the tasks, at most, and for each of
#: them. A full filter costs shuffled rows, not results.
FILTER_BITS, BITS_EACH = 1 << 28, 16
#: Different blocks of one group that a task compares; larger groups are told apart by longer contexts.
MOST_BLOCKS = 1 << 14
#: Parts of a window's length that the windows of a cut may lie apart: first, and where that is too far.
#: After these, a cut is one window.
CUTS = (4, 16)
#: Parts in which cuts meet their results, as one cut may be part of very many blocks.
SALTS = 16
#: Bytes hashed at a time.
STRETCH = 1 << 18
_PLACE = np.uint64((1 << 20) - 1)


# --- minimizers


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of every ``w`` values in a row."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def blocks(data: np.ndarray, doc: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Blocks of windows that stay in one document: (first window, windows, minimizer, its place).

    Long inputs are read in stretches; a block that a stretch cuts becomes two.
    """
    out = []
    for start in range(0, max(0, len(data) - length + 1), STRETCH):
        part = data[start : start + STRETCH + length - 1]
        n, own = len(part) - length + 1, doc[start : start + STRETCH + length - 1]
        h = np.zeros(len(part) - gram + 1, np.uint64)
        for i in range(0, gram, 8):
            raw = part[i : i + len(h) + 7].tobytes()
            word = np.ndarray((len(h),), "<u8", raw, strides=(1,))
            h = (h ^ (h >> np.uint64(29)) ^ word) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
        least = sliding_least((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
        whole = own[:n] == own[length - 1 :]
        new = whole.copy()
        new[1:] &= (least[1:] != least[:-1]) | ~whole[:-1] | (own[1:n] != own[: n - 1])
        first = np.flatnonzero(new)
        stop = np.append(first[1:], n)
        inside = np.concatenate(([0], np.cumsum(whole)))
        count = inside[stop] - inside[first]
        place = (least[first] & _PLACE).astype(np.int64)
        out.append((first + start, count, least[first] & ~_PLACE, place + start))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none
    return tuple(np.concatenate(x) for x in zip(*out))


def _read(piece: pa.RecordBatch, length: int, gram: int):
    """The piece's bytes, the document of each block, its window in the document, and the blocks."""
    texts = as_bytes(piece.column("text"))
    raw = b"".join(texts)
    size = np.array([len(t) for t in texts])
    starts = np.cumsum(size) - size
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    first, count, value, place = blocks(np.frombuffer(raw, np.uint8), doc, length, gram)
    of = doc[first] if len(first) else np.zeros(0, np.int32)
    return raw, of, first - starts[of], first, count, value, place


# --- the transform


def _least_between(lcp: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The least of lcp[before + 1 .. after] for every pair."""
    out = lcp[after]
    far = np.flatnonzero(after > before + 1)
    if len(far):
        spans = np.stack((before[far] + 1, after[far] + 1), axis=1).reshape(-1)
        out[far] = np.minimum.reduceat(np.append(lcp, 0), spans)[::2]
    return out


def repeated_windows(
    group: np.ndarray,
    strings: list[bytes],
    anchor: np.ndarray,
    count: np.ndarray,
    length: int = LENGTH,
    times: np.ndarray | None = None,
) -> np.ndarray:
    """Which windows of each block are met again in its group, at the same place from the anchor.

    Blocks of a group differ. ``anchor`` is the place of the minimizer in the block, ``count`` the
    number of the block's windows, ``times`` that of the block's places (default: one). Gives a
    matrix (blocks, ``count.max()``).
    """
    n, widest = len(strings), int(count.max())
    right = np.array([len(s) for s in strings]) - anchor
    ahead = np.zeros((n, length), np.uint8)
    behind = np.zeros((n, int(anchor.max()) + 1), np.uint8)  # bytes before the anchor, backwards
    for i, (s, a) in enumerate(zip(strings, anchor.tolist())):
        row = np.frombuffer(s, np.uint8)
        ahead[i, : len(s) - a] = row[a : a + length]
        behind[i, :a] = row[:a][::-1]
    _, rank = np.unique(group, return_inverse=True)
    keyed = np.concatenate((rank.astype(">u4").view(np.uint8).reshape(n, 4), ahead), axis=1)
    # Of rows that differ only in how many zeros they end with, the shortest comes first.
    row = np.argsort(right, kind="stable")
    row = row[np.argsort(keyed[row].view(f"S{length + 4}")[:, 0], kind="stable")]
    # lcp[k]: common prefix of rows k - 1 and k; -1 where they have parted.
    apart = ahead[row[1:]] != ahead[row[:-1]]
    lcp = np.full(n, -1, np.int64)
    lcp[1:] = np.where(apart.any(axis=1), apart.argmax(axis=1), length)
    lcp[1:] = np.minimum(lcp[1:], np.minimum(right[row[1:]], right[row[:-1]]))
    lcp[1:][rank[row[1:]] != rank[row[:-1]]] = -1
    found = np.zeros((n, widest), bool)
    several = np.zeros(n, bool) if times is None else times > 1
    for d in range(int(anchor.max()) + 1):
        most = np.maximum(lcp, np.append(lcp[1:], -1))
        most = np.where(several[row], right[row] + d, most)
        window = anchor[row] - d
        hit = (most >= length) & (window >= 0) & (window < count[row])
        found[row[hit], window[hit]] = True
        # Only rows with a byte before them go on, and only if they may still reach the length.
        kept = np.flatnonzero((window > 0) & (most >= 0) & (most + window >= length))
        if not len(kept):
            break
        lcp = np.append(-1, _least_between(lcp, kept[:-1], kept[1:]))
        row = row[kept]
        group_of = np.cumsum(lcp < 0)
        key = group_of * 256 + behind[row, d]
        order = np.argsort(key, kind="stable")
        joined = np.append(-1, _least_between(lcp, *_ordered(order)))
        joined[1:] = np.where(key[order[1:]] == key[order[:-1]], joined[1:] + 1, -1)
        row, lcp = row[order], joined
    return found


def _ordered(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of the new order by their old places; those that changed sides have parted anyway."""
    return np.minimum(order[:-1], order[1:]), np.maximum(order[:-1], order[1:])


# --- the job


def _minimizers(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Minimizers of two blocks or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            value = _read(piece, length, gram)[5]
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64))], ["hash"])

    return rows.mapInArrow(run, "hash long").groupBy("hash").count().where("count > 1").select("hash")


def _occurrences(rows: DataFrame, minimizers: DataFrame, length: int, gram: int, bits: int) -> DataFrame:
    """Blocks of the minimizers, and some others: where they are, and 128 bits of their bytes."""
    known = rows.sparkSession.sparkContext.broadcast(_filter(minimizers, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            raw, of, at, first, count, value, place = _read(piece, length, gram)
            kept = passes(known.value, value)
            spans = zip(first[kept].tolist(), (first + count + length - 1)[kept].tolist())
            digest = xxhash.xxh3_128_digest
            own = np.frombuffer(b"".join(digest(raw[a:b]) for a, b in spans), "<i8").reshape(-1, 2)
            doc = pa.array(of[kept])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(value[kept].view(np.int64)),
                    pa.array(own[:, 0].copy()),
                    pa.array(own[:, 1].copy()),
                    piece.column("doc_id").take(doc),
                    piece.column("text_hash").take(doc),
                    pa.array(at[kept].astype(np.int64)),
                    pa.array(count[kept].astype(np.int32)),
                    pa.array((place - first)[kept].astype(np.int32)),
                ],
                ["hash", "h1", "h2", "doc_id", "text_hash", "at", "count", "anchor"],
            )

    return rows.mapInArrow(
        run,
        "hash long, h1 long, h2 long, doc_id long, text_hash long, at long, count int, anchor int",
    )


_BLOCK = "hash long, h1 long, h2 long, n long, count int, anchor int, bytes binary"


def _strings(blocks_: DataFrame, packed: DataFrame) -> DataFrame:
    """The bytes of blocks, cut out of their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for piece in pieces(batches, "packed"):
            out = []
            for text, own in zip(piece.column("packed").to_pylist(), piece.column("own").to_pylist()):
                text = unpack.decompress(text)
                out += [{**b, "bytes": text[b["at"] : b["at"] + b["size"]]} for b in own]
            yield pa.RecordBatch.from_pylist(
                [{k: v for k, v in b.items() if k not in ("at", "size")} for b in out],
                pa.schema(
                    [("hash", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int64()),
                     ("count", pa.int32()), ("anchor", pa.int32()), ("bytes", pa.binary())]
                ),
            )

    by_doc = blocks_.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.collect_list(F.struct("hash", "h1", "h2", "n", "count", "anchor", "at", "size")).alias("own")
    )  # a document's blocks: fewer than its bytes
    once = packed.join(
        by_doc,
        packed["doc_id"].eqNullSafe(by_doc["_id"]) & (packed["text_hash"] == by_doc["_hash"]),
    )
    return once.select("packed", "own").mapInArrow(run, _BLOCK)


_FOUND = "hash long, h1 long, h2 long, low int, high int"


def _compared(strings: DataFrame, length: int) -> DataFrame:
    """Ranges of repeated windows of blocks, by the transform of each minimizer's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(batch: pa.Table) -> pa.RecordBatch:
            group = batch["hash"].to_numpy()
            keys = [batch[c].to_numpy() for c in ("hash", "h1", "h2")]
            found = repeated_windows(
                group, batch["bytes"].to_pylist(), batch["anchor"].to_numpy().astype(np.int64),
                batch["count"].to_numpy().astype(np.int64), length, batch["n"].to_numpy(),
            )
            edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            row, low = np.nonzero(edge == 1)
            _, high = np.nonzero(edge == -1)
            return pa.RecordBatch.from_arrays(
                [pa.array(k[row]) for k in keys] + [pa.array(low, pa.int32()), pa.array(high, pa.int32())],
                ["hash", "h1", "h2", "low", "high"],
            )

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < 20_000:
                continue
            table = pa.Table.from_batches(held)
            own = table["hash"].to_numpy()
            whole = int(np.searchsorted(own, own[-1]))  # the last minimizer may go on
            if whole:
                yield compare(table.slice(0, whole))
            held = table.slice(whole).to_batches()
            size -= whole
        if size:
            yield compare(pa.Table.from_batches(held))

    dealt = strings.repartition("hash").sortWithinPartitions("hash", "h1", "h2")
    return dealt.mapInArrow(run, _FOUND)


def _cuts(strings: DataFrame, length: int, step: int) -> DataFrame:
    """Blocks cut at every ``step`` bytes from their minimizer, with where the cut is in the block.

    ``group`` is a digest of the bytes that all windows of a cut share, ``c1`` and ``c2`` of the cut's.
    Equal windows lie equally far from equal minimizers and so in cuts of the same group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.schema(
            [(c, pa.int64()) for c in ("group", "c1", "c2", "n", "hash", "h1", "h2")]
            + [("count", pa.int32()), ("anchor", pa.int32()), ("low", pa.int32()), ("bytes", pa.binary())]
        )
        for piece in pieces(batches, "bytes", 1 << 16):
            out = []
            for block in piece.to_pylist():
                text, anchor, low = block["bytes"], block["anchor"], 0
                while low < block["count"]:
                    part = (anchor - low) // step
                    first = anchor - part * step  # the last window that this part may have
                    stop = min(block["count"], first + 1)
                    shared, own = text[first : first + 1 - step + length], text[low : stop - 1 + length]
                    c1, c2 = np.frombuffer(xxhash.xxh3_128_digest(own), "<i8").tolist()
                    group = np.uint64(xxhash.xxh3_64_intdigest(shared, part)).view(np.int64)
                    out.append(
                        {**block, "group": int(group), "c1": c1, "c2": c2, "count": stop - low,
                         "anchor": anchor - low, "low": low, "bytes": own}
                    )
                    low = stop
            yield pa.RecordBatch.from_pylist(out, shape)

    return strings.mapInArrow(
        run,
        "group long, c1 long, c2 long, n long, hash long, h1 long, h2 long, count int, anchor int, "
        "low int, bytes binary",
    )


def _by_context(strings: DataFrame, length: int, steps: list[int], most: int, bits: int) -> DataFrame:
    """Ranges of repeated windows of blocks in groups too large for a task: their cuts are compared
    instead, in groups by all that the windows of a cut share. A cut of one window shares all of it."""
    cuts = cut(_cuts(strings, length, steps[0]))
    once = cuts.groupBy(F.col("group").alias("hash"), F.col("c1").alias("h1"), F.col("c2").alias("h2")).agg(
        F.sum("n").alias("n"), *(F.first(c).alias(c) for c in ("count", "anchor", "bytes"))
    )
    if len(steps) > 1:
        many = _many(once, most)
        if many.limit(1).count():
            wide = _among(many, bits)(F.col("hash"))
            found = _compared(once.where(~wide), length).union(
                _by_context(once.where(wide), length, steps[1:], most, bits)
            )
        else:
            found = _compared(once, length)
    else:
        found = _compared(once, length)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    found = found.select(
        F.col("hash").alias("group"), F.col("h1").alias("c1"), F.col("h2").alias("c2"),
        F.col("low").alias("from"), F.col("high").alias("to"), salts.alias("salt"),
    )
    parts = cuts.drop("bytes").withColumn("salt", F.pmod(F.xxhash64("hash", "h1"), F.lit(SALTS)).cast("int"))
    return parts.join(found, ["group", "c1", "c2", "salt"]).select(
        "hash", "h1", "h2", (F.col("low") + F.col("from")).alias("low"), (F.col("low") + F.col("to")).alias("high")
    )


def _many(blocks_: DataFrame, most: int) -> DataFrame:
    """Groups of more than ``most`` blocks."""
    return cut(blocks_.groupBy("hash").count().where(F.col("count") > most).select("hash"))


def _filter(hashes: DataFrame, most: int) -> np.ndarray:
    """A filter of the column ``hash``, as large as its rows need and ``most`` bits allow."""
    wanted = 1 << (BITS_EACH * hashes.count()).bit_length()
    return bloom(hashes, max(64, min(most, wanted)))


def _among(hashes: DataFrame, bits: int) -> Callable[[Column], Column]:
    """Tells of a column whether it may be in the column ``hash``, by a filter that goes to the tasks."""
    known = hashes.sparkSession.sparkContext.broadcast(_filter(hashes, bits))

    @F.arrow_udf("boolean")
    def may_be(values: pa.Array) -> pa.Array:
        h = values.to_numpy(zero_copy_only=False).view(np.uint64)
        out = np.zeros(len(h), bool)
        out[passes(known.value, h)] = True
        return pa.array(out)

    return may_be


def told_apart(docs: DataFrame, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``text`` and ``text_hash`` of all rows, those equal in id and text once; and, of rows that
    were not alone, ``doc_id``, ``text_hash`` and ``size``, the bytes of the text.

    Only ids and hashes are grouped. Where any repeat, a filter of them of fixed size tells the
    tasks which rows to group whole; a task sends one row of a kind, however many it reads.
    """
    rows = texts_of(docs).withColumn("text_hash", F.xxhash64("text"))
    size = F.octet_length("text").cast("long")
    copies = cut(
        rows.groupBy("doc_id", "text_hash")
        .agg(F.count("*").alias("n"), F.max(size).alias("size"))
        .where("n > 1")
        .drop("n")
    )
    if not copies.limit(1).count():
        return rows, copies
    key = F.xxhash64("doc_id", "text_hash")
    marked = rows.withColumn("may", _among(copies.select(key.alias("hash")), filter_bits)(key))
    once = marked.where("may").groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"))
    alone = marked.where("not may").select("doc_id", "text", "text_hash")
    return alone.union(once.select("doc_id", "text", "text_hash")), copies


def repeated_spans(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    filter_bits: int = FILTER_BITS,
    most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """``doc_id``, ``text_hash``, ``start``, ``stop``: bytes under repeated windows, which may
    overlap. Rows with equal doc_id and text have their spans given once: the whole text, if it
    has a window."""
    rows, copies = told_apart(docs, filter_bits)
    whole_texts = copies.where(F.col("size") >= length).select(
        "doc_id", "text_hash", F.lit(0).cast("long").alias("start"), F.col("size").alias("stop")
    )
    minimizers = cut(_minimizers(rows, length, gram))
    found = cut(_occurrences(rows, minimizers, length, gram, filter_bits))

    # Different blocks of a minimizer: one place and the number of places of each.
    block = ["hash", "h1", "h2"]
    place = ["doc_id", "text_hash", "at", "count", "anchor"]
    different = found.groupBy(*block).agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in place))
    different = cut(different.join(minimizers, "hash", "left_semi"))
    sized = different.withColumn("size", F.col("count") + length - 1)
    many = _many(different, most_blocks)
    if many.limit(1).count():
        wide = _among(many, filter_bits)(F.col("hash"))
        key = F.xxhash64("doc_id", "text_hash")
        holders = _among(cut(different.where(wide).select(key.alias("hash")).distinct()), filter_bits)
        strings = _strings(sized.where(wide), packed_texts(rows.where(holders(key))))
        steps = [*(max(2, length // c) for c in CUTS), 1]
        ranges = _compared(_strings(sized.where(~wide), packed_texts(rows)), length).union(
            _by_context(strings, length, steps, most_blocks, filter_bits)
        )
    else:
        ranges = _compared(_strings(sized, packed_texts(rows)), length)
    spans = found.join(ranges, block).select(
        "doc_id",
        "text_hash",
        (F.col("at") + F.col("low")).alias("start"),
        (F.col("at") + F.col("high") + length - 1).alias("stop"),
    )
    return spans.union(whole_texts)


def without_repeats(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """Every row's text without the bytes that a repeated string of ``length`` bytes covers.

    Columns: ``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` (maximal removed runs, start and
    stop), ``kept`` (the remaining bytes, which may cut a character). Strings are judged on the
    input; overlapping ones count, within a document too, and none crosses documents. Null texts
    are empty; texts shorter than ``length`` stay whole. Repeated rows are texts of their own and
    remove each other. Other columns are ignored.
    """
    rows = texts_of(docs).withColumn("text_hash", F.xxhash64("text"))
    spans = repeated_spans(docs, length, **options)
    own = spans.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.collect_list(F.struct("start", "stop")).alias("own")
    )  # a document's spans: fewer than its bytes
    packed = packed_texts(rows)
    joined = packed.join(
        own, packed["doc_id"].eqNullSafe(own["_id"]) & (packed["text_hash"] == own["_hash"]), "left"
    ).select("doc_id", "packed", "own")
    shape = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
         ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
         ("kept", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for piece in pieces(batches, "packed"):
            out = []
            for doc_id, text, own in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "packed", "own"))):
                text = unpack.decompress(text)
                merged: list[dict] = []
                for a, b in sorted((s["start"], s["stop"]) for s in own or ()):
                    if merged and a <= merged[-1]["stop"]:
                        merged[-1]["stop"] = max(b, merged[-1]["stop"])
                    else:
                        merged.append({"start": a, "stop": b})
                edges = [0, *(x for s in merged for x in (s["start"], s["stop"])), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append(
                    {"doc_id": doc_id, "n_bytes": len(text), "n_removed": len(text) - len(kept),
                     "spans": merged, "kept": kept}
                )
            yield pa.RecordBatch.from_pylist(out, shape)

    return joined.mapInArrow(
        run,
        "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, "
        "kept binary",
    )
