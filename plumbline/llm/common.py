"""Helpers shared by the operators: the shared folder, batches of text, words, document order."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text that a task expands into arrays at a time; a longer document is a piece of its own.
PIECE_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """A fresh path in the folder that driver and executors share.

    The folder is ``spark.checkpoint.dir``. Where that is unset, a local master gets a temporary
    folder (one machine holds everything) and any other master an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="plumbline-")
    return f"{base.rstrip('/')}/plumbline-{uuid.uuid4().hex}"


#: Spark's names of schemes that pyarrow knows by another one.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path that Spark uses, and the path in it."""
    scheme, found, rest = uri.partition(":")
    if not found or "/" in scheme:
        return pafs.LocalFileSystem(), uri
    try:
        return pafs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    except (pa.ArrowInvalid, OSError) as error:
        raise ValueError(f"pyarrow cannot open {uri}, a folder shared by driver and executors: {error}") from error


def cut(frame: DataFrame) -> DataFrame:
    """The rows of ``frame``, computed once and kept in the shared checkpoint folder."""
    context = frame.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


def texts_of(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) of any table of documents, without its other columns."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of text; no row is cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def release_memory() -> None:
    """Gives memory that a task no longer uses back to the machine: its worker may idle for long."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has this
        ctypes.CDLL(None).malloc_trim(0)


def as_bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def packed_texts(rows: DataFrame) -> DataFrame:
    """The same rows with ``packed``, a zstd frame, for ``text``, so that a shuffle moves less."""
    kept = [f for f in rows.schema if f.name != "text"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for piece in pieces(batches):
            own = [squeeze.compress(t) for t in as_bytes(piece.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in names), pa.array(own, pa.binary())], [*names, "packed"]
            )

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("packed", T.BinaryType())]))


@dataclass
class Words:
    """Words of some documents: ``codes`` into ``distinct``; document i has starts[i]:starts[i+1]."""

    codes: np.ndarray
    distinct: pa.Array
    starts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash for each word, computed once for each distinct word."""
        each = xxhash.xxh64_intdigest
        own = np.fromiter(
            (each(w, seed) for w in as_bytes(self.distinct)), np.uint64, len(self.distinct)
        )
        return own[self.codes]


def words_of(texts: pa.Array, lower: bool = True) -> Words:
    """Runs of other than space, tab, line and page breaks; A-Z lower-cased if asked."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, starts = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    full = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0
    kept = full[codes] if len(codes) else np.zeros(0, bool)
    at = np.concatenate(([0], np.cumsum(kept)))
    return Words(codes[kept], coded.dictionary, at[starts])


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers stirred, so that close numbers become unlike."""
    h = h.astype(np.uint64)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(words: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words that stay in one document, and where each begins."""
    many = max(0, len(words) - n + 1)
    h = np.full(many, n, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + many]
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(words))  # words left in the text
    at = np.flatnonzero(left[:many] >= n)
    return mixed(h[at]), at


def ordered_buckets(frame: DataFrame, key: str, parts: int | None = None) -> Column:
    """A column that deals rows into ranges of the long ``key`` of about equal row counts.

    Only split points, one for each range, come to the driver. Nulls go to the first range.
    """
    spark = frame.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    found = frame.approxQuantile(key, shares, 0.25 / parts) if shares else []
    sent = spark.sparkContext.broadcast(np.array(sorted({int(c) for c in found}), np.int64))

    @F.arrow_udf("int")
    def bucket(keys: pa.Array) -> pa.Array:
        known = pc.fill_null(keys, np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(sent.value, known, side="right").astype(np.int32))

    return bucket(F.col(key))


def without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are not in ``bad`` (``doc_id``, ``text_hash``)."""
    named = bad.select(
        F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")
    ).distinct()
    text_hash = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(named["_bad_id"])
    return docs.join(named, same & (text_hash == named["_bad_hash"]), "left_anti")
