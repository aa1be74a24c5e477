"""Token ids in files of directly addressable codes.

An id is cut into chunks of a fixed number of bits, lowest first. Level 0 holds the first chunk
of every token, level k the chunk k of those tokens that have one. A bitmap beside each level
marks the tokens that go on, and a rank directory counts the marks before every 512 bits, so that
the place of a token on the next level is one lookup and a few bit counts: any token can be read
without decoding others.

File layout, all numbers little-endian:
  8 bytes ``PLDAC001``; uint64 chunk_bits, levels, tokens, documents;
  doc_id int64 per document; null flag uint8 per document; first token uint64 per document + 1;
  per level: uint64 chunks; chunks; bitmap (8 bits a byte, lowest first); rank directory uint64.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut, open_folder, pieces, release_memory, texts_of, words_of

MAGIC = b"PLDAC001"
CHUNK_BITS = 8
BLOCK = 512
END_ID = 1
#: Tokens after which a task begins a new file.
FILE_TOKENS = 1 << 21
#: Distinct words whose ids a task keeps.
KEPT_WORDS = 700_000
#: Words that are encoded, and words whose ids are laid out, at a time.
ENCODED_WORDS = 1 << 12
SLICE_WORDS = 1 << 17
#: Words of tokenizers whose ids do not depend on what stands around a word (fixed value).
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_TAIL = "^(?P<core>.*[a-z])(?P<tail>[.,!#$%&*]+)$"
_TYPES = {8: np.dtype("<u1"), 16: np.dtype("<u2")}


# --- codes


def levels_of(ids: np.ndarray, bits: int = CHUNK_BITS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, bitmap bytes and rank directory of each level."""
    rest, out = ids.astype(np.uint32), []
    while len(rest) or not out:
        chunk = (rest & np.uint32((1 << bits) - 1)).astype(_TYPES[bits])
        rest = rest >> np.uint32(bits)
        more = rest > 0
        bitmap = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0)
        rank = np.concatenate(([0], np.cumsum(ones))).astype("<u8")
        out.append((chunk, bitmap, rank))
        rest = rest[more]
    return out


def file_bytes(doc_ids: list, starts: np.ndarray, ids: np.ndarray, bits: int = CHUNK_BITS) -> bytes:
    """One file: ``starts`` has the first token of each document, and the number of tokens."""
    parts = levels_of(ids, bits)
    out = [MAGIC, struct.pack("<4Q", bits, len(parts), len(ids), len(doc_ids))]
    out.append(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    out.append(np.array([d is None for d in doc_ids], np.uint8).tobytes())
    out.append(np.asarray(starts).astype("<u8").tobytes())
    for chunk, bitmap, rank in parts:
        out += [struct.pack("<Q", len(chunk)), chunk.tobytes(), bitmap.tobytes(), rank.tobytes()]
    return b"".join(out)


class TokenFile:
    """Random access to one file; only the asked ranges of it are read."""

    def __init__(self, source: pa.NativeFile):
        self._file = source
        head = source.read_at(40, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.bits, n, self.tokens, self.documents = struct.unpack("<4Q", head[8:])
        self._docs, at = 40, 40 + 17 * self.documents + 8
        self._levels = []
        for _ in range(n):
            (size,) = struct.unpack("<Q", source.read_at(8, at))
            chunks = at + 8
            bitmap = chunks + size * _TYPES[self.bits].itemsize
            rank = bitmap + (size + 7) // 8
            self._levels.append((chunks, bitmap, rank))
            at = rank + 8 * (1 + (size + BLOCK - 1) // BLOCK)

    def _array(self, kind: str | np.dtype, at: int, n: int) -> np.ndarray:
        kind = np.dtype(kind)
        return np.frombuffer(self._file.read_at(n * kind.itemsize, at), kind)

    def _bits(self, level: int, a: int, b: int) -> np.ndarray:
        raw = self._array("u1", self._levels[level][1] + a // 8, (b + 7) // 8 - a // 8)
        return np.unpackbits(raw, bitorder="little")[a % 8 : a % 8 + b - a]

    def _rank(self, level: int, i: int) -> int:
        """Marks before bit ``i``."""
        block = i // BLOCK
        (before,) = self._array("<u8", self._levels[level][2] + 8 * block, 1)
        return int(before) + int(self._bits(level, block * BLOCK, i).sum())

    def read(self, a: int, b: int) -> np.ndarray:
        """The ids of tokens a to b - 1."""
        if not 0 <= a <= b <= self.tokens:
            raise IndexError(f"tokens {a} to {b} of {self.tokens}")
        out = np.zeros(b - a, np.uint32)
        place, level = np.arange(b - a), 0
        while len(place):
            out[place] |= self._array(
                _TYPES[self.bits], self._levels[level][0] + a * _TYPES[self.bits].itemsize, b - a
            ).astype(np.uint32) << np.uint32(self.bits * level)
            more = self._bits(level, a, b).astype(bool)
            if not more.any():
                break
            a = self._rank(level, a)
            b, place, level = a + int(more.sum()), place[more], level + 1
        return out

    def token(self, i: int) -> int:
        return int(self.read(i, i + 1)[0])

    def index(self) -> tuple[list, np.ndarray]:
        """The documents' ids, and where their tokens begin and the last ones end."""
        ids = self._array("<i8", self._docs, self.documents)
        null = self._array("u1", self._docs + 8 * self.documents, self.documents)
        starts = self._array("<u8", self._docs + 9 * self.documents, self.documents + 1)
        return [None if z else int(i) for i, z in zip(ids, null)], starts.astype(np.int64)


# --- ids


def works_by_words(settings: dict) -> bool:
    """Are the ids of a text those of its lower-cased words, each apart from the punctuation at its
    end, whatever stands around them?

    Told from a tokenizer's file: it lower-cases, splits by ``_WORD_SPLIT`` before anything else and
    drops what lies between, and its own tokens begin with ``<|``, have no blank, and take none
    from around them.
    """

    def steps(part: dict | None, inner: str) -> list[dict]:
        return [] if part is None else part[inner] if part["type"] == "Sequence" else [part]

    normal = steps(settings.get("normalizer"), "normalizers")
    split = steps(settings.get("pre_tokenizer"), "pretokenizers")
    lowers = any(x["type"] == "Lowercase" for x in normal) and all(
        x["type"] in ("NFC", "Lowercase")
        or (x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " ")
        for x in normal
    )
    first = split[0] if split else {}
    splits = (
        first.get("type") == "Split"
        and first.get("pattern") == {"Regex": _WORD_SPLIT}
        and first.get("behavior") == "Removed"
        and first.get("invert") is True
        and all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in split[1:])
    )
    own = settings.get("added_tokens") or []
    apart = all(
        x["content"].startswith("<|")
        and not any(c.isspace() for c in x["content"])
        and not (x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"])
        for x in own
    )
    return lowers and splits and apart


class WordIds:
    """Ids of texts, by way of the ids of their distinct words where the tokenizer allows it, which
    ``works_by_words`` tells; other tokenizers encode whole texts."""

    def __init__(self, path: str, end_id: int | None = END_ID):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._by_words = works_by_words(json.loads(self._tokenizer.to_str()))
        self._end = [] if end_id is None else [end_id]
        self.clear()

    def clear(self) -> None:
        """Forgets all words."""
        self._known: dict[str, int] = {}
        self._pool, self._used, self._count = np.zeros(1 << 16, np.uint32), 0, 0
        self._at, self._len = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self._add([self._end, []])  # number 0 ends a document, number 1 is nothing

    def _add(self, lists: list[list[int]]) -> None:
        sizes = np.array([len(x) for x in lists], np.int64)
        used, count = self._used + int(sizes.sum()), self._count + len(lists)
        while used > len(self._pool):
            self._pool = np.concatenate((self._pool, np.zeros_like(self._pool)))
        while count > len(self._len):
            self._at = np.concatenate((self._at, np.zeros_like(self._at)))
            self._len = np.concatenate((self._len, np.zeros_like(self._len)))
        self._pool[self._used : used] = np.fromiter((i for x in lists for i in x), np.uint32)
        self._len[self._count : count] = sizes
        self._at[self._count : count] = self._used + np.cumsum(sizes) - sizes
        self._used, self._count = used, count

    def _numbers(self, names: pa.Array) -> np.ndarray:
        """The number of each name among those whose ids are kept; 1 for null."""
        coded = names.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self._known.get
        own = np.array([known(w, -1) for w in distinct], np.int64)
        missing = np.flatnonzero(own < 0)
        if len(missing):
            first, new = self._count, [distinct[i] for i in missing.tolist()]
            for i in range(0, len(new), ENCODED_WORDS):  # an encoding takes a kilobyte or so
                part = new[i : i + ENCODED_WORDS]
                found = self._tokenizer.encode_batch_fast(part, add_special_tokens=False)
                self._add([x.ids for x in found])
            self._known.update(zip(new, range(first, self._count)))
            own[missing] = np.arange(first, self._count)
        at = coded.indices.fill_null(len(distinct)).to_numpy(zero_copy_only=False)
        return np.append(own, 1)[at]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has, with the end id."""
        if not self._by_words:
            found = self._tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            own = [np.array(x.ids + self._end, np.uint32) for x in found]
            return np.concatenate([*own, np.zeros(0, np.uint32)]), np.array([len(x) for x in own])
        words = words_of(texts, lower=False)
        if len(self._known) > KEPT_WORDS:
            self.clear()
        # Special tokens are matched before letters are lower-cased.
        special = pc.match_substring(words.distinct, "<|")
        names = pc.if_else(special, words.distinct, pc.ascii_lower(words.distinct))
        parts = pc.extract_regex(names, _TAIL)
        core = pc.coalesce(pc.struct_field(parts, "core"), names)
        own = np.stack((self._numbers(core), self._numbers(pc.struct_field(parts, "tail"))), axis=1)
        flat, counts, first = [], [], 0
        while first < len(texts):  # documents of about SLICE_WORDS words at a time
            stop = np.searchsorted(words.starts, words.starts[first] + SLICE_WORDS, side="right") - 1
            stop = max(first + 1, int(stop))
            starts = words.starts[first : stop + 1]
            ids, n = self._expanded(own[words.codes[starts[0] : starts[-1]]], starts - starts[0])
            flat.append(ids)
            counts.append(n)
            first = stop
        return np.concatenate([*flat, np.zeros(0, np.uint32)]), np.concatenate([*counts, np.zeros(0, np.int64)])

    def _expanded(self, pairs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words given by the numbers of their two parts, with ends of documents."""
        codes = pairs.reshape(-1)
        kept = codes != 1
        at = np.concatenate(([0], np.cumsum(kept)))[2 * starts[1:]]
        codes = np.insert(codes[kept], at, 0)
        size = self._len[codes]
        ends = np.cumsum(size)
        place = np.repeat(self._at[codes] - (ends - size), size) + np.arange(int(size.sum()))
        last = ends[at + np.arange(len(at))]
        return self._pool[place], np.diff(last, prepend=0)


_ENCODERS: dict[tuple, WordIds] = {}


def encoder(*key) -> WordIds:
    """One encoder for all tasks of a worker."""
    if key not in _ENCODERS:
        _ENCODERS[key] = WordIds(*key)
    return _ENCODERS[key]


# --- files


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = END_ID,
    order: Sequence[Column] | None = None,
    chunk_bits: int = CHUNK_BITS,
    file_tokens: int = FILE_TOKENS,
    forget: bool = False,
) -> DataFrame:
    """Encodes whole texts and writes their ids in ascending ``order`` (default: doc_id); gives a
    row for each file.

    Columns: ``part``, ``file``, ``path``, ``documents``, ``tokens``, ``base`` (tokens of all files
    before it). Texts that are null or empty have the end id alone. Rows with a null order come
    first; equal ones are ordered by doc_id and text, and all are written. Files are renamed when
    whole, under names of the attempt's own: a task that runs twice, after one another or at the
    same time, writes files apart, and the rows name those of the attempt that counts. An empty
    table gives no row. With ``forget`` a worker keeps no words from one task to the next: less
    memory where idle workers add up, more work.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = [c.alias(f"place{i}") for i, c in enumerate(order or [F.col("doc_id").cast("long")])]
    names = [f"place{i}" for i in range(len(places))]
    rows = texts_of(docs, *places)
    dealt = rows.repartitionByRange(parts, *names).sortWithinPartitions(*names, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        store.create_dir(root, recursive=True)
        part, file, attempt = TaskContext.get().partitionId(), 0, uuid.uuid4().hex
        ids, sizes, chunks, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"tokens-{part:06d}-{file:06d}-{attempt}.dac"
            starts = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
            data = file_bytes(ids, starts, np.concatenate(chunks), chunk_bits)
            unfinished = f"{root}/.{name}"
            with store.open_output_stream(unfinished) as out:
                out.write(data)
            store.move(unfinished, f"{root}/{name}")
            return pa.RecordBatch.from_pylist(
                [{"part": part, "file": file, "path": f"{folder}/{name}", "documents": len(ids), "tokens": held}]
            )

        encode = encoder(tokenizer, end_id)
        for piece in pieces(batches, limit=1 << 22):
            flat, own = encode(piece.column("text"))
            ids += piece.column("doc_id").to_pylist()
            sizes.append(own)
            chunks.append(flat)
            held += len(flat)
            if held >= file_tokens:
                yield flush()
                ids, sizes, chunks, held, file = [], [], [], 0, file + 1
        if ids:
            yield flush()
        if forget:
            encode.clear()
        release_memory()

    shape = "part long, file long, path string, documents long, tokens long"
    files = cut(dealt.mapInArrow(run, shape))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # A row for each partition, in order; its files follow on what the partitions before it hold.
    total = files.groupBy("part").agg(F.sum("tokens").alias("own"))
    total = total.select("part", F.sum("own").over(before.orderBy("part")).alias("earlier"))
    within = F.sum("tokens").over(before.partitionBy("part").orderBy("file"))
    base = F.coalesce("earlier", F.lit(0)) + F.coalesce(within, F.lit(0))
    return files.join(total, "part").select(*files.columns, base.cast("long").alias("base"))


def file_order(docs: DataFrame) -> list[Column] | None:
    """The order in which a Parquet table's part files hold its rows; None for other tables."""
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    try:
        docs.select(name, row)
    except AnalysisException:
        return None
    part = F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long")
    return [part, name, row]


def read_tokens(files: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (place of its first token among all) and ``ids`` (uint32, little-endian
    bytes) of every document, read from the files by their indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(*(batch.column(c).to_pylist() for c in ("path", "base"))):
                store, path = open_folder(uri)
                with store.open_input_file(path) as source:
                    file = TokenFile(source)
                    ids, starts = file.index()
                    k = 0
                    while k < len(ids):
                        stop = max(k + 1, int(np.searchsorted(starts, starts[k] + (1 << 18), "right")) - 1)
                        raw = file.read(int(starts[k]), int(starts[stop])).astype("<u4").tobytes()
                        at = 4 * (starts[k : stop + 1] - starts[k])
                        own = [raw[a:b] for a, b in zip(at, at[1:])]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(ids[k:stop], pa.int64()),
                                pa.array(base + starts[k:stop]),
                                pa.array(own, pa.binary()),
                            ],
                            ["doc_id", "start", "ids"],
                        )
                        k = stop

    rows = files.select("path", "base")
    many = max(1, min(rows.count(), int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return rows.repartition(many).mapInArrow(run, "doc_id long, start long, ids binary")


def token_digests(tokens: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and the crc32 of each document's ids."""
    return tokens.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
