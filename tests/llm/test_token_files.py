from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from plumbline.llm import common
from plumbline.llm.common import shared_folder
from plumbline.llm.token_files import (
    TokenFile,
    WordIds,
    file_bytes,
    read_tokens,
    token_digests,
    works_by_words,
    write_tokens,
)

WORD = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", "a!!!b", "It's!! <|endoftext|>a.. <|ENDOFTEXT|> X", "Straße... É́!! İstanbul, ΣΑΣ. 'Tis ''s!",
    "\x1c\x1d a\x85b c.\xa0d", "<|startoftext|>!!,", "don't.", "Å! à, 5.3!! #a#", "  two\n\nlines  ",
    "Thorough, thorough; THOROUGH!!! 東京 🙂🙂",
]


@pytest.mark.parametrize("bits", [8, 16])
def test_any_token_is_read_without_the_others(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.choice([0, 1, 255, 256, 49_407, 65_535, 65_536, 2**31], n).astype(np.uint32)
        starts = np.array([0, n // 2, n // 2, n])
        raw = file_bytes([5, None, -2], starts, ids, bits)
        file = TokenFile(pa.BufferReader(raw))
        assert file.read(0, n).tolist() == ids.tolist()
        for a, b in rng.integers(0, n + 1, (50, 2)):
            assert file.read(min(a, b), max(a, b)).tolist() == ids[min(a, b) : max(a, b)].tolist()
        assert all(file.token(int(i)) == ids[i] for i in rng.integers(0, n, 50)) if n else True
        names, places = file.index()
        assert names == [5, None, -2] and places.tolist() == starts.tolist()
    with pytest.raises(IndexError):
        file.read(3, n + 1)
    with pytest.raises(ValueError):
        TokenFile(pa.BufferReader(b"x" * 99))


@pytest.mark.parametrize("file, by_words", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_the_tokenizer_tells_whether_words_stand_alone(file, by_words):
    settings = json.loads(Tokenizer.from_file(public_tokenizers.path(file)).to_str())
    assert works_by_words(settings) is by_words
    if by_words:
        for part, key, value in [
            (settings, "normalizer", None),
            (settings, "pre_tokenizer", {"type": "Whitespace"}),
            (settings["added_tokens"][0], "lstrip", True),
            (settings["added_tokens"][0], "content", "end"),
            (settings["pre_tokenizer"]["pretokenizers"][0], "invert", False),
        ]:
            before, part[key] = part[key], value
            assert not works_by_words(settings), key
            part[key] = before


def test_two_attempts_of_a_task_do_not_meet(spark, odd_docs):
    """The same rows written twice to one folder: each listing reads its own files."""
    folder = shared_folder(spark)
    first = write_tokens(odd_docs, folder, WORD, file_tokens=500)
    second = write_tokens(odd_docs.where("doc_id > 5"), folder, WORD, file_tokens=500)
    paths = [r.path for f in (first, second) for r in f.collect()]
    assert len(set(paths)) == len(paths)
    assert token_digests(read_tokens(first)).count() == odd_docs.count()
    assert token_digests(read_tokens(second)).count() == odd_docs.where("doc_id > 5").count()


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_tokenizer_s(file, odd_rows):
    path = public_tokenizers.path(file)
    texts = TEXTS + [r[1] or "" for r in odd_rows]
    flat, n = WordIds(path)(pa.array(texts))
    own = np.split(flat, np.cumsum(n)[:-1])
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in own] == [x.ids + [1] for x in whole]


def test_round_trip_in_ascending_order(spark, odd_docs, odd_rows):
    files = write_tokens(odd_docs, shared_folder(spark), WORD, file_tokens=500)
    found = token_digests(read_tokens(files)).collect()
    encode = Tokenizer.from_file(WORD)
    rows = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    at, expected = 0, []
    for doc_id, text, *_ in rows:
        ids = np.array(encode.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        expected.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    assert files.count() > 1


def test_empty_table(spark, no_docs):
    files = write_tokens(no_docs, shared_folder(spark), WORD)
    assert files.count() == 0 and read_tokens(files).count() == 0


def test_paths_of_spark_are_opened(tmp_path):
    for uri, path in [(str(tmp_path), str(tmp_path)), (f"file://{tmp_path}", str(tmp_path)), (f"file:{tmp_path}", str(tmp_path))]:
        store, found = common.open_folder(uri)
        assert found == path and store.type_name == "local"
    store, found = common.open_folder("s3a://bucket/some/folder?region=us-east-1")
    assert store.type_name == "s3" and found == "bucket/some/folder"
    with pytest.raises(ValueError, match="shared by driver"):
        common.open_folder("viewfs://x/y")
