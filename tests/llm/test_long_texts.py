"""One text of 20 MB beside short ones, through every operator that reads documents."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import (
    decontamination,
    fingerprints,
    language,
    lexical,
    licenses,
    mixing,
    near_duplicates,
    quality,
    repeats,
    spelling,
    token_files,
    toxicity,
)
from plumbline.llm.common import shared_folder
from plumbline.llm.queries import tokenizer_path

WORDS = 3_500_000


@pytest.fixture(scope="module")
def long_text():
    rng = np.random.default_rng(1)
    vocabulary = np.array(["".join(w) for w in rng.choice(list("abcdefgh"), (5000, 5))])
    own = vocabulary[rng.integers(0, 5000, WORDS)].tolist()
    own[1_000_000:1_000_002] = ["mit", "license"]
    own[3_400_000] = "unusualword"
    return " ".join(own)


@pytest.fixture(scope="module")
def docs(spark, long_text):
    assert len(long_text) > 20_000_000
    rows = [(1, long_text, "en", "a"), (2, long_text[-3000:], "en", "a"), (3, "unusualword here", "de", "b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame.write.parquet(path := f"{shared_folder(spark)}/long")
    return spark.read.parquet(path)


def test_fingerprints(docs, long_text):
    found = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    assert found[1].n_chars == len(long_text) and found[1].near_edited > 0.5


def test_learned(spark, docs):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    for own in (toxicity, quality):
        model = own.learn(docs, labels, F.lit(True))
        scored = own.toxicity(docs, model) if own is toxicity else own.quality(docs, model)
        assert scored.where("score between 0 and 1").count() == 3
    model = language.learn(docs, F.lit(True))
    found = {r.doc_id: r.lang_pred for r in language.languages(docs, model).collect()}
    assert found[1] == found[2] == "en"


def test_decontamination(spark, docs, long_text):
    items = spark.createDataFrame(
        [(1, long_text[19_000_000:19_000_300]), (2, "none of these words stand there")], "item_id long, text string"
    )
    found = decontamination.contained_items(docs, items)
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 1)]


def test_tokens(spark, docs, long_text):
    files = token_files.write_tokens(docs, shared_folder(spark), tokenizer_path())
    found = {r.doc_id: r for r in token_files.token_digests(token_files.read_tokens(files)).collect()}
    ids = Tokenizer.from_file(tokenizer_path()).encode(long_text, add_special_tokens=False).ids + [1]
    assert (found[1].n_tokens, found[1].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert found[2].start == len(ids)


def test_repeats(docs, long_text):
    found = {r.doc_id: r for r in repeats.without_repeats(docs).select("doc_id", "n_removed", "spans").collect()}
    assert found[2].n_removed == 3000 and found[1].n_removed == 3000
    assert [tuple(s) for s in found[1].spans] == [(len(long_text) - 3000, len(long_text))]


def test_mixing_and_near_duplicates(docs):
    assert sorted(r.position for r in mixing.mix(docs, columns=["doc_id"]).collect()) == [0, 1, 2]
    assert {r.component_id for r in near_duplicates.near_duplicates(docs).collect()} == {1, 2, 3}


def test_licenses(docs):
    (found,) = licenses.license_scan(docs).where("doc_id = 1").collect()
    assert (found.n_words, found.first_word, found.labels) == (WORDS, 1_000_000, "mit")


def test_spelling_and_search(spark, docs):
    found = {r.word: r.n for r in spelling.spelling_variants(docs).collect()}
    assert found == {"unusualword": 2}
    items = spark.createDataFrame([(7, "unusualword")], "item_id long, text string")
    assert [r.doc_id for r in lexical.ranked(docs, items).orderBy("rank").collect()] == [3, 1]
