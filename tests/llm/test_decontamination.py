from __future__ import annotations

import random
import re

import numpy as np
import pytest
from odd_texts import words

from plumbline.llm.common import cut
from plumbline.llm.decontamination import (
    contained_items,
    filter_size,
    item_shingles,
    most_missing,
    partition_filters,
    partition_of,
    passes,
    signature_size,
    values_needed,
    without_items,
)


def split(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def plain(docs, items, n=5, threshold=0.8):
    out = set()
    for doc_id, text in docs:
        w = split(text)
        for item_id, item in items:
            v = split(item)
            m = min(n, len(v))
            if not m:
                continue
            parts = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)}
            runs = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)}
            if len(parts & runs) >= threshold * len(parts) - 1e-12:
                out.add((doc_id, item_id, len(parts), len(parts & runs)))
    return out


@pytest.fixture(scope="module")
def items(odd_rows):
    rng = random.Random(3)
    passages = [words(rng, n) for n in (1, 2, 4, 5, 6, 9, 17, 33, 60)]
    base = odd_rows[0][1].split()
    edited = [*base[10:22], "changed", *base[23:60]]
    return [(i, p) for i, p in enumerate(passages)] + [
        (50, " ".join(base[5:40])), (51, " ".join(edited)), (52, None), (53, ""), (54, "one"),
        (54, "ONE"), (55, "Er er ER er er er er"), (None, " ".join(base[:30])), (50, " ".join(base[5:40])),
    ]


@pytest.fixture(scope="module")
def docs(odd_rows, items):
    rng = random.Random(5)
    planted = []
    for i, (_, p) in enumerate(items[:9]):
        own = p.split()
        for j, cut in enumerate((0, 1, max(1, len(own) // 8))):
            planted.append((1000 + 10 * i + j, f"{words(rng, 30)} {' '.join(own[cut:])} {words(rng, 40)}"))
    return [(r[0], r[1]) for r in odd_rows] + planted


@pytest.mark.parametrize("filter_bits", [1 << 20, 64])
def test_brute_force(spark, docs, items, filter_bits):
    found = contained_items(
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item", "2 AS hash"),
        spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS signs"),
        filter_bits=filter_bits,
    ).collect()
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in found} == plain(docs, items)
    assert all(r.containment == r.n_shared / r.n_shingles >= 0.8 for r in found)


def test_documents_with_items_go(spark, odd_docs, odd_rows, items):
    kept = without_items(odd_docs, spark.createDataFrame(items, "item_id long, text string"))
    bad = {(d, t) for d, t in {(r[0], r[1]) for r in odd_rows} if plain([(d, t)], items)}
    expected = sorted(repr((r[0], r[1])) for r in odd_rows if (r[0], r[1]) not in bad)
    assert sorted(repr((r.doc_id, r.text)) for r in kept.collect()) == expected
    assert kept.columns == odd_docs.columns


def test_signature_is_long_enough():
    for size in range(1, 300):
        for threshold in (0.5, 0.8, 1.0):
            most_missing = max(m for m in range(size + 1) if size - m >= threshold * size - 1e-9)
            assert signature_size(size, threshold) > most_missing


def test_values_needed_are_those_a_containing_document_must_have():
    for size in range(1, 300):
        for threshold in (0.3, 0.5, 0.8, 1.0):
            kept = min(size, signature_size(size, threshold))
            need = values_needed(size, threshold)
            assert 1 <= need <= kept
            # All missing shingles may be in the signature, one more and the item is not contained.
            assert kept - need == most_missing(size, threshold)
            assert (size - most_missing(size, threshold)) / size >= threshold - 1e-9


def test_every_size_class_at_the_threshold(spark):
    """Items of many sizes, in documents that lack as many shingles as they may, and one more."""
    rng = random.Random(11)
    items, docs = [], []
    for i, size in enumerate((1, 2, 3, 4, 5, 7, 8, 15, 16, 20, 31, 32, 40, 63, 64, 100, 130)):
        own = [f"w{i}x{k}" for k in range(size + 4)]
        items.append((i, " ".join(own)))
        spare = most_missing(size, 0.8)
        for j in range(8):
            for more in (0, 1):
                first = rng.randrange(spare + more + 1)  # words cut in front, the others behind
                left = own[first : len(own) - (spare + more - first)]
                docs.append((len(docs), f"{words(rng, 20)} {' '.join(left)} {words(rng, 20)}"))
    docs.append((len(docs), " . ".join(text for _, text in items)))
    found = contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    expected = plain(docs, items)
    assert len(expected) == 9 * len(items)
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in found} == expected
    for r in found:
        assert values_needed(r.n_shingles, 0.8) / signature_size(r.n_shingles, 0.8) <= r.estimate <= 1
        assert (r.estimate == 1) >= (r.containment == 1)


def test_partitions_have_filters_of_their_own(spark, items):
    index = cut(item_shingles(spark.createDataFrame(items, "item_id long, text string"), 5, 0.8))
    signing = index.where("signs").collect()
    parts = {r.part for r in signing}
    assert partition_of(5, 1) in parts and partition_of(1, 1) in parts and len(parts) > 5
    filters = partition_filters(index.where("signs"), {p: 1 << 16 for p in parts})
    assert set(filters) == parts
    for p, table in filters.items():
        own = np.array([r.hash for r in signing if r.part == p]).view(np.uint64)
        others = np.array(list({r.hash for r in signing if r.part != p} - set(own.view(np.int64)))).view(np.uint64)
        assert len(passes(table, own)) == len(own)
        assert len(passes(table, others)) <= 1


def test_filters_are_as_large_as_their_values_need():
    assert [filter_size(n, 1 << 20) for n in (0, 1, 4, 100, 10**9)] == [64, 64, 128, 2048, 1 << 20]
    assert filter_size(10, 16) == 64


def test_empty_tables(spark, no_docs, odd_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contained_items(no_docs, some).count() == 0
    assert contained_items(odd_docs, none).count() == 0
    assert without_items(odd_docs, none).count() == odd_docs.count()
