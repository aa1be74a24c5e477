from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from odd_texts import words as random_words
from pyspark.sql import functions as F

from plumbline.llm.fingerprints import (
    Weights,
    block_tables,
    edited,
    fingerprints,
    halves,
    neighbours,
    term_weights,
    with_neighbour_counts,
)


def check(found, rows):
    """``rows`` are (doc_id, text); equal ids are ordered by a signed hash of the text."""

    def place(row):
        hashed = np.uint64(xxhash.xxh64_intdigest(row[1].encode(), 42)).astype(np.int64)
        return row[0] is not None, row[0] or 0, int(hashed)

    rows = sorted(rows, key=place)
    expected = []
    for i, (doc_id, text) in enumerate(rows):
        new = edited(text, rows[(i + 1) % len(rows)][1])
        expected.append(repr((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest())))
    assert sorted(repr((r.doc_id, r.n_chars, r.edited_sha256)) for r in found) == sorted(expected)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_edited_text_takes_the_next_document_s_beginning(spark, parts):
    rows = [(i * 7 % 101, f"text {i} " * (i % 5)) for i in range(101)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    check(found, rows)


def test_odd_rows(odd_docs, odd_rows):
    found = with_neighbour_counts(fingerprints(odd_docs)).collect()
    check(found, [(r[0], r[1] or "") for r in odd_rows])
    by_text = {}
    for r in found:
        by_text.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert by_text[1] == by_text[2]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_neighbours_are_all_found(spark):
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 256, (30, 16), dtype=np.uint8)
    rows = []
    for i in range(400):
        own = np.unpackbits(seeds[rng.integers(30)])
        own[rng.choice(128, rng.integers(0, 7), replace=False)] ^= 1
        rows.append(np.packbits(own))
    own = np.array(rows)
    frame = spark.createDataFrame([(i, own[i].tobytes()) for i in range(400)], "doc_id long, fingerprint binary")
    found = with_neighbour_counts(frame, every=5).collect()
    apart = np.bitwise_count(own[:, None] ^ own[None]).sum(axis=2)
    for r in found:
        near = int((apart[r.doc_id] <= 4).sum()) - 1
        assert r.n_near == (near if r.doc_id % 5 == 0 else None)
    a, b = halves(F.col("fingerprint"))
    distinct = frame.select(a.alias("a"), b.alias("b")).distinct()
    pairs = neighbours(distinct, distinct, radius=2)
    unlike = np.unique(own, axis=0)
    expected = int((np.bitwise_count(unlike[:, None] ^ unlike[None]).sum(axis=2) <= 2).sum())
    assert pairs.count() == expected


def test_blocks_cover_all_bits():
    blocks, tables = block_tables(4)
    assert sum(w for *_, w in blocks) == 128 and len(tables) == 15


def test_empty_table_and_single_row(spark, no_docs):
    assert with_neighbour_counts(fingerprints(no_docs)).count() == 0
    (row,) = fingerprints(spark.createDataFrame([(4, "abcd")], "doc_id long, text string")).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1


def plain_weights(texts, rare, most):
    own = [set(lowered_words(t)) for t in texts]
    df = Counter(w for ws in own for w in ws)
    least = max(len(texts) / rare, sum(df.values()) / most)
    return {w: math.log1p(len(texts) / (1 + max(n, least))) for w, n in df.items()}


def lowered_words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()


def plain_votes(text, weight):
    votes = [0.0] * 128
    for w, n in Counter(lowered_words(text)).items():
        digest = int.from_bytes(xxhash.xxh128_digest(w.encode()), "big")
        for i in range(128):
            votes[i] += (1 + math.log(n)) * weight[w] * (1 if digest >> (127 - i) & 1 else -1)
    return votes


def unlike_bits(votes, fingerprint):
    """Bits that differ, but for votes too close to zero to tell."""
    own = np.unpackbits(np.frombuffer(fingerprint, np.uint8))
    return sum((v > 0) != b for v, b in zip(votes, own) if abs(v) > 1e-2)


@pytest.mark.parametrize(("rare", "most"), [(1 << 12, 1 << 20), (8, 1 << 20), (1 << 12, 20)])
def test_all_columns_against_plain_python(spark, monkeypatch, rare, most):
    rng = random.Random(rare + most)
    rows = [(i, random_words(rng, rng.choice((0, 1, 20, 90)))) for i in range(200)]
    rows += [(200, rows[3][1]), (201, rows[3][1].upper() + " tail"), (202, "é É " * 50)]
    monkeypatch.setattr("plumbline.llm.fingerprints.HELD_WORDS", 500)
    own = lambda docs: term_weights(docs, rare, most)
    monkeypatch.setattr("plumbline.llm.fingerprints.term_weights", own)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    weight = plain_weights([t for _, t in rows], rare, most)
    found = {r.doc_id: r for r in fingerprints(frame).collect()}
    known = own(frame)
    assert len(known.hashes) <= most
    frequent = [w for w in weight if weight[w] < known.rare - 1e-6]
    assert len(known.hashes) == len(frequent)
    for i, (doc_id, text) in enumerate(rows):
        r, following = found[doc_id], rows[(i + 1) % len(rows)]
        changed = edited(text, following[1])
        assert unlike_bits(plain_votes(text, weight), r.fingerprint) == 0
        # Words of an edited text may be new; all such weigh as rare ones.
        weighed = weight | {w: known.rare for w in lowered_words(changed) if w not in weight}
        assert unlike_bits(plain_votes(changed, weighed), r.edited_fingerprint) == 0

        def alike(a, b):
            return 1 - (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count() / 128

        assert r.near_edited == alike(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == alike(r.fingerprint, found[following[0]].fingerprint)


def test_weights_by_hash():
    known = Weights(np.array([3, 9], np.uint64), np.array([1.0, 2.0]), 7.0)
    assert known.of(np.array([9, 1, 3, 2**63], np.uint64)).tolist() == [2.0, 7.0, 1.0, 7.0]
    none = Weights(np.zeros(0, np.uint64), np.zeros(0), 7.0)
    assert none.of(np.array([5], np.uint64)).tolist() == [7.0]


def test_only_asked_rows_are_joined(spark):
    frame = spark.createDataFrame([(i, bytes(16)) for i in range(40)], "doc_id long, fingerprint binary")
    found = with_neighbour_counts(frame)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "<=>" not in plan
    assert sorted((r.doc_id, r.n_near) for r in found.collect() if r.n_near is not None) == [(0, 39), (20, 39)]


def test_equal_texts_are_alike_wherever_they_stand(spark):
    """Votes of few words with equal weights cancel out; what is left must not depend on their order."""
    rng = random.Random(4)
    rows = [(i, random_words(rng, 8)) for i in range(300)]
    rows += [(1000 + i, t) for i, t in rng.sample(rows, 300)]
    found = fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    by_text = {}
    for r in found:
        by_text.setdefault(dict(rows)[r.doc_id], set()).add(bytes(r.fingerprint))
    assert all(len(x) == 1 for x in by_text.values())
    prints = {r.doc_id: r.fingerprint for r in found}
    ids = sorted(prints)
    for a, b in zip(ids, ids[1:]):
        apart = (int.from_bytes(prints[a], "big") ^ int.from_bytes(prints[b], "big")).bit_count()
        assert {r.near_next for r in found if r.doc_id == a} == {1 - apart / 128}
