from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from plumbline.llm.components import components
from plumbline.llm.near_duplicates import keep_one, links, near_duplicates, segments, simhash


def plain(text, words=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", lower)
    runs = [" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))] if own else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(nodes, near):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = sorted(nodes)
    for i, x in enumerate(nodes):
        for y in nodes[i + 1 :]:
            if near(x, y):
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def bits(x, y):
    return bin((x ^ y) & (2**64 - 1)).count("1")


@pytest.mark.parametrize("text", ["", None, " ", "One", "a b c d", "A B c\td e\nF g", "é È x y z w " * 9])
def test_simhash_is_the_contract_s(text):
    assert simhash((text or "").encode()) == plain(text)


def test_one_segment_differs_by_one_bit_at_most():
    assert [w for _, w in segments(4)] == [21, 22, 21]
    assert sum(w for _, w in segments(7)) == 64 and len(segments(7)) == 4 and len(segments(1)) == 1


@pytest.mark.parametrize("cell", [4, 1 << 14])
@pytest.mark.parametrize("most", [1, 4, 5])
def test_links_connect_all_within_the_radius(spark, cell, most):
    rng = random.Random(most)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    own = set(seeds)
    for s in seeds:
        for _ in range(10):
            own.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
    hot = rng.getrandbits(64)  # many with one signature
    own |= {hot ^ sum(1 << b for b in rng.sample(range(10), 3)) for _ in range(40)}
    signed = [int(np.uint64(x).astype(np.int64)) for x in own]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = links(frame, most, cell)
    assert all(bits(r.a, r.b) <= most for r in found.collect())
    roots = {r.node: r.root for r in components(found, "a", "b").collect()}
    expected = classes(signed, lambda x, y: bits(x, y) <= most)
    assert {x: roots.get(x, x) for x in signed} == expected


def test_components_of_a_long_chain(spark):
    n = 200
    edges = [(i, i + 1) for i in range(n)] + [(500, 500), (None, 3), (900, 800)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in found} == {**{i: 0 for i in range(n + 1)}, 900: 800, 800: 800}


@pytest.mark.parametrize("hub", [-1, 1500, 3001])
def test_components_around_a_hub(spark, hub):
    """A node with thousands of neighbours, of the least, a middle or the greatest number."""
    edges = [(hub, v) for v in range(3000) if v != hub] + [(10_000, 10_001), (2999, 5000), (7, 7), (None, 3)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    least = min(hub, 0)
    expected = {v: least for v in (*range(3000), hub, 5000)} | {10_000: 10_000, 10_001: 10_000}
    assert {r.node: r.root for r in found} == expected
    assert len(found) == len(expected)


def test_odd_rows(odd_docs, odd_rows):
    found = near_duplicates(odd_docs).collect()
    prints = {plain(r[1]) for r in odd_rows}
    roots = classes(prints, lambda x, y: bits(x, y) <= 4)
    least = {}
    for r in odd_rows:
        root = roots[plain(r[1])]
        least[root] = min((x for x in (least.get(root), r[0]) if x is not None), default=None)
    expected = sorted(repr((r[0], plain(r[1]), least[roots[plain(r[1])]])) for r in odd_rows)
    got = sorted(repr((r.doc_id, r.fp & (2**64 - 1), r.component_id)) for r in found)
    assert got == expected
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    own = [roots[plain(r.text)] for r in rows]
    assert sorted(own) == sorted(set(roots.values()))
    assert all(r.doc_id == least[root] for r, root in zip(rows, own))


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).count() == 0 and keep_one(no_docs).count() == 0
