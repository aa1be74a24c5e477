from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import lexical
from plumbline.llm.lexical import BallTree, Best, Items, Rows, ranked, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain(docs, items, top=10):
    own = [(i, terms(t)) for i, t in docs]
    many, total = sum(bool(t) for _, t in own), sum(len(t) for _, t in own)
    df = Counter(t for _, ts in own for t in set(ts))
    out = []
    for item, text in set(items):
        asked = Counter(terms(text))
        scores = []
        for doc, ts in own:
            tf, score = Counter(ts), 0
            m = 25 + (75 * len(ts) * many) // total if total else 25
            for t, c in asked.items():
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1)))
                    score += c * w * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (less, none, doc) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, None if none else doc, -less))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcé1", k=rng.randint(1, 4))) for _ in range(150)]
    docs = []
    for i in range(n):
        own = rng.choices(words[: rng.choice((20, 150))], k=rng.choice((1, 5, 40, 200)))
        docs.append((rng.randrange(-50, 10**6), rng.choice((" ", ", ", "-", "\t")).join(own).upper()))
    docs += rng.choices(docs, k=40)  # repeated rows: ties
    items = [(i, " ".join(rng.choices(words, k=rng.choice((1, 3, 30))))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("small", [True, False])
def test_as_brute_force(spark, monkeypatch, seed, small):
    if small:  # many trees, searches and blocks of items
        for name, value in [("TREE_ROWS", 32), ("LEAF_ROWS", 4), ("SEARCH_TERMS", 30), ("ITEM_CHARS", 300)]:
            monkeypatch.setattr(lexical, name, value)
        monkeypatch.setattr(lexical, "FLOOR_SHARE", 3)
    docs, items = corpus(seed)
    items += [(3, "other text of the same id"), (None, items[0][1]), items[1], (90, None), (91, ""), (92, "zzz")]
    got = ranked(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert rows_of(got) == plain(docs, items)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    docs = [(r[0], r[1]) for r in odd_rows]
    items = [(1, odd_rows[0][1]), (2, "er one"), (3, "Ünï 12 ñ"), (4, None)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x"))
    assert rows_of(ranked(odd_docs, bench)) == plain(docs, items)
    assert ranked(no_docs, bench).count() == 0
    assert ranked(odd_docs, bench.limit(0)).count() == 0


def test_very_long_texts(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices(["aa", "bb", "cc", f"d{i}"], k=n))) for i, n in enumerate([400_000, 9, 1])]
    items = [(1, "aa bb " * 100_000 + "d1"), (2, "d0")]
    got = ranked(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert rows_of(got) == plain(docs, items)


def random_rows(rng, n, width):
    size = rng.integers(1, 12, n)
    ends = np.concatenate(([0], np.cumsum(size)))
    at = np.concatenate([np.sort(rng.choice(width, k, replace=False)) for k in size])
    values = rng.integers(1, 2 * 10**10, len(at))
    return Rows(np.array(range(n), object), ends, at, values)


def test_no_inner_product_exceeds_its_bound():
    rng = np.random.default_rng(4)
    for n, width in [(1, 20), (17, 20), (500, 60)]:
        rows = random_rows(rng, n, width)
        tree = BallTree(rows, width, 8)
        under = {node: [leaf] for node, leaf in tree.leaves.items()}
        for node in sorted(tree.children, reverse=True):
            under[node] = [x for c in tree.children[node] for x in under[c]]
        assert sum(map(len, tree.leaves.values())) == n == sum(len(x) for x in under[0])
        for _ in range(20):
            columns = np.flatnonzero(rng.integers(0, 2, width))
            counts = rng.integers(1, 4, len(columns))
            query = np.zeros(width, np.int64)
            query[columns] = counts
            bounds = tree.bounds(columns, counts)
            for node, leaves in under.items():
                assert max(leaf.dot(query).max() for leaf in leaves) <= bounds[node]


def test_balls_are_pruned():
    """Documents in clusters: the search of an item opens few balls beyond its own."""
    rng = np.random.default_rng(6)
    clusters, each, width = 40, 50, 400
    at = np.concatenate(
        [np.sort(rng.choice(10, 6, replace=False)) + 10 * (i // each) for i in range(clusters * each)]
    )
    ends = np.arange(0, 6 * clusters * each + 1, 6)
    ids = np.arange(clusters * each).astype(object)
    rows = Rows(ids, ends, at, rng.integers(10**9, 2 * 10**9, len(at)))
    tree, best, scored = BallTree(rows, width), Best(clusters, None, 10), 0
    for j in range(clusters):
        columns, counts = np.arange(10 * j, 10 * j + 10), np.ones(10, np.int64)
        scored += search(tree, j, columns, counts, best)
        query = np.zeros(width, np.int64)
        query[columns] = 1
        expected = sorted(zip((-rows.dot(query)).tolist(), range(len(rows))))[:10]
        assert [(a, c) for a, _, c in best.found[j]] == expected
    assert scored < 0.1 * clusters * clusters * each


def test_items_are_packed():
    items = Items.of([(i, f"a{i} b{i} common") for i in range(600)] + [(9, " ")])
    groups = items.searches()
    assert [len(g) for g in groups] == [256, 256, 88] and len(items.terms) == 1201
