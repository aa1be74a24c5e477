from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from odd_texts import words

from plumbline.llm.repeats import blocks, repeated_windows, without_repeats


def plain(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone[:-1], [0])).astype(np.int8)))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), [tuple(map(int, x)) for x in edge.reshape(-1, 2)], kept))
    return out


def check(docs, rows, length, **options):
    found = without_repeats(docs, length, **options).collect()
    expected = [repr((r[0], *e)) for r, e in zip(rows, plain([r[1] for r in rows], length))]
    got = [repr((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept))) for r in found]
    assert sorted(got) == sorted(expected)
    assert all(r.n_removed == r.n_bytes - len(r.kept) for r in found)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("most_blocks", [1, 1 << 16])
def test_brute_force(spark, seed, most_blocks):
    rng = random.Random(seed)
    passages = [words(rng, rng.randint(3, 30)) for _ in range(6)] + ["ab" * 60, "é" * 40, "x"]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else words(rng, rng.randint(1, 8)) for _ in range(5)]
        text = rng.choice(["", " ", "\n"]).join(parts)
        rows.append((i, text[rng.randint(0, 5) :] if rng.random() < 0.9 else None))
    rows += rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs, rows, 24, gram=8, most_blocks=most_blocks, filter_bits=1 << 12)


def test_odd_rows(odd_docs, odd_rows):
    check(odd_docs, odd_rows, 200, filter_bits=1 << 16)


def test_many_repeated_rows(spark):
    rng = random.Random(2)
    shared, other = words(rng, 60), words(rng, 300)
    rows = [(1, other + shared)] * 1000 + [(None, shared * 3)] * 1000 + [(2, "x" + shared + "y")]
    rows += [(3, words(rng, 100)), (None, "short"), (None, "short"), (4, None), (4, None), (1, shared[:150])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = without_repeats(docs, filter_bits=1 << 12).collect()
    got = Counter((r.doc_id, r.n_bytes, tuple(tuple(s) for s in r.spans), bytes(r.kept)) for r in found)
    distinct = sorted(set(rows), key=str)
    twice = [r for r in distinct for _ in range(min(2, rows.count(r)))]  # two are as good as many
    expected = Counter()
    for row, (n, spans, kept) in zip(twice, plain([r[1] for r in twice], 200)):
        expected[(row[0], n, tuple(spans), kept)] = rows.count(row)
    assert got == expected


def test_windows_are_each_in_one_block_of_equal_minimizer():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    doc = np.repeat(np.arange(30, dtype=np.int32), 100)
    first, count, _, place = blocks(data, doc, 40, 8)
    inside = [i for f, n in zip(first, count) for i in range(f, f + n)]
    assert inside == [i for i in range(3000 - 39) if doc[i] == doc[i + 39]]
    assert all(f + n - 1 <= p <= f + 40 - 8 for f, n, p in zip(first, count, place))


def test_empty_table(no_docs):
    assert without_repeats(no_docs, filter_bits=1 << 12).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_windows_that_end_in_zeros(seed):
    rng, length, found = random.Random(seed), 12, {}
    for _ in range(40):
        a = rng.randint(0, 6)
        count = rng.randint(1, a + 1)
        before, after = (bytes(rng.choices(b"\0a", (9, 1), k=k)) for k in (a, length))
        found[(before + b"K" + after)[: count + length - 1]] = (a, count)
    strings = list(found)
    anchor, count = (np.array(x) for x in zip(*found.values()))
    got = repeated_windows(np.zeros(len(strings), np.int64), strings, anchor, count, length)
    at = [[(a - w, s[w : w + length]) for w in range(n)] for s, (a, n) in found.items()]
    seen = Counter(x for own in at for x in own)
    assert [[seen[x] > 1 for x in own] for own in at] == [g[:n].tolist() for g, n in zip(got, count)]


def test_texts_with_zeros(spark):
    rng = random.Random(1)
    parts = ["\0" * rng.randint(1, 30) + rng.choice("abc") * rng.randint(0, 3) for _ in range(200)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(6))) for i in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, 24, gram=8, filter_bits=1 << 12)


@pytest.mark.parametrize("most_blocks", [8, 64])
def test_one_passage_in_many_contexts(spark, most_blocks):
    rng = random.Random(5)
    passage = words(rng, 40)
    rows = [(i, words(rng, rng.randint(0, 6)) + passage[rng.randint(0, 3) :] + words(rng, 5)) for i in range(300)]
    rows += [(300 + i, passage[:60] + words(rng, 20)) for i in range(100)] + rows[:40]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(docs, rows, 48, gram=8, most_blocks=most_blocks, filter_bits=1 << 14)


def test_places_of_a_block_count():
    rng = random.Random(3)
    strings = [bytes(rng.choices(b"ab", k=20)) for _ in range(6)]
    times = np.array([1, 2, 1, 5, 1, 1])
    group, anchor, count = np.arange(6), np.full(6, 9), np.full(6, 9)
    found = repeated_windows(group, strings, anchor, count, 12, times)
    assert found.tolist() == [[bool(t > 1)] * 9 for t in times]
