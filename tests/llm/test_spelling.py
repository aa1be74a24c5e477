from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plumbline.llm.spelling import spelling_variants, trie_paths, word_counts


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    counts = plain_counts(rows)
    out = {}
    for w, n in counts.items():
        own = [o for o in counts if near(w, o)]
        best = min(own, key=lambda o: (-counts[o], o), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        out[w] = [form, None, n, len(own), counts.get(form)]
    for w in out:
        end = w
        while out[end][0] is not None:
            end = out[end][0]
        out[w][1] = end
    return sorted((w, *map(str, v)) for w, v in out.items())


def as_rows(frame):
    return sorted(
        (r["word"], *(str(r[c]) for c in ("form", "root", "n", "n_near", "form_n")))
        for r in frame.collect()
    )


def corpus(seed):
    rng = random.Random(seed)
    letters = "abABéÉ"
    base = ["".join(rng.choices("abé", k=rng.randint(7, 9))) for _ in range(60)]
    rows = []
    for i in range(400):
        own = []
        for _ in range(12):
            w = rng.choice(base[: rng.choice((3, 20, 60))])
            for _ in range(rng.choice((0, 0, 0, 1, 2))):
                at = rng.randrange(len(w))
                w = rng.choice(
                    (w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + "b" + w[at + 1 :])
                )
            own.append(w)
        rows.append((i, rng.choice((" ", "-", "1", "ā")).join(own)))
    chain = ["aaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb"]  # 2, 20, 200 and 2000 times
    return rows + [(1000 + i, " ".join([w] * (2 * 10**i))) for i, w in enumerate(chain)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("parts", [1, 7])
def test_as_brute_force(spark, seed, parts):
    rows = corpus(seed) + [(None, "Repeated repeated"), (5, None), (6, ""), (7, "short 1234567 ×÷")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        got = as_rows(spelling_variants(frame))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = plain(rows)
    assert got == expected
    assert len({r[0] for r in expected}) > 150 and any(r[1] != r[2] != r[0] for r in expected if r[1] != "None")


def test_trie_nodes_are_numbered_alike_everywhere(spark):
    rng = random.Random(3)
    own = sorted({"".join(rng.choices("ab", k=rng.randint(1, 12))) for _ in range(700)})
    frame = spark.createDataFrame([(w,) for w in own], "word string")
    rows = trie_paths(frame.repartition(5), "word").collect()
    assert [r["word"] for r in sorted(rows, key=lambda r: r["place"])] == own
    node, prefix = {}, {}
    for r in rows:
        assert len(r["path"]) == len(r["word"]) + 1
        for i, number in enumerate(r["path"]):
            assert node.setdefault(r["word"][:i], number) == number
            assert prefix.setdefault(number, r["word"][:i]) == r["word"][:i]


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    doubled = odd_docs.union(odd_docs)
    got = as_rows(spelling_variants(doubled))
    assert got == plain([(r[0], r[1]) for r in odd_rows] * 2)
    assert spelling_variants(no_docs).count() == 0 and word_counts(no_docs).count() == 0


def test_very_long_words(spark):
    long = "ab" * 20_000
    rows = [(1, long), (2, long), (3, long[:-1] + "c"), (4, long[:-1] + "c")] + [(5, long + " " + long)] * 20
    got = as_rows(spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain(rows)
    frame = spark.createDataFrame([(1, "eleven eleventh")] * 9, "doc_id long, text string")
    assert [r["n"] for r in spelling_variants(frame).collect()] == [9]
    assert spelling_variants(frame.withColumn("text", F.lit(None).cast("string"))).count() == 0
