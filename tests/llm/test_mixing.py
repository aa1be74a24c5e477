from __future__ import annotations

import random
from fractions import Fraction

import pytest

from plumbline.llm.mixing import mix, schedule


@pytest.mark.parametrize("seed", range(6))
def test_schedule_places_every_block_once(seed):
    rng = random.Random(seed)
    rows = {s: rng.randint(1, 400) for s in "abcde"}
    weights = {s: rng.random() + 0.01 for s in rows}
    slots = []
    for s, stretches in schedule(rows, weights, 4, 32).items():
        assert [x.first for x in stretches[1:]] == [x.stop for x in stretches[:-1]]
        for x in stretches:
            for i in range(x.stop - x.first):
                turn, at = divmod(i, len(x.places))
                slots.append(x.slot + turn * x.period + int(x.places[at]))
    assert sorted(slots) == list(range(sum(-(-n // 4) for n in rows.values())))


def test_rows_are_all_placed_and_follow_their_targets(spark):
    rows = [(i, "t", "ab"[i % 3 == 0] if i % 5 else "c") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix(docs, {"a": 3.0, "b": 2.0, "c": 1.0}, block=4, period=60).orderBy("position").collect()
    assert [r.position for r in found] == list(range(1500))
    for s in "abc":
        own = [r.doc_id for r in found if r.source == s]
        assert own == sorted(own) and [r.block for r in found if r.source == s] == [i // 4 for i in range(len(own))]
    order = list(dict.fromkeys((r.slot, r.source) for r in found))
    left = {s: sum(r[2] == s for r in rows) for s in "abc"}
    done = dict.fromkeys("abc", 0)
    for n, (_, s) in enumerate(order, 1):
        done[s] += 1
        assert all(abs(done[t] - n * w / 6) < 1 for t, w in (("a", 3), ("b", 2), ("c", 1)))
        if done[s] * 4 >= left[s]:
            break


def test_odd_rows(odd_docs, odd_rows, no_docs):
    found = mix(odd_docs, block=2, period=16).collect()
    assert sorted(r.position for r in found) == list(range(len(odd_rows)))
    assert sorted(repr((r.doc_id, r.text, r.source)) for r in found) == sorted(repr((r[0], r[1], r[3])) for r in odd_rows)
    assert mix(no_docs).count() == 0
    named = mix(odd_docs, names=("_b", "_s", "_p"))
    assert named.columns == [*odd_docs.columns, "_b", "_s", "_p"]


def test_very_many_sources(spark):
    """More than the 10,000 that were once the most: every row placed, big sources on target."""
    n = 12_000
    docs = spark.range(2 * n + 8000).selectExpr(
        "id AS doc_id", "'t' AS text", f"CASE WHEN id < {2 * n} THEN concat('s', id % {n}) ELSE 'big' END AS source"
    )
    weights = {f"s{i}": 1.0 for i in range(n)} | {"big": 4000.0}
    found = mix(docs, weights, block=1).select("position", "slot", "source").orderBy("slot").collect()
    assert [r.position for r in found] == list(range(2 * n + 8000))
    done = 0
    for k, r in enumerate(found, 1):
        done += r.source == "big"
        assert abs(done - k * 0.25) < 1


def furthest(order, blocks, weights):
    """The most blocks that any source is off its exact target, after any slot."""
    target, done, most = {s: Fraction(0) for s in blocks}, dict.fromkeys(blocks, 0), Fraction(0)
    for s in order:
        left = Fraction(1)
        while left:
            own = {t: Fraction(weights[t]) for t in blocks if target[t] < blocks[t]}
            total = sum(own.values())
            step = min([left, *((blocks[t] - target[t]) * total / w for t, w in own.items())])
            for t, w in own.items():
                target[t] += step * w / total
            left -= step
        done[s] += 1
        most = max(most, *(abs(done[t] - target[t]) for t in blocks))
    return most


def order_of(found):
    """The source of each slot, of what schedule() gives."""
    at = {}
    for s, own in found.items():
        for x in own:
            for i in range(x.stop - x.first):
                turn, place = divmod(i, len(x.places))
                at[x.slot + turn * x.period + int(x.places[place])] = s
    return [at[i] for i in range(len(at))]


@pytest.mark.parametrize("seed", range(8))
def test_sources_keep_to_exact_targets_over_segments_and_phases(seed):
    rng = random.Random(seed)
    blocks = {f"s{i}": rng.randint(1, 80) for i in range(rng.randint(2, 12))}
    weights = {s: rng.random() ** 3 + 1e-6 if seed % 2 else float(rng.randint(1, 9)) for s in blocks}
    order = order_of(schedule(blocks, weights, 1, 16))
    assert {s: order.count(s) for s in blocks} == blocks and furthest(order, blocks, weights) < 1


def test_many_tiny_shares_take_nothing_from_the_large():
    blocks = {"a": 600, "b": 400} | {f"t{i}": 2 for i in range(60)}
    weights = {"a": 6000.0, "b": 4000.0} | {f"t{i}": 1.6 for i in range(60)}
    assert furthest(order_of(schedule(blocks, weights, 1, 240)), blocks, weights) < 1


def test_rounding_does_not_add_up():
    blocks, weights = {"a": 40_000, "b": 20_000}, {"a": 1 / 3 + 1e-3, "b": 2 / 3 - 1e-3}
    done, share = 0, Fraction(weights["a"]) / (Fraction(weights["a"]) + Fraction(weights["b"]))
    for n, s in enumerate(order_of(schedule(blocks, weights, 1, 64))[:29_000], 1):
        done += s == "a"
        assert abs(done - n * share) < 1


def test_positions_after_short_blocks(spark):
    sizes = {"a": 37, "b": 5, "c": 11, None: 3}
    rows = [(i, "t", s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix(docs, block=4, period=4).orderBy("slot", "doc_id").collect()
    assert [r.position for r in found] == list(range(len(rows)))
    assert len({r.slot for r in found}) == sum(-(-n // 4) for n in sizes.values())
