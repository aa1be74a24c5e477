from __future__ import annotations

import re

import pytest

from plumbline.llm import licenses
from plumbline.llm.license_rules import REACH, RULES, signature, signatures
from plumbline.llm.licenses import STRENGTH, detections, license_scan

UPPER = re.compile(r"[A-Z]")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_in(text):
    return WORDS.findall(UPPER.sub(lambda m: m[0].lower(), text or ""))


def plain_detections(text, rules):
    """Every rule at every place of the whole text, without keywords, windows or joins."""
    own = words_in(text)
    found = set()
    for r in rules:
        lead, tail = re.compile(r.lead.replace(r"\z", r"\Z")), re.compile(r.tail)
        for i, w in enumerate(own):
            if w != r.keyword:
                continue
            before = "".join(f" {x}" for x in own[:i]) + " "
            after = " " + "".join(f"{x} " for x in own[i + 1 :])
            a, b = lead.search(before), tail.match(after)
            if a and b:
                start, stop = i - a[0].count(" ") + 1, i + b[0].count(" ")
                found.add((start, stop, r.rule, r.label, r.priority, r.base))
    out = []
    for m in found:
        covered = any(
            o[0] <= m[0]
            and o[1] >= m[1]
            and o[4] >= m[4]
            and (o[:2] != m[:2] or (-o[4], o[2]) < (-m[4], m[2]))
            for o in found
            if o is not m
        )
        out.append((*m, not covered))
    return sorted(out)


TEXTS = [
    "Licensed under the Apache License, Version 2.0 and the MIT license; mit license mit LICENSE!",
    "under the GNU Lesser General Public License version 2.1 or the GNU General Public License, version 3",
    "gnu library general public license general public license as published by the free software foundation",
    "SPDX-License-Identifier: GPL-2.0-or-later SPDX-License-Identifier: Frob-1",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and so on",
    "Mitlicense mit licenses MİT license mit license mit licenseé Åmit licenſe, summit license",
    "CC BY-NC-SA 4.0, CC BY 4.0, cc by, http://creativecommons.org/licenses/by-nc/4.0/",
    "license license apache license apache licensed general public license",
    "mit", "license", "", None, "éè license İ apache license",
    "all rights reserved. This is free and unencumbered software released into the public domain",
    "BSD 3-Clause License; the new BSD license; freebsd license; bsd style license; zero clause bsd license",
]


def test_rules_are_many_and_stay_in_reach():
    rules = signatures()
    assert len(rules) > 250 and len({r.label for r in rules}) > 90
    assert {r.priority for r in rules} == set(STRENGTH)
    for bad in ["x | 1 | no keyword", "x | 1 | (?:a )+<b>", "x | 1 | .* <b>", "x | 1 | <b>" + " a" * (REACH + 1)]:
        with pytest.raises(ValueError):
            signature(0, bad)


def test_every_rule_finds_its_own_words(spark):
    """Each pattern, with its options taken and alternatives resolved, is found as itself or covered."""
    rules = [r for r in signatures() if not r.base]
    lines = RULES.strip().splitlines()
    rows = []
    for r, line in zip(rules, lines, strict=True):
        sample = re.sub(r"[<>]", "", line.split("|", 2)[2].strip())
        sample = re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", sample)
        sample = re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", sample)
        sample = re.sub(r"\[a-z0-9\]\+", "frob", sample)
        sample = re.sub(r"\[([0-9a-z])[^\]]*\]\??", r"\1", sample).replace(" ?", " ")
        rows.append((r.rule, "some words " + re.sub(r"(\w)\?", r"\1", sample) + " more words"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(x["doc_id"], x["rule"]) for x in detections(frame).collect()}
    assert [r for r, _ in rows if (r, r) not in found] == []


def test_as_brute_force(spark, odd_docs, odd_rows):
    rules = signatures()
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {}
    for x in detections(frame).drop("text_hash").collect():
        got.setdefault(x["doc_id"], []).append(tuple(x)[1:])
    for i, text in enumerate(TEXTS):
        assert sorted(got.get(i, [])) == plain_detections(text, rules), text
    scanned = {x["doc_id"]: x for x in license_scan(frame).collect()}
    assert len(scanned) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        found = plain_detections(text, rules)
        base = [m for m in found if m[5]]
        x = scanned[i]
        assert x["n_words"] == len(words_in(text)) and x["n_base"] == len(base)
        assert x["first_word"] == min((m[0] for m in base), default=None)
        assert x["last_word"] == max((m[0] for m in base), default=None)
        assert x["base_labels"] == ",".join(sorted({m[3] for m in base}))
        assert x["labels"] == ",".join(sorted({m[3] for m in found if m[5] or m[6]}))
        assert x["score"] == max((STRENGTH[m[4]] for m in found if m[6]), default=0.0)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = license_scan(odd_docs).select("doc_id", "n_words", "labels").collect()
    assert len(got) == len(odd_rows)
    expected = sorted((str(r[0]), len(words_in(r[1]))) for r in odd_rows)
    assert sorted((str(x["doc_id"]), x["n_words"]) for x in got) == expected
    assert license_scan(no_docs).count() == 0 and detections(no_docs).count() == 0


def test_repeated_rows_and_very_long_texts(spark):
    long = "mit license and the apache license version 2 0 " * 60_000  # about 3 MB
    rows = [(1, "under the mit license"), (None, "under the mit license")] * 50 + [(2, long)]
    got = license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 101
    assert {(x["n_base"], x["labels"], x["n_kept"]) for x in got if x["doc_id"] != 2} == {(1, "mit", 1)}
    (x,) = [x for x in got if x["doc_id"] == 2]
    assert (x["n_base"], x["first_word"], x["last_word"]) == (120_000, 0, 59_999 * 9 + 4)
    assert x["labels"] == "apache,apache-2.0,mit" and x["score"] == 0.9


def test_plan_is_native(spark, monkeypatch):
    monkeypatch.setattr(licenses, "cut", lambda frame: frame)
    frame = spark.range(1).selectExpr("id AS doc_id", "'mit license' AS text")
    plan = license_scan(frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("EvalPython|InArrow|InPandas|MapPartitions|FromObject|ExistingRDD", plan)
