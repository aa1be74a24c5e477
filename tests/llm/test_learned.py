"""The learned operators: toxicity, quality, language."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from plumbline.llm import language, quality, queries, toxicity
from plumbline.llm.toxicity import INSULT, NEGATION, OTHER, REPORT, TARGET, THREAT, clause_weight

SF = "/root/testdata/sf0.1"


def clause(*classes):
    return clause_weight(list(classes), [1.0 if c == INSULT else 0.0 for c in classes])


def test_clauses_are_weighed_by_their_context():
    assert clause(OTHER, INSULT) == 1.0
    assert clause(TARGET, OTHER, INSULT) == 1.5
    assert clause(NEGATION, INSULT) == 0.4
    assert clause(REPORT, OTHER, INSULT) == 0.5
    assert clause(REPORT, TARGET, NEGATION, INSULT) == pytest.approx(1.5 * 0.4 * 0.5)
    assert clause(THREAT, OTHER, TARGET) == 4.0
    assert clause(NEGATION, THREAT, TARGET) == pytest.approx(4.0 * 0.4)
    assert clause(THREAT) == clause(TARGET) == clause(THREAT, *[OTHER] * 6, TARGET) == 0.0
    assert clause(INSULT, INSULT) == 2.0


def test_composition_multiplies_step_by_step():
    parts = [toxicity.insult(), toxicity.target(), toxicity.negation(), toxicity.reported()]
    rng = np.random.default_rng(0)
    for _ in range(200):
        state, states = 0, [0] * 4
        for c in rng.integers(0, 6, 12):
            state, factor = toxicity.INSULTS.step[state][c]
            moves = [p.step[s][c] for p, s in zip(parts, states)]
            states = [m[0] for m in moves]
            assert factor == pytest.approx(math.prod(m[1] for m in moves))


def measured(found, labels, label):
    rows = found.join(labels, "doc_id").where("held_out").toPandas()
    good = rows[label] == 1
    rank = rows.score.rank()
    area = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    return area, (rows.predicted == rows[label]).mean()


def test_toxicity_of_documents_held_out(spark):
    labels = queries.table(spark, SF, "labels")
    area, right = measured(queries.op3_toxicity(spark, SF), labels, "toxic")
    assert area > 0.93 and right > 0.95


def test_quality_of_documents_held_out(spark):
    labels = queries.table(spark, SF, "labels")
    area, right = measured(queries.op6_quality(spark, SF), labels, "quality")
    assert area > 0.98 and right > 0.97


def test_language_of_documents_held_out(spark):
    docs = queries.table(spark, SF, "documents").select("doc_id", "lang")
    rows = queries.op8_language(spark, SF).join(docs, "doc_id").where("held_out").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.98


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 3 % 2) for i in range(1, 120)] + [(2, 1, 1), (None, 1, 1), (7, None, None)],
        "doc_id long, quality int, toxic int",
    ).selectExpr("*", "'x' AS text", "'x' AS y")
    every, ids = F.lit(True), sorted(repr(r[0]) for r in odd_rows)
    for own, learn, apply in (
        (toxicity, lambda d, x: toxicity.learn(d, x, every), toxicity.toxicity),
        (quality, lambda d, x: quality.learn(d, x, every), quality.quality),
    ):
        for docs, marks in ((odd_docs, labels), (odd_docs, labels.limit(0)), (no_docs, labels)):
            model = learn(docs, marks)
            found = apply(odd_docs, model).collect()
            assert sorted(repr(r.doc_id) for r in found) == ids
            assert all(0 <= r.score <= 1 for r in found)
            assert apply(no_docs, model).count() == 0
    kept = toxicity.without_toxic(odd_docs, toxicity.Model(patterns={"ünï$": 9.0}))
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 8").count() == 0
    assert kept.count() == len(odd_rows) - 1


def test_language_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    for model in (language.learn(odd_docs, F.lit(True)), language.learn(no_docs, F.lit(True))):
        found = {(r.doc_id, r.lang_pred) for r in language.languages(odd_docs, model).collect()}
        assert {(4, "und"), (5, "und"), (6, "und"), (None, "und")} <= found
        assert {x for d, x in found if d not in (4, 5, 6, None)} <= ({"en", "de"} if model.languages else {"und"})
    assert language.languages(no_docs, model).count() == 0


def test_automaton_knows_every_substring_and_no_other():
    rng = np.random.default_rng(3)
    for n in (1, 2, 30, 200):
        text = rng.integers(2, 5, n).tolist()
        moves = language.transitions(text)

        def known(word):
            s = 0
            for c in word:
                s = moves[s].get(c, -1)
                if s < 0:
                    return False
            return True

        substrings = {tuple(text[i:j]) for i in range(n) for j in range(i, min(n, i + 6) + 1)}
        for _ in range(300):
            word = tuple(rng.integers(2, 6, rng.integers(0, 6)).tolist())
            assert known(word) == (word in substrings)
        assert all(known(w) for w in substrings)


def test_phrases_are_longest_matches():
    model = language.model_of({"a": ["abcabcabd"], "b": ["xyz zyx"]})
    phrases, n, lettered = model.phrases(["abcabd", "xyzq", "", "--", "ab1cab " * 200])
    assert phrases[0, 0] == 1 and phrases[1, 1] == 2 and n.tolist()[:4] == [6, 4, 0, 1]
    assert lettered.tolist() == [True, True, False, False, True]

    def plain(text, sample):
        count, word = 1, ""
        for c in text:
            if word + c in sample:
                word += c
            else:
                count, word = count + 1, c if c in sample else ""
        return count

    own = "ab cab " * 200
    runs = [own[i : i + language.RUN] for i in range(0, len(own), language.RUN)]
    assert phrases[4, 0] == sum(plain(r, "abcabcabd") for r in runs)
    assert language.predict([model], ["ab", "zy", "", "??"])[0] == ["a", "b", "und", "und"]


def test_shapes_and_ngrams():
    assert quality.shape("OF!!") == "A!!" and quality.shape("aB12-x") == "aA0-a"
    assert quality.shape("a" * 100 + "1") == "a0" and quality.shape("-" * 60) == "-" * 60
    slots, starts = quality.ngrams(pa.array(["a a a", "", "A a", "a a a"]))
    own = [set(slots[i:j].tolist()) for i, j in zip(starts, starts[1:])]
    assert own[0] == own[3] and not own[1] and own[0] != own[2]
    assert len(slots) == sum(map(len, own))


def test_hinge_separates_and_meets_its_conditions():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 200)
    rows = [np.unique(np.append(rng.integers(5, 40, 6), 0 if k else 1)) for k in y]
    values = [np.ones(len(r)) for r in rows]
    w, bias = quality.hinge(rows, values, y, np.ones(200), 40, epochs=200)
    margin = np.array([w[r].sum() + bias for r in rows]) * np.where(y == 1, 1, -1)
    assert (margin > 0.9).all()


def test_letters_of_every_script_match_only_themselves():
    rng = np.random.default_rng(5)
    han = [chr(0x4E00 + i) for i in rng.permutation(6000)]
    samples = {f"l{k}": ["".join(rng.choice(han[k * 1500 : k * 1500 + 1500], 900))] for k in range(4)}
    model = language.model_of(samples)
    texts = ["".join(rng.choice(han[k * 1500 : k * 1500 + 1500], 60)) for k in range(4)]
    assert language.predict([model], texts)[0] == list(samples)
    phrases = model.phrases(["".join(samples["l0"])[:300], "\u1200" * 40])[0]
    assert phrases[0].tolist() == [1, 301, 301, 301] and phrases[1].tolist() == [41] * 4


def test_steps_are_those_of_the_automaton():
    rng = np.random.default_rng(2)
    for letters, n in ((3, 400), (300, 900), (5, 0), (4, 1)):
        moves = language.transitions(rng.integers(0, letters, n).tolist())
        steps = language.steps_of(moves, letters + 1)
        for s, row in enumerate(moves):
            cells = steps.base[s] + np.arange(letters + 1)
            own = steps.owner[cells] == s
            assert {c: int(t) for c, t in enumerate(steps.after[cells]) if own[c]} == row
        assert {c: t for c, t in enumerate(steps.first.tolist()) if t} == moves[0]


# --- scores against plain Python, from the same model


def texts_for_scores(spark):
    rows = queries.table(spark, SF, "documents").orderBy("doc_id").limit(180).select("doc_id", "text")
    own = [(r.doc_id, r.text) for r in rows.collect()]
    odd = ["", None, "you are a", "he said you are not bad", "kill you!", "A,b. C", "é" * 3000, "a" * 50 + " 1!"]
    return own + [(10**9 + i, t) for i, t in enumerate(odd)]


def plain_toxicity(text, model):
    """Clause by clause; factors are followed by hand instead of through composed machines."""
    own = ("" if text is None else text).lower()
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", own) if w]
    clauses = [[]]
    for w in words:
        clauses[-1].append(model.kind(w))
        if w[-1] in ".,;:!?":
            clauses.append([])
    total = greatest = number = 0.0
    for clause in clauses:
        weight = 0.0
        target = negated = threat = 0  # words left of each reach
        said = False
        for kind, own_weight in clause:
            factor = (0.4 if negated else 1.0) * (0.5 if said else 1.0)
            if kind == INSULT:
                weight += own_weight * (1.5 if target else 1.0) * factor
            if kind == TARGET and threat:
                weight += 4.0 * factor
            target, negated, threat = (max(0, x - 1) for x in (target, negated, threat))
            if kind == TARGET:
                target, threat = 4, 0
            elif kind == NEGATION:
                negated = 2
            elif kind == THREAT:
                threat = 4
            elif kind == REPORT:
                said = True
        total, greatest, number = total + weight, max(greatest, weight), number + (weight > 0)
    z = model.bias + sum(s * math.log1p(x) for s, x in zip(model.slopes, (total, greatest, number)))
    return 1 / (1 + math.exp(-z))


def test_toxicity_against_plain_python(spark):
    docs, labels = queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels")
    model = toxicity.learn(docs, labels, F.lit(True))
    assert model.patterns
    model.patterns |= {"bad$": 3.0}
    rows = texts_for_scores(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.score for r in toxicity.toxicity(frame, model).collect()}
    for doc_id, text in rows:
        assert found[doc_id] == pytest.approx(plain_toxicity(text, model), abs=1e-9), text


def test_fewer_patterns_may_be_asked_for(spark):
    docs, labels = queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels")
    every = toxicity.learn(docs, labels, F.lit(True)).patterns
    few = toxicity.learn(docs, labels, F.lit(True), patterns=5).patterns
    assert len(few) == 5 and set(few) <= set(every) and min(few.values()) >= sorted(every.values())[-5]


def test_context_tells_more_than_a_sum_of_words():
    """Insults at somebody, threats, negated and reported ones: with the same words in either class, a
    sum of word weights cannot tell them apart, clauses can."""
    model = toxicity.Model(patterns={"frobnik$": 2.0})
    bad = [
        "you are such a frobnik and that is it", "they kill you, it was not fun he said",
        "she hurt him. no, it said so", "go away you frobnik! nothing was said here",
    ]
    good = [
        "nobody is a frobnik", "he said such a frobnik came, and that is you", "it did not hurt you",
        "she said, no never a frobnik", "they said it could not kill him",
    ]
    score = lambda texts: [plain_toxicity(t, model) for t in texts]
    assert min(score(bad)) > max(score(good))

    def words_only(text):  # the best that such a sum could do with these classes: insults and threats
        return sum(model.kind(w)[1] + 4.0 * (model.kind(w)[0] == THREAT) for w in text.lower().split())

    assert min(map(words_only, bad)) <= max(map(words_only, good))


def plain_quality(text, model):
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text or "") if w]
    word = [xxhash.xxh64_intdigest(w.lower()) for w in words]
    form = [xxhash.xxh64_intdigest(quality.shape(w), 1) for w in words]
    same = [int(i > 0 and words[i].lower() == words[i - 1].lower()) for i in range(len(words))]
    mask, slots = 2**64 - 1, set()
    for salt, source, most in ((1, word, 2), (2, form, 3), (3, same, 3)):
        for n in range(1, most + 1):
            for i in range(len(words) - n + 1):
                h = 0
                for x in source[i : i + n]:
                    h = (h * 0x9E3779B97F4A7C15 + x + 1) & mask
                h = (h + salt * 16 + n) & mask
                h = ((h ^ (h >> 33)) * 0xFF51AFD7ED558CCD) & mask
                h = ((h ^ (h >> 33)) * 0xC4CEB9FE1A85EC53) & mask
                slots.add((h ^ (h >> 33)) % quality.SLOTS)
    margin = sum(model.weights[s] for s in slots) / math.sqrt(max(1, len(slots))) + model.bias
    return 1 / (1 + math.exp(-(model.scale * margin + model.offset)))


def test_quality_against_plain_python(spark):
    docs, labels = queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels")
    model = quality.learn(docs, labels, F.lit(True))
    rows = texts_for_scores(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.score for r in quality.quality(frame, model).collect()}
    for doc_id, text in rows:
        assert found[doc_id] == pytest.approx(plain_quality(text, model), abs=1e-7), text


def plain_language(text, samples, model):
    own = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    own = re.sub(" +", " ", own)
    if not own.strip():
        return "und", 0.0
    entropy = []
    for name, bits in zip(model.languages, model.bits):
        sample, count = samples[name], 0
        for start in range(0, len(own), language.RUN):
            run, word, count = own[start : start + language.RUN], "", count + 1
            for c in run:
                if word + c in sample:
                    word += c
                else:
                    count, word = count + 1, c if c in sample else ""
        entropy.append(count * bits / len(own))
    best = min(range(len(entropy)), key=entropy.__getitem__)
    return model.languages[best], 1 / sum(math.exp(-8 * (e - entropy[best])) for e in entropy)


def test_language_against_plain_python(spark):
    docs = queries.table(spark, SF, "documents")
    pieces = {}
    for r in docs.where("lang is not null").orderBy("doc_id").limit(60).collect():
        pieces.setdefault(r.lang, []).append(r.text[:600])
    model = language.model_of(pieces, 3000)
    samples = {name: language.sample_of(own, 3000) for name, own in pieces.items()}
    rows = [(i, (t or "")[:3000]) for i, t in texts_for_scores(spark)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for held in (1, 3, 100):  # languages a task holds at a time
        found = {r.doc_id: r for r in language.languages(frame, model, held).collect()}
        for doc_id, text in rows[:: 1 if held == 100 else 9]:
            name, score = plain_language(text, samples, model)
            assert found[doc_id].lang_pred == name, text
            assert found[doc_id].score == pytest.approx(score, abs=1e-9)


def test_more_languages_than_a_task_holds(spark):
    """Beyond the 200 that were once the most."""
    rng = np.random.default_rng(8)
    own = [[chr(0x4E00 + 20 * k + i) for i in range(20)] for k in range(230)]
    rows = [(k, "".join(rng.choice(own[k % 230], 80)), f"l{k % 230:03}") for k in range(460)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs, F.col("doc_id") < 230)
    assert len(model.languages) == 230
    found = language.languages(docs.where("doc_id >= 230"), model).collect()
    assert all(r.lang_pred == f"l{r.doc_id % 230:03}" and r.score > 0 for r in found) and len(found) == 230


def test_samples_come_from_whole_texts_without_near_copies(spark):
    """Beginnings are boilerplate, ends are not; most rows of a language are copies of one passage."""
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    passage = " ".join(word() for _ in range(300))
    rows = [(i, passage + f" {i}", "x") for i in range(200)]
    rows += [(1000 + i, "same start " * 200 + " ".join(word() for _ in range(400)), "x") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = []
    own = language.model_of
    try:
        language.model_of = lambda samples, chars: kept.append(samples) or own(samples, chars)
        language.learn(docs, F.lit(True), chars=6000)
    finally:
        language.model_of = own
    sample = language.sample_of(kept[0]["x"], 6000)
    shared = sum(sample.count(passage[i : i + 60]) for i in range(0, len(passage) - 60, 60))
    assert len(sample) > 4000 and shared <= 2 * len(passage) / 60
    assert sample.count("same start") < 60
    assert {len(p) for p in kept[0]["x"]} >= {400}
