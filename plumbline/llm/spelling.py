"""Spelling variants: words one letter apart, through pairs of numbered trie nodes.

Every prefix of a word is a node of the trie of all words, every suffix one of the trie of the
reversed words. Two words that differ in one letter share the node before it and the node after it;
a word without one letter is another word split at that place. So all neighbours meet in an
equality join of integer pairs (prefix node, suffix node): across a skipped letter, or across
nothing. Nodes are numbered in a scan of the words in order, without a join.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A form must occur so many times as often as the word.
TIMES = 10
#: One in so many occurrences loses a letter.
EDITED = 31

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Nodes on the way to the last word of a partition are numbered from here, the others below.
_BORDER = 1 << 62


def word_counts(
    docs: DataFrame, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT, edited: int = EDITED
) -> DataFrame:
    """``word`` and ``n``: words of at least ``letters`` letters with at least ``least`` occurrences.

    Words are whole runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased; a run whose CRC-32
    with its doc_id (null: empty) is divisible by ``edited`` loses one letter. Null texts have none.
    """
    runs = F.regexp_extract_all(
        F.col("text").cast("string"), F.lit(rf"[A-Za-zÀ-ÿ]{{{letters},}}"), F.lit(0)
    )
    ids = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    lower = docs.select(ids.alias("id"), F.explode(runs).alias("run")).select(
        "id", F.translate("run", _UPPER, _LOWER).alias("run")
    )
    hashed = lower.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = F.expr("CAST(h % char_length(run) AS INT)")
    without = F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run"))
    )
    words = hashed.select(F.when(F.col("h") % edited == 0, without).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _borders(last: list[tuple[int, str]]) -> tuple[list[int], list[str], list[np.ndarray]]:
    """Partitions that hold words, their last words and the numbers of the nodes on the way there."""
    parts, words, paths = [], [], []
    fresh = _BORDER
    before, path = "", np.zeros(1, np.int64)
    for part, word in sorted(last):
        same = _shared(before, word)
        path = np.concatenate((path[: same + 1], np.arange(fresh, fresh + len(word) - same)))
        fresh += len(word) - same
        before = word
        parts.append(part)
        words.append(word)
        paths.append(path)
    return parts, words, paths


def trie_paths(words: DataFrame, column: str) -> DataFrame:
    """``words`` with ``place``, their number in the order of ``column``, and ``path``, the numbers of
    the trie nodes of all its prefixes, from the empty one to the whole.

    A task numbers the nodes that it meets first. Prefixes that words of several partitions share
    are prefixes of the last word of a partition; those are numbered beforehand. One word for each
    partition comes to the driver.
    """
    ordered = cut(words.repartitionByRange(column).sortWithinPartitions(column))

    def lasts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = None
        for batch in batches:
            if batch.num_rows:
                word = batch.column(column)[batch.num_rows - 1].as_py()
        if word is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([word])], ["part", "word"]
            )

    found = [tuple(r) for r in ordered.mapInArrow(lasts, "part int, word string").collect()]
    sent = ordered.sparkSession.sparkContext.broadcast(_borders(found))
    names = [*ordered.columns, "place", "path"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        parts, last, paths = sent.value
        own = bisect_left(parts, part)
        borders = list(zip(last[max(0, own - 1) : own + 1], paths[max(0, own - 1) : own + 1]))
        before, path = "", np.zeros(1, np.int64)
        fresh, place = (part << 40) + 1, part << 40
        for batch in batches:
            out, ends = [], [0]
            for word in batch.column(column).to_pylist():
                same = _shared(before, word)
                path = np.concatenate((path[: same + 1], np.arange(fresh, fresh + len(word) - same)))
                fresh += len(word) - same
                for border, known in borders:
                    n = _shared(border, word)
                    path[: n + 1] = known[: n + 1]
                before = word
                out.append(path)
                ends.append(ends[-1] + len(path))
            n = batch.num_rows
            flat = pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            places = pa.array(np.arange(place, place + n))
            place += n
            yield pa.RecordBatch.from_arrays([*batch.columns, places, lists], names)

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    return ordered.mapInArrow(number, f"{shape}, place long, path array<long>")


def node_pairs(words: DataFrame) -> DataFrame:
    """``p``, ``s``, ``skips``, ``first`` and the ``place`` and ``n`` of a word, for each of its letters
    skipped (nodes before and after the letter) and each place where nothing is skipped.

    ``first`` marks a letter unlike the one before it: skipping either of two equal letters leaves
    the same word, so only one of them counts where a letter is missing.
    """
    rows = words.select("word", "place", "n", "path", "back", (F.size("path") - 1).alias("l"))
    skipped = """transform(sequence(0, l - 1), i -> named_struct('p', path[i], 's', back[l - i - 1],
        'skips', true, 'first', i = 0 OR substring(word, i, 1) <> substring(word, i + 1, 1)))"""
    split = """transform(sequence(0, l), i -> named_struct('p', path[i], 's', back[l - i],
        'skips', false, 'first', false))"""
    return rows.selectExpr("place", "n", f"inline(concat({skipped}, {split}))")


def neighbours(words: DataFrame) -> DataFrame:
    """``place``, ``n_near`` and ``best`` (``less``, minus its count, and ``other``, its place) of every
    word that has a near word.

    A pair of nodes belongs to one string with a gap; the words that meet there differ in the one
    letter of the gap, or lack it, so that there are no more of them than letters, 91.
    """
    own = F.collect_list(F.struct((-F.col("n")).alias("less"), "place", "skips", "first"))
    groups = node_pairs(words).groupBy("p", "s").agg(F.array_sort(own).alias("own"))
    near = """filter(own, o -> o.place <> m.place AND (
        (m.skips AND o.skips) OR (m.skips AND m.first AND NOT o.skips)
        OR (NOT m.skips AND o.skips AND o.first)))"""
    met = groups.where("size(own) > 1").selectExpr(
        f"inline(transform(own, m -> named_struct('place', m.place, 'near', {near})))"
    )
    return met.where("size(near) > 0").groupBy("place").agg(
        F.sum(F.size("near")).alias("n_near"),
        F.expr("min(named_struct('less', near[0].less, 'other', near[0].place))").alias("best"),
    )


def _roots(links: DataFrame) -> DataFrame:
    """``place`` and ``root``: where following ``form`` ends.

    Each step doubles the way that is followed. A form occurs ten times as often as its word, so
    that no way has more than some twenty steps, or five doublings.
    """
    own = links.selectExpr("place", "form AS root")
    while True:
        on = own.selectExpr("place AS here", "root AS next")
        joined = own.join(on, own.root == on.here, "left")
        own = cut(
            joined.selectExpr("place", "coalesce(next, root) AS root", "next IS NOT NULL AS moved")
        )
        moved = own.where("moved").limit(1).count()
        own = own.select("place", "root")
        if not moved:
            return own


def spelling_variants(
    docs: DataFrame,
    letters: int = LEAST_LETTERS,
    least: int = LEAST_COUNT,
    times: int = TIMES,
    edited: int = EDITED,
) -> DataFrame:
    """Every word of ``word_counts`` with ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    Two words are near if one inserted, deleted or replaced letter makes one the other. The form is
    the most frequent near word (ties: the first in code-point order) if it occurs at least
    ``times`` as often, else null; ``root`` is where forms lead to, or the word itself. A table
    without such words, empty or of null texts, gives no row; rows may repeat and count each time.
    """
    words = cut(word_counts(docs, letters, least, edited))
    ahead = cut(trie_paths(words, "word"))
    back = trie_paths(words.select(F.reverse("word").alias("drow")), "drow").select(
        F.reverse("drow").alias("same"), F.col("path").alias("back")
    )
    both = ahead.join(back, ahead.word == back.same).drop("same")
    best = cut(
        neighbours(both).selectExpr(
            "place AS near_place", "n_near", "best.other AS other", "-best.less AS other_n"
        )
    )
    names = ahead.select("place", "word", "n")
    rated = names.join(best, names.place == best.near_place, "left").selectExpr(
        "place",
        "word",
        "n",
        "coalesce(n_near, 0L) AS n_near",
        f"CASE WHEN other_n >= n * {int(times)}L THEN other END AS form",
        f"CASE WHEN other_n >= n * {int(times)}L THEN other_n END AS form_n",
    )
    linked = cut(rated)
    roots = _roots(linked.where("form IS NOT NULL")).selectExpr("place AS rooted", "root AS root_place")
    forms = names.selectExpr("place AS form_place", "word AS form_word")
    ends = names.selectExpr("place AS end_place", "word AS root_word")
    some = (
        linked.where("form IS NOT NULL")
        .join(forms, F.col("form") == F.col("form_place"))
        .join(roots, F.col("place") == F.col("rooted"))
        .join(ends, F.col("root_place") == F.col("end_place"))
        .selectExpr("word", "form_word AS form", "root_word AS root", "n", "n_near", "form_n")
    )
    none = linked.where("form IS NULL").selectExpr(
        "word", "CAST(NULL AS STRING) AS form", "word AS root", "n", "n_near", "form_n"
    )
    return some.union(none)
