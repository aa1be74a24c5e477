"""Licence scans: ordered signature rules behind a keyword filter, in DataFrame functions only.

A text is read once. Where a keyword of the rules occurs, a window of the words around it is kept;
everything else of the text is left behind. The windows meet the rules of their keyword in a join
with the rule table, whose size is that of the source code. Of detections that lie within one
another the strongest rule stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut
from plumbline.llm.license_rules import REACH, Signature, as_json, signatures

#: How sure a kept detection is, by its rule's priority.
STRENGTH = {1: 0.4, 2: 0.7, 3: 0.9, 4: 1.0}
#: Keywords from this length on are looked for as parts of words, which covers their inflections.
LONG_KEYWORD = 6

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULE_SHAPE = (
    "array<struct<rule: int, label: string, priority: int, base: boolean, keyword: string, "
    "lead: string, tail: string, near_lead: string, near_tail: string>>"
)
_KEY = ["doc_id", "text_hash"]


def _blanks(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _gate(line: Column, keywords: set[str]) -> Column:
    """May the line of words, lower-cased in any way that covers A-Z, hold a keyword?"""
    parts: list[str] = []
    for k in sorted(keywords, key=lambda k: (len(k), k)):
        if not any(p in k for p in parts if len(p) >= LONG_KEYWORD):
            parts.append(k)
    tests = [line.contains(p if len(p) >= LONG_KEYWORD else f" {p} ") for p in parts]
    return reduce(lambda a, b: a | b, tests)


def _windows(line: Column, keywords: set[str]) -> Column:
    """For every place of a keyword: its word number, the keyword, and the words on both sides.

    Words before are each followed by a blank and words after each preceded by one, and both sides
    begin and end with a blank.
    """
    words = F.split(F.translate(line, _UPPER, _LOWER), " ", -1)
    known = sorted(keywords)

    def window(own: Column) -> Column:
        def around(word: Column, at: Column) -> Column:
            first = F.greatest(at - REACH, F.lit(0))
            before = F.concat(
                F.lit(" "), F.array_join(F.slice(own, first + 1, at - first), " "), F.lit(" ")
            )
            after = F.concat(
                F.lit(" "), F.array_join(F.slice(own, at + 2, F.lit(REACH)), " "), F.lit(" ")
            )
            side = F.struct(
                at.alias("at"),
                word.alias("keyword"),
                F.when(before == "  ", " ").otherwise(before).alias("before"),
                F.when(after == "  ", " ").otherwise(after).alias("after"),
            )
            return F.when(word.isin(known), side)

        return F.filter(F.transform(own, around), lambda x: x.isNotNull())

    # The words are bound once; named again in the function, the text would be split for each of them.
    return F.flatten(F.transform(F.array(words), window))


def windows(docs: DataFrame, rules: list[Signature]) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_words`` and ``windows`` of every row; kept in the shared folder."""
    keywords = {r.keyword for r in rules}
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.trim(F.regexp_replace("text", BETWEEN_WORDS, " ")).alias("line"),
    )
    line = F.col("line")
    spaced = F.concat(F.lit(" "), F.lower(line), F.lit(" "))
    rows = rows.select(
        *_KEY,
        F.when(line == "", 0).otherwise(_blanks(line) + 1).cast("long").alias("n_words"),
        "line",
        _gate(spaced, keywords).alias("may"),
    )
    return cut(
        rows.select(*_KEY, "n_words", F.when(F.col("may"), _windows(line, keywords)).alias("windows"))
    )


def rule_table(spark: SparkSession, rules: list[Signature]) -> DataFrame:
    """The rules as a table of one row each."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(as_json(rules)), _RULE_SHAPE)))


def _found(read: DataFrame, rules: list[Signature]) -> DataFrame:
    # Rows equal in id and text are one here.
    hits = (
        read.where(F.size("windows") > 0)
        .dropDuplicates(_KEY)
        .select(*_KEY, F.inline("windows"))
    )
    near = F.col("before").endswith(F.col("near_lead")) & F.col("after").startswith(F.col("near_tail"))
    lead = F.expr("regexp_extract(before, lead, 0)")
    tail = F.expr("regexp_extract(after, tail, 0)")
    met = (
        hits.join(F.broadcast(rule_table(read.sparkSession, rules)), "keyword")
        .where(near)
        .withColumns({"lead": lead, "tail": tail})
        .where((F.col("lead") != "") & (F.col("tail") != ""))
    )
    place = F.col("at").cast("long")
    found = met.select(
        *_KEY,
        (place - _blanks(F.col("lead")) + 1).alias("start"),
        (place + _blanks(F.col("tail"))).alias("stop"),
        "rule",
        "label",
        "priority",
        "base",
    )
    # What lies around a detection comes before it in this order, so that the running maximum of the
    # stops of rules as strong or stronger tells whether one covers it.
    before = (
        Window.partitionBy(*_KEY)
        .orderBy("start", F.desc("stop"), F.desc("priority"), "rule")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = F.lit(None)
    for p in STRENGTH:
        strong = F.max(F.when(F.col("priority") >= p, F.col("stop"))).over(before)
        reach = F.when(F.col("priority") == p, strong).otherwise(reach)
    return found.withColumn("kept", F.coalesce(reach < F.col("stop"), F.lit(True)))


def detections(docs: DataFrame, rules: list[Signature] | None = None) -> DataFrame:
    """Every place where a rule matches: ``doc_id``, ``text_hash``, ``start`` and ``stop`` (words from
    0, the end excluded), ``rule``, ``label``, ``priority``, ``base`` and ``kept``.

    A detection is not ``kept`` if another lies around it or at the same place whose rule has a
    higher priority, or the same one and is longer or earlier in the list. Rows equal in id and
    text are read once. Null and empty texts have no detection.
    """
    rules = signatures() if rules is None else rules
    return _found(windows(docs, rules), rules)


def license_scan(docs: DataFrame, rules: list[Signature] | None = None) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id``, ``text_hash``, ``n_words``, ``n_base`` (places of the
    base rules), ``first_word`` and ``last_word`` (their least and greatest start), ``base_labels``
    and ``labels`` (distinct, sorted, comma-joined), ``n_kept`` and ``score``.

    Base labels stay although a longer name covers them; the other labels are those of kept
    detections. The score is that of the surest kept detection, 0 without any. Null texts count as
    empty. Repeated rows are all returned, other columns are ignored, an empty table gives no row.
    """
    rules = signatures() if rules is None else rules
    read = windows(docs, rules)
    strength = F.lit(0.0)
    for p, sure in STRENGTH.items():
        strength = F.when(F.col("priority") == p, F.lit(sure)).otherwise(strength)

    def joined(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    own = _found(read, rules).groupBy(*_KEY).agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        joined(F.col("base")).alias("base_labels"),
        joined(F.col("base") | F.col("kept")).alias("labels"),
        F.count(F.when(F.col("kept"), 1)).alias("n_kept"),
        F.max(F.when(F.col("kept"), strength)).alias("score"),
    )
    own = own.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), *own.columns[2:])
    some = F.coalesce(F.size("windows"), F.lit(0)) > 0
    rows = read.where(some).select(*_KEY, "n_words")
    same = rows["doc_id"].eqNullSafe(own["_id"]) & (rows["text_hash"] == own["_hash"])
    filled = rows.join(own, same, "left").select(
        *_KEY,
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("n_kept", F.lit(0).cast("long")).alias("n_kept"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
    none = read.where(~some).select(
        *_KEY,
        "n_words",
        F.lit(0).cast("long").alias("n_base"),
        F.lit(None).cast("long").alias("first_word"),
        F.lit(None).cast("long").alias("last_word"),
        F.lit("").alias("base_labels"),
        F.lit("").alias("labels"),
        F.lit(0).cast("long").alias("n_kept"),
        F.lit(0.0).alias("score"),
    )
    return filled.union(none)
