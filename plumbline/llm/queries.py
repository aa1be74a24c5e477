"""The queries of this subpackage: each operator over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    decontamination,
    fingerprints,
    language,
    lexical,
    licenses,
    mixing,
    near_duplicates,
    quality,
    repeats,
    spelling,
    token_files,
    toxicity,
    warc,
)
from plumbline.llm.common import shared_folder
from plumbline.llm.license_rules import REACH, signatures


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how alike neighbours are."""
    prints = fingerprints.with_neighbour_counts(
        fingerprints.fingerprints(table(spark, sf_dir, "documents"))
    )
    return prints.withColumns(
        {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back from them."""
    archives = warc.write_warc(table(spark, sf_dir, "pages"), shared_folder(spark))
    return warc.read_warc(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from four fifths of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = toxicity.fold(F.col("doc_id"), 5) == 0
    scored = toxicity.toxicity(docs, toxicity.learn(docs, labels, ~held_out))
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in documents."""
    found = decontamination.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.drop("text_hash", "estimate")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, written to files and read back from them."""
    folder = shared_folder(spark)
    files = token_files.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return token_files.token_digests(token_files.read_tokens(files))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from three quarters of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = toxicity.fold(F.col("doc_id"), 4) == 2
    scored = quality.quality(docs, quality.learn(docs, labels, ~held_out))
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without strings of 200 bytes that occur elsewhere."""
    kept = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from three quarters of the documents."""
    docs = table(spark, sf_dir, "documents")
    held_out = toxicity.fold(F.col("doc_id"), 4) == 2
    found = language.languages(docs, language.learn(docs, ~held_out))
    return found.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the mixture of sources, weighted by the root of their sizes."""
    return mixing.mix(table(spark, sf_dir, "documents"), columns=["doc_id", "source"])


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash and near-duplicate class."""
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licences."""
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("text_hash")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word, its usual form and its near words."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item's ten best documents."""
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_warc": op2_warc,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_token_files": op5_token_files,
    "op6_quality": op6_quality,
    "op7_repeats": op7_repeats,
    "op8_language": op8_language,
    "op9_mixing": op9_mixing,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_licenses": op11_licenses,
    "op12_spelling": op12_spelling,
    "op13_lexical": op13_lexical,
}

#: Lower-cases A-Z only.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = (
    "list_filter(regexp_split_to_array(" + _LOWER.format("coalesce(text, '')")
    + r", '[ \t\n\x0B\f\r]+'), lambda x: x <> '')"
)

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Four bits of each hexadecimal digit, in order.
_NIBBLES = "".join(f"{i:04b}" for i in range(16))
_BASE32 = (
    "array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    "1 + list_sum(list_transform(range(0, 5), lambda k: "
    "CAST(substr(bits, i * 5 + k + 1, 1) AS INTEGER) << (4 - k)))::INTEGER, 1)), '')"
)



def _licenses_sql() -> str:
    """The rules as a table of values; every rule at every place of its keyword, and its cover."""
    rules = ", ".join(
        f"({r.rule}, '{r.label}', {r.priority}, {r.base}, '{r.keyword}', '{r.lead}', '{r.tail}')"
        for r in signatures()
    )
    sure = " ".join(f"WHEN {p} THEN {s}" for p, s in licenses.STRENGTH.items())
    lower = _LOWER.format("coalesce(text, '')")
    spaces = "length({0}) - length(replace({0}, ' ', ''))"
    return rf"""
WITH rules(rule, label, priority, base, keyword, lead, tail) AS (VALUES {rules}),
t AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
place AS (SELECT r, w, unnest(range(0, len(w))) AS i FROM t),
hit AS (
  SELECT r, i, w[i + 1] AS keyword,
         CASE WHEN i = 0 THEN ' ' ELSE ' ' || array_to_string(w[greatest(1, i - {REACH - 1}):i], ' ') || ' ' END AS b,
         CASE WHEN i + 1 = len(w) THEN ' '
              ELSE ' ' || array_to_string(w[i + 2:i + 1 + {REACH}], ' ') || ' ' END AS a
  FROM place WHERE w[i + 1] IN (SELECT keyword FROM rules)
),
met AS (
  SELECT r, i, rule, label, priority, base, regexp_extract(b, lead) AS x, regexp_extract(a, tail) AS y
  FROM hit JOIN rules USING (keyword)
),
found AS (
  SELECT DISTINCT r, i - ({spaces.format("x")}) + 1 AS start, i + ({spaces.format("y")}) AS stop,
         rule, label, priority, base
  FROM met WHERE x <> '' AND y <> ''
),
judged AS (
  SELECT *, NOT EXISTS (
    SELECT 1 FROM found o WHERE o.r = f.r AND o.start <= f.start AND o.stop >= f.stop
      AND o.priority >= f.priority
      AND (o.start < f.start OR o.stop > f.stop OR o.priority > f.priority OR o.rule < f.rule)
  ) AS kept
  FROM found f
),
own AS (
  SELECT r, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
         max(start) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base OR kept) AS labels,
         count(*) FILTER (WHERE kept) AS n_kept,
         max(CASE priority {sure} END) FILTER (WHERE kept) AS score
  FROM judged GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(n_kept, 0) AS n_kept, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM t LEFT JOIN own USING (r)
"""


SQL: dict[str, str] = {
    "op2_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS sha,
             max(page_id) OVER (PARTITION BY html) AS latest FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr('{_NIBBLES}',
             (instr('0123456789abcdef', substr(sha, i, 1)) - 1) * 4 + 1, 4)), '') AS bits FROM h)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM b
""",
    "op4_decontamination": f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(5, len(w)) AS n FROM items WHERE len(w) > 0),
parts AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
),
totals AS (SELECT item_id, count(*) AS n_shingles FROM parts GROUP BY item_id),
texts AS (SELECT doc_id, {_WORDS} AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM sized),
runs AS (
  SELECT DISTINCT doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, lengths)
),
shared AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM runs JOIN parts USING (n, s)
  GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM shared JOIN totals USING (item_id) WHERE n_shared / n_shingles >= 0.8
""",
    "op11_licenses": _licenses_sql(),
    "op13_lexical": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("text")}, '{_TERM}') AS w
           FROM documents WHERE text IS NOT NULL),
totals AS (SELECT CAST(count(*) AS BIGINT) AS many, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
asked AS (
  SELECT item_id, text, t, count(*) AS c
  FROM (SELECT item_id, text, unnest(regexp_extract_all({_LOWER.format("text")}, '{_TERM}')) AS t
        FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, text, t
),
scored AS (
  SELECT item_id, asked.text, doc_id, r, CAST(sum(c * CAST(floor(1000 * ln((2 * many + 2) / (2 * df + 1))) AS BIGINT)
         * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(w) * many) // total)))) AS BIGINT) AS score
  FROM asked JOIN df USING (t) JOIN tf USING (t) JOIN d USING (r), totals
  GROUP BY item_id, asked.text, doc_id, r
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS place
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 10
""",
}
