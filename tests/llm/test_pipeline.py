"""The pipeline and the queries, against SQL where there is some."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from test_decontamination import plain as plain_items
from test_near_duplicates import bits, classes, plain as plain_print

import corpus_pipeline
from plumbline.llm import mixing, queries


def rows_of(frame):
    return sorted(tuple("NULL" if v is None else repr(v) for v in r) for r in frame.collect())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(name, spark, sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    found = queries.QUERIES[name](spark, sf_dir)
    expected = connection.execute(queries.SQL[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(found.columns)
    want = sorted(tuple("NULL" if v is None else repr(v) for v in r) for r in expected.fetchall())
    assert rows_of(found.select(*names)) == want


NOT_BY_DOCUMENT = {"op2_warc", "op4_decontamination", "op12_spelling", "op13_lexical"}


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - NOT_BY_DOCUMENT))
def test_every_document_is_in_the_result_once(name, spark, sf_dir):
    found = queries.QUERIES[name](spark, sf_dir).select("doc_id").collect()
    docs = queries.table(spark, sf_dir, "documents").select("doc_id").collect()
    assert sorted(found) == sorted(docs)


def test_entry_has_all_queries():
    import __spark_entry__ as entry

    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}


def test_stages_decide_as_brute_force_does(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = queries.table(spark, sf_dir, "documents")
    columns = docs.columns
    before, read = {r.doc_id: r for r in docs.collect()}, docs
    items = [(r.item_id, r.text) for r in queries.table(spark, sf_dir, "benchmark").collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, read, sf_dir)
        made.write.parquet(path := f"{folder}/{i}")
        read, order = spark.read.parquet(path), None
        after = {r.doc_id: r for r in read.collect()}
        if name == "toxicity":
            kept = set(after)
            scored = queries.op3_toxicity(spark, sf_dir).where("predicted = 0")
            expected = {r.doc_id for r in scored.collect()}
        elif name == "near_duplicates":
            prints = {d: plain_print(r.text) for d, r in before.items()}
            roots = classes(set(prints.values()), lambda x, y: bits(x, y) <= 4)
            expected = {min(d for d, p in prints.items() if roots[p] == root) for root in set(roots.values())}
        elif name == "decontamination":
            bad = {d for d, *_ in plain_items([(d, r.text) for d, r in before.items()], items)}
            expected = set(before) - bad
        else:
            expected = set(before)
        assert set(after) == expected, name
        if name != "token_files":
            assert read.columns == columns and all(after[d] == before[d] for d in after)
        if name == "mixing":
            placed = mixing.mix(spark.createDataFrame(list(before.values()), docs.schema)).collect()
            mixture = [r.doc_id for r in sorted(placed, key=lambda r: r.position)]
        if name == "token_files":
            assert [r.doc_id for r in read.orderBy("start").collect()] == mixture
        before = after


def test_run_is_its_stages(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    total = found.agg(F.sum("n_tokens"), F.max(F.col("start") + F.col("n_tokens"))).first()
    assert total[0] == total[1] and found.count() > 100


def test_stages_take_empty_tables(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == 0


def test_whole_run_over_odd_rows(spark, odd_docs, odd_rows, tmp_path):
    """Null ids and texts, repeated rows, columns with clashing names, one very long text."""
    rows = [*odd_rows, (500, "lo ng wo rds " * 200_000, "en", "a", None), odd_rows[-1], odd_rows[-1]]
    schema = odd_docs.select("doc_id", "text", "lang", "source", "n_chars").schema
    extra = [F.lit(f"extra {c}").alias(c) for c in odd_docs.columns[5:]]
    spark.createDataFrame(rows, schema).select("*", *extra).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, i % 2, i % 3 % 2) for i in range(1, 120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, odd_rows[-1][1]), (2, None), (None, "no such passage in any of these documents")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    by_print = {}
    for r in rows:
        by_print.setdefault(plain_print(r[1]), []).append(r)
    roots = classes(set(by_print), lambda x, y: bits(x, y) <= 4)
    groups = {}
    for p, own in by_print.items():
        groups.setdefault(roots[p], []).extend(own)
    # Of each group the row with the smallest id stays; nothing is toxic, one group is an item's.
    expected = {min((r[0] for r in own if r[0] is not None), default=None) for own in groups.values()}
    expected -= {odd_rows[-1][0]}
    assert len(found) == len(groups) - 1 and {r.doc_id for r in found} == expected
    starts = sorted((r.start, r.n_tokens) for r in found)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    assert max(n for _, n in starts) > 600_000
