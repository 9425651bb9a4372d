"""Registered operator queries: one for each operator, and those with SQL compared with it."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import compare
from lodestay.llm import decontaminate, quality, queries
from lodestay.suite.registry import TABLES
from tests.llm import test_text_operators as text_operators


def test_every_operator_has_a_query():
    named = entry_points.queries()
    assert {n for n in named if n.startswith("op")} == set(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert "pipeline" in named and set(queries.ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    text, _, fine = compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], sf)
    assert fine, text


def test_items_without_id_match_sql(spark, tmp_path, monkeypatch):
    words = [f"w{k}" for k in range(15)]
    docs = [(1, " ".join(words)), (2, "a " + " ".join(words[:13]) + " z"), (3, "it is short"), (4, "nothing here"), (5, None)]
    items = [(None, " ".join(words)), (None, "is short"), (7, " ".join(words[1:])), (8, None), (None, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    for block in (1 << 20, 3):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
        query = queries.QUERIES["op9_decontaminate"]
        text, _, fine = compare(spark, con, "op9_decontaminate", query, queries.ORACLES["op9_decontaminate"], str(tmp_path))
        assert fine, text
        got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in query(spark, str(tmp_path)).collect()}
        assert got == {1: (15, 2, True), 2: (13, 1, True), 3: (2, 1, True), 4: (0, 0, False), 5: (0, 0, False)}


def test_sentence_ends_match_sql(spark, tmp_path):
    lines = [*text_operators.SENTENCES.values(), *(f"one two three four five six seven eight nine ten eleven twelve {{}}{m}" for m in quality.SENTENCE_ENDS)]
    rows = [(i, line.format("one")) for i, line in enumerate([*lines, lines[0][:-1]])]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    query = queries.QUERIES["op5_quality_rules"]
    text, _, fine = compare(spark, con, "op5_quality_rules", query, queries.ORACLES["op5_quality_rules"], str(tmp_path))
    assert fine, text
    assert [r.doc_id for r in query(spark, str(tmp_path)).where("not kept").collect()] == [len(lines)]
