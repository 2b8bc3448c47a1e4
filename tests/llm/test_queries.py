"""Registered queries against their SQL and against plain definitions, on the small driver tables."""

import os
import sys

import duckdb
import pytest

import corpus_pipeline
from folio.llm import queries as Q

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = Q.QUERIES[name](spark, SF)
    want = con.sql(Q.ORACLE[name])
    assert got.columns == want.columns
    assert plain(got) == sorted(want.fetchall())


@pytest.mark.parametrize("name, defined", [
    ("op1_substring_dedup", brute.substring_dedup), ("op3_ngram_jaccard_join", brute.jaccard_components),
    ("op4_suffix_array_dedup", brute.suffix_dedup), ("op10_line_dedup", brute.line_dedup)])
def test_definition(spark, rows, name, defined):
    assert plain(Q.QUERIES[name](spark, SF)) == sorted(defined(rows))


def test_pipeline_keeps_clean_documents(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0").collect()}
    packed = corpus_pipeline.run(spark, SF)
    kept = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert kept <= {r.doc_id for r in docs.collect()}
    assert len(kept) >= 0.5 * docs.count()
    assert len(bad & kept) <= 0.2 * len(bad) + 1
    totals = packed.groupBy("sequence_id").sum("length").collect()
    assert all(r[1] <= 2048 for r in totals)
