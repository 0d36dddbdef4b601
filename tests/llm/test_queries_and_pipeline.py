from __future__ import annotations

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from shelfcast.llm import common as C
from shelfcast.llm.oracle import ORACLE
from shelfcast.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.sql(ORACLE[name])
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(want.columns)
    cols = sorted(df.columns)
    assert sorted(map(str, ([r[c] for c in cols] for r in df.collect()))) == sorted(
        map(str, (list(r) for r in want.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall())))


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_pipeline_stages(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = C.persisted(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns
        assert 0 < docs.count() <= n
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == n
    assert sorted(map(tuple, packed.drop("sequence_id", "offset").collect())) == sorted(
        map(tuple, corpus_pipeline.run(spark, sf_dir).drop("sequence_id", "offset").collect()))


def test_pipeline_on_an_empty_table(spark, sf_dir):
    docs = C.table(spark, sf_dir, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = C.persisted(stage(spark, docs, sf_dir), f"test-empty-{name}")
        assert docs.count() == 0
