"""Queries with an SQL form against DuckDB over whole tables, and the registered set."""

import os

import duckdb
import pytest

import corpus_pipeline
from skein.llm.queries import ORACLE, QUERIES


def test_every_operator_has_its_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "pii", "bpe"]


@pytest.mark.parametrize("key", sorted(ORACLE))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, key, sf):
    base = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for f in os.listdir(base):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{base}/{f}')")
    want = con.execute(ORACLE[key])
    names = [d[0] for d in want.description]
    got = QUERIES[key](spark, base).select(*names)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want.fetchall()))
