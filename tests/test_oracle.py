"""Every registered query against its DuckDB oracle on the smallest scale factor.

Queries without an oracle must at least run and return their schema.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from skein.plans.catalog import ORACLE, QUERIES
from tools.check_oracle import TABLES, digest, norm, spark_to_duck

SF = os.environ.get("SKEIN_TEST_SF", "/root/testdata/sf0.001")
#: The queries of the library itself; the text queries have their own tests.
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create or replace view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


#: Hierarchical clusters have no SQL form: `test_density.py` holds them against a plain version.
NO_SQL = {"density_clusters", "per_chat_density"}


def test_every_key_has_an_oracle():
    assert set(KEYS) - NO_SQL == set(ORACLE)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    cols = df.columns
    srows = [tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect()]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        return
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    idx = {c: i for i, c in enumerate(dcols)}
    drows = [tuple(norm(r[idx[c]]) for c in sorted(dcols)) for r in res.fetchall()]
    assert sorted(cols) == sorted(dcols)
    dtypes = {d[0]: str(d[1]) for d in res.description}
    assert {f.name: spark_to_duck(f.dataType.simpleString()) for f in df.schema.fields} == dtypes
    assert len(srows) == len(drows)
    assert digest(srows) == digest(drows)
