"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from queuelake.plans.catalog import QUERIES
from tools.compare import TABLES, digest, spark_to_duck


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_of_the_library_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    stypes = {f.name: spark_to_duck(f.dataType.simpleString()) for f in df.schema.fields}
    otypes = {d[0]: str(d[1]).upper() for d in rel.description}
    assert stypes == otypes
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["o_orderstatus", "n_items", "sum_qty", "revenue"]
    assert df.count() > 0
