"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import pytest
from check_oracle import duck_connect, norm_rows

import __spark_entry__ as entry

from datapaths import SF_SMALL

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_every_query_has_oracle():
    own = {k for k in QUERIES if k.startswith("dq")}
    assert own == {k for k in ORACLE if k.startswith("dq")} and len(own) == 37


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k.startswith("dq")))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    rel = duck.sql(ORACLE[key])
    assert sorted(df.columns) == sorted(rel.columns)
    srows = [tuple(r) for r in df.collect()]
    drows = rel.fetchall()
    assert len(srows) == len(drows)
    assert norm_rows(df.columns, srows) == norm_rows(rel.columns, drows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "COMPLETENESS_RATE" in df.columns
