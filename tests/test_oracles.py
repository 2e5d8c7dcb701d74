"""Every registered query equals its DuckDB oracle on the smallest fixture."""

import pytest

import __spark_entry__ as E
from check_oracles import canon
from strata.plans import catalog

from .conftest import SF_SMALL

ORACLES = E.oracle_sql()
QUERIES = E.queries()


def test_every_query_of_the_reference_has_an_oracle():
    assert set(catalog.QUERIES) <= set(ORACLES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "date" and df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(ORACLES[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(rows, df.columns) == canon(orows, ocols)

