"""Every registered query vs its SQL oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import canon

QUERIES = dict(E.LISTING_QUERIES)
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_query_has_an_id_prefix():
    for name in QUERIES:
        assert name.split("_")[0][0] in "SPFJAWOUXHM", name


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    from conftest import SF01
    sdf = QUERIES[name](spark, SF01)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert canon(sdf.columns, srows) == canon(dcols, drows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    from conftest import SF001
    QUERIES[name](spark, SF001).collect()
