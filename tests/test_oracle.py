"""Every named query against its DuckDB oracle at sf0.001 (the driver runs
the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import digest, duck
from vitrine.plans.queries import REGISTRY

from .conftest import SF

QUERIES = E.queries()
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in REGISTRY}  # the optional queries have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    got = digest(QUERIES[name](spark, SF).toPandas())
    want = digest(con.execute(ORACLE[name]).df())
    assert got[:2] == want[:2]
    assert got[2] == want[2]


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() >= 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["source_id", "rank", "product_id", "similarity", "product_name", "article_type"]
    assert df.count() > 0
