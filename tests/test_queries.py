"""Every registered query on the smallest data set, against its SQL where there is one."""

import pytest

import __spark_entry__ as contract
from sparkmart.plans.catalog import all_queries
from tests.conftest import SF
from tests.oracle import compare

QUERIES = all_queries()


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_against_sql(spark, name):
    assert compare(spark, SF, QUERIES[name]) == []


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if not q.sql))
def test_without_sql(spark, name):
    assert QUERIES[name].run(spark, SF).count() > 0


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries()) >= set(QUERIES)
    assert contract.entry(spark).columns == ["brand", "total_revenue", "product_count", "revenue_share_pct"]
