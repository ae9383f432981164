"""Every registered query against its SQL, on the smallest tables."""

import oracle
import pytest

from __spark_entry__ import entry
from faultloom.plans.queries import QUERIES as REGISTERED

QUERIES = {name: q.run for name, q in REGISTERED.items()}
SQL = {name: q.oracle for name, q in REGISTERED.items() if q.oracle is not None}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert oracle.compare(spark, name, QUERIES[name], SQL[name], sf_dir) is None


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry_runs(spark):
    assert entry(spark).count() == 1
