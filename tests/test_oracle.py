"""Every query against its SQL twin; those without one must at least run."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from tests.oracle import compare, connect

ORACLE = driver.oracle_sql()
# numbered operators and the pipeline have tests of their own where there is no SQL
QUERIES = {n: q for n, q in driver.queries().items() if n in ORACLE or not re.match(r"op\d+_|pipeline$", n)}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        compare(df, con, ORACLE[name])
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
