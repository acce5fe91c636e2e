"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle import duck, duck_bag, spark_bag

import __spark_entry__ as registry


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_entry(spark):
    assert registry.entry(spark).columns == ["day", "total_count"]


def test_every_query_has_sql():
    own = {name for name in registry.queries() if not name.startswith(("op", "pipeline"))}
    assert own <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SMALL)
    sql = registry.oracle_sql()[name]
    columns = {r[0] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert set(df.columns) == columns
    found = spark_bag(df)
    assert found and found == duck_bag(con, sql)
