"""Every registered query against its SQL (or against having rows)."""

from __future__ import annotations

import pytest
from compare import difference, duck

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_oracle_has_a_query():
    assert not set(ORACLES) - set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    run = entry.queries()[name]
    if name in ORACLES:
        assert difference(spark, con, name, run, ORACLES[name], FOLDER) is None
    else:
        assert run(spark, FOLDER).count() > 0
