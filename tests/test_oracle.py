"""Every registered query against its oracle SQL (DuckDB) on sf0.001:
same columns, same row multiset."""

import pytest

from deskpulse.plans.oracle_sql import oracle_sql
from deskpulse.plans.registry import QUERIES

import __spark_entry__ as E
from inputs import SMALL
from oracle_compare import compare, duck

Q, O = QUERIES, oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_an_oracle():
    assert set(Q) == set(O)


@pytest.mark.parametrize("name", sorted(Q))
def test_query_matches_oracle(spark, con, name):
    r = compare(Q[name](spark, SMALL), con, O[name])
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "response_time_first" in df.columns


def test_every_query_maps_to_inventory_ids():
    from deskpulse.plans.registry import INVENTORY
    assert set(INVENTORY) == set(Q)
    covered = {i for ids in INVENTORY.values() for i in ids}
    for rid in [f"R{i}" for i in range(1, 17)] + [f"C{i}" for i in range(1, 16)]:
        assert rid in covered, rid
