"""The Spark fixture inputs equal their SQL definitions (DuckDB)."""

import pytest

from inputs import SMALL
from deskpulse.plans.oracle_fixtures import with_fixtures
from deskpulse.sources.fixtures import fixture_tables
from oracle_compare import compare, duck

NAMES = ["email_tickets", "chat_tickets", "call_tickets", "web_tickets", "call_legs", "chat_insights",
         "email_metrics", "kpi_summary", "attendance", "agent_roster", "subteams", "tracked_time",
         "hr_roster", "manual_time", "dsat_exclusions"]


@pytest.fixture(scope="module")
def tabs(spark):
    return fixture_tables(spark, SMALL)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_fixture_matches_sql(tabs, con, name):
    r = compare(tabs[name], con, with_fixtures(f"SELECT * FROM {name}"))
    assert r["values_match"], r
