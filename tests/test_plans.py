"""Physical-plan properties of the registered queries (sf0.001 inputs)."""

import pytest

from deskpulse.plans.registry import QUERIES
from inputs import SMALL

Q = QUERIES
UNCAPPED = ["attendance", "frt_chat_multi_grain", "frt_email_multi_grain", "frt_email_kpi", "frt_email_flex",
            "frt_chat_asof", "wait_time_supervisor", "wait_time_multi_grain", "productivity_hourly"]
GRAIN_QUERIES = ["frt_chat_multi_grain", "frt_email_multi_grain", "frt_email_kpi", "frt_email_flex", "frt_chat_flex",
                 "wait_time_supervisor", "wait_time_multi_grain", "productivity_flex", "update_lag_multi_grain"]


def plan(spark, name):
    return Q[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q))
def test_no_nested_loop_or_cartesian(spark, name):
    p = plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


@pytest.mark.parametrize("name", ["text_date_sort_top_k", "real_date_sort_top_k"])
@pytest.mark.parametrize("threshold", ["1", "100000"])
def test_top_k_has_one_plan_in_every_session(spark, name, threshold):
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key, "1000")
    spark.conf.set(key, threshold)
    try:
        p = plan(spark, name)
    finally:
        spark.conf.set(key, before)
    assert "TakeOrderedAndProject" in p and "WindowGroupLimit" not in p


@pytest.mark.parametrize("name", UNCAPPED)
def test_reports_are_uncapped(spark, name):
    assert "Limit" not in plan(spark, name) and "TakeOrdered" not in plan(spark, name)


@pytest.mark.parametrize("name", GRAIN_QUERIES)
def test_no_window_in_grain_queries(spark, name):
    assert "Window" not in plan(spark, name)


@pytest.mark.parametrize("name", ["latest_update_per_ticket", "first_update_per_ticket"])
def test_no_window_over_raw_facts_in_argmax(spark, name):
    # argmax per ticket is a grouped aggregate joined back, not a window
    p = plan(spark, name)
    assert "HashAggregate" in p and "Window" not in p


def test_longest_wait_operator_plan(spark):
    from deskpulse.operators import longest_wait
    from deskpulse.sources import load_tables
    t = load_tables(spark, SMALL)
    p = longest_wait(t.call_legs, "acct_a")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in p and "Window" not in p


def test_filters_and_columns_reach_scan(spark):
    df = Q["attendance"](spark, SMALL)
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(client_account), IsNotNull(shift_start), EqualTo(client_account" in txt
    assert "ReadSchema" in txt


def test_dimensions_are_broadcast(spark):
    p = plan(spark, "csat_raw")
    assert "BroadcastHashJoin" in p


def test_email_tickets_get_one_latest_update_step(spark):
    p = plan(spark, "channel_counts_hourly")
    # one scan condition for both channels, none for either alone
    assert "In(channel, [api,email])" in p or "In(channel, [email,api])" in p
    assert "EqualTo(channel,email)" not in p and "EqualTo(channel,api)" not in p
