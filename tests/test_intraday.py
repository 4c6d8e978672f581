"""One supervisor per ticket by the time of day, against brute force."""

import datetime as dt

from hypothesis import given, settings, strategies as st

from deskpulse.config import DEFAULT
from deskpulse.functions import seconds_of_day
from deskpulse.operators import day_intervals, in_effect
from deskpulse.plans import productivity as prod, wait
from deskpulse.sources import load_tables
from inputs import SMALL

D = dt.date(2024, 1, 1)
ENTRIES = st.lists(st.tuples(st.sampled_from(["ann", "bob", None]), st.integers(0, 1), st.one_of(st.none(), st.integers(0, 8)),
                             st.sampled_from(["s1", "s2", "s3", None])), max_size=14)
FACTS = st.lists(st.tuples(st.sampled_from(["ann", "bob", "cy", None]), st.integers(0, 1), st.one_of(st.none(), st.integers(0, 9))),
                 min_size=1, max_size=14)


@settings(max_examples=10, deadline=None)
@given(FACTS, ENTRIES)
def test_value_in_effect_equals_brute_force(spark, facts, entries):
    day = lambda n: D + dt.timedelta(days=n)
    f = spark.createDataFrame([(i, a, day(d), t) for i, (a, d, t) in enumerate(facts)], "n int, agent string, day date, at bigint")
    e = spark.createDataFrame([(a, day(d), t, v) for a, d, t, v in entries], "who string, on date, began bigint, sup string")
    runs = day_intervals(e, ["who", "on"], "began", "sup")
    got = sorted((r["n"], r["sup"]) for r in in_effect(f, runs, ["agent", "day"], "at", ["who", "on"], "sup").collect())
    want = []
    for i, (a, d, t) in enumerate(facts):
        own = {}
        for who, on, began, v in entries:
            if None not in (who, began, v, a) and (who, on) == (a, d):
                own[began] = min(v, own.get(began, v))
        past = [b for b in own if b <= (t or 0)]
        want.append((i, own[max(past)] if past else own[min(own)] if own else None))
    assert got == want


def test_runs_are_merged_and_cover_the_day_once(spark):
    e = spark.createDataFrame([("ann", D, t, v) for t, v in [(60, "s1"), (90, "s1"), (120, "s2"), (150, "s2"), (200, "s1")]],
                              "who string, on date, began bigint, sup string")
    got = sorted(tuple(r) for r in day_intervals(e, ["who", "on"], "began", "sup").select("_from", "_until", "sup").collect())
    assert got == [(0, 120, "s1"), (120, 200, "s2"), (200, None, "s1")]


def test_seconds_of_day(spark):
    df = spark.createDataFrame([("01:02:03",), ("1:2",), ("x",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(seconds_of_day("t")).collect()] == [3723, 3720, None, None, None]


def test_one_supervisor_gives_every_call_ticket_of_an_agent_once(spark):
    t = load_tables(spark, SMALL)
    keys = ["client_account", "ticket_id", "local_date_created", "hour_", "assignee_id", "agent_name", "dur"]
    once = wait.wait_time_supervisor(t, one_supervisor=True)
    assert once.count() == once.select(*keys).distinct().count()
    plain = wait.wait_time_multi_grain(t)
    assert once.count() == plain.select(*keys).distinct().count()
    assert wait.wait_time_supervisor(t).count() >= once.count()


def test_one_supervisor_adds_up_to_the_tickets(spark):
    t = load_tables(spark, SMALL)
    rows = prod.channel_rows(t, DEFAULT, None, hourly=True)
    rows = rows.select("channel", "local_date_created", "local_time_created", "ticket_id", "assignee_id").distinct()
    duty = prod._on_duty(t, rows).select(*rows.columns, "agent_name", "subteam", "is_core_team").distinct()
    assert prod.tickets_by_supervisor(t).groupBy().sum("h_tickets").first()[0] == duty.where("ticket_id is not null").count()
