"""Report-level hazards on tiny hand-made inputs."""

import dataclasses
import datetime as dt

from deskpulse.config import DEFAULT
from deskpulse.plans import frt, productivity, wait
from deskpulse.sources.tables import Tables

D = dt.date
TICKET = ("client_account string, ticket_id string, channel string, status string, type string, tags string, "
          "assignee_id string, local_date_created date, local_time_created string, date_updated date, "
          "satisfaction_rating_score string, satisfaction_rating_comment string")
DDL = {
    "email_tickets": TICKET, "chat_tickets": TICKET, "web_tickets": TICKET,
    "call_tickets": TICKET + ", via_source_rel string",
    "call_legs": "client_account string, ticket_id string, forwarded_to string, status string, wait_time string, "
                 "local_date date, local_time string",
    "chat_insights": "client_account string, ticket_id string, type string, local_date date, "
                     "response_time_first double, abandon_time bigint",
    "email_metrics": "ticket_id string, reply_time_calendar_minutes bigint",
    "kpi_summary": "client_account string, ticket_id string, channel string, agent_name string, assignee_id string, "
                   "satisfaction_rating_score string, local_date_created date, frt_calendar bigint",
    "attendance": "client_account string, agent_email string, agent_name string, shift_start timestamp_ntz, "
                  "shift_end timestamp_ntz, clock_in timestamp_ntz, clock_out timestamp_ntz, absenteeism bigint, "
                  "tardiness bigint",
    "agent_roster": "client_account string, assignee_id string, agent_name string, agent_email string",
    "subteams": "zendesk_id string, agent_name string, agent_email string, subteam string, start_date date, "
                "end_date date, is_core_team boolean",
    "tracked_time": "client_account string, division_account string, division_name string, function string, "
                    "agent_name string, agent_email string, supervisor string, activity string, start_date date, "
                    "start_time string, duration_seconds bigint, is_billable boolean",
    "hr_roster": "first_name string, last_name string, email_address string, job_department string, "
                 "job_division string, profile_status string, job_supervisor string, status_effectivity_date date, "
                 "job_effectivity_date date, created_on date",
    "manual_time": "date date, agent_alias string, agent_name string, duration_seconds bigint, "
                   "duration_minutes bigint",
    "dsat_exclusions": "ext_interaction_id string",
}


def tables(spark, **rows):
    return Tables(**{k: spark.createDataFrame(rows.get(k, []), ddl) for k, ddl in DDL.items()})


def upd(tid, channel, assignee, created, updated, status="solved", time="10:30:00", acct="acct_a", score=None):
    return (acct, tid, channel, status, "incident", "t", assignee, created, time, updated, score, None)


def test_h1_filter_order_differs_by_channel(spark):
    # email: the latest update decides, and it is by an unrostered agent -> not counted;
    # chat: only rostered updates compete -> the earlier, rostered update counts.
    t = tables(spark,
               agent_roster=[("acct_a", "1", "Ann", "ann@x")],
               email_tickets=[upd("e1", "email", "1", D(2024, 1, 1), D(2024, 1, 2)),
                              upd("e1", "email", "9", D(2024, 1, 1), D(2024, 1, 3))],
               chat_tickets=[upd("c1", "chat", "1", D(2024, 1, 1), D(2024, 1, 2)),
                             upd("c1", "chat", "9", D(2024, 1, 1), D(2024, 1, 3))],
               chat_insights=[("acct_a", "c1", "chat", D(2024, 1, 1), 5.0, None)])
    got = [tuple(r) for r in productivity.channel_counts_hourly(t, DEFAULT).collect()]
    assert got == [(D(2024, 1, 1), 10, "1", "Ann", "chat", 1)]


def test_h11_nan_is_missing_in_flex_chat(spark):
    flex = DEFAULT.flex_roster_account
    t = tables(spark,
               agent_roster=[(flex, "3", "Flo", "flo@x")],
               chat_tickets=[upd("a", "chat", "3", D(2024, 1, 1), D(2024, 1, 1)),
                             upd("b", "chat", "3", D(2024, 1, 1), D(2024, 1, 1))],
               chat_insights=[("acct_a", "a", "chat", D(2024, 1, 1), float("nan"), None),
                              ("acct_a", "b", "chat", D(2024, 1, 1), 10.0, None)])
    got = {r["ticket_id"]: (r["response_time_first"], r["daily"], r["team_monthly"])
           for r in frt.frt_chat_flex(t, DEFAULT).collect()}
    assert got == {"a": (None, 10.0, 10.0), "b": (10.0, 10.0, 10.0)}


def _wait_inputs(spark, end_date):
    cfg = dataclasses.replace(DEFAULT, wait_time_floor=D(2021, 1, 1))
    t = tables(spark,
               call_tickets=[upd("k1", "voice", "5", D(2021, 12, 31), D(2022, 1, 2)) + ("inbound",),
                             upd("k2", "voice", "5", D(2022, 1, 5), D(2022, 1, 6)) + ("inbound",)],
               call_legs=[("acct_a", "k1", "Agent", "x", "01:00", D(2021, 12, 31), "10:00:00"),
                          ("acct_a", "k2", "Agent", "x", "03:00", D(2022, 1, 5), "10:00:00")],
               subteams=[("5", "Eve", "eve@x", "EMEA", D(2021, 1, 1), end_date, True)])
    return t, cfg


def test_h10_open_validity_end_never_matches(spark):
    t, cfg = _wait_inputs(spark, None)
    got = sorted((r["ticket_id"], r["client_account"], r["agent_name"], r["dur"])
                 for r in wait.wait_time_multi_grain(t, cfg).collect())
    assert got == [("k1", None, None, 60), ("k2", None, None, 180)]


def test_h3_capped_order_uses_text_dates(spark):
    t, cfg = _wait_inputs(spark, D(2022, 12, 31))
    text = wait.wait_time_multi_grain(t, cfg, cap=1, text_date_order=True).collect()
    real = wait.wait_time_multi_grain(t, cfg, cap=1).collect()
    assert [r["local_date_created"] for r in text] == ["12/31/2021"]   # '12/...' > '01/...' as text
    assert [r["local_date_created"] for r in real] == ["01/05/2022"]


def test_h6_zero_hours_give_null_rate(spark):
    cfg = DEFAULT
    t = tables(spark,
               agent_roster=[("acct_a", "1", "Ann", "ann@x")],
               email_tickets=[upd("e1", "email", "1", D(2024, 1, 2), D(2024, 1, 3))],
               manual_time=[(D(2024, 1, 3), "Ann", "Ann", 0, 0)])
    got = [(r["agent_name"], r["prod_tics"], r["dur_hr"], r["prod"], r["team_prod"])
           for r in productivity.productivity_weekly(t, cfg).collect()]
    assert got == [("Ann", 1, 0.0, None, None)]


def test_h7_supervisor_change_within_hour_fans_out(spark):
    from deskpulse.plans import productivity as p
    t = tables(spark,
               agent_roster=[("acct_a", "1", "Ann", "ann@x")],
               email_tickets=[upd("e1", "email", "1", D(2024, 1, 1), D(2024, 1, 2))],
               subteams=[("1", "Ann", "ann@x", "EMEA", D(2023, 1, 1), D(2025, 1, 1), True)],
               tracked_time=[("Division A", "Division A", "Division A", "Service Delivery", "Ann", "ann@x", sup,
                              "Ticket Active", D(2024, 1, 1), "10:00:00", 1800, True) for sup in ("S1", "S2")])
    got = sorted((r["supervisor"], r["h_tickets"], r["h_dur"], r["d_tickets"], r["h_prod"])
                 for r in p.productivity_hourly(t, DEFAULT).collect())
    # two rows (one per supervisor); the day total sums both, as the report does
    assert got == [("S1", 1, 3600, 2, 1.0), ("S2", 1, 3600, 2, 1.0)]


def test_h2_first_update_ties_are_kept(spark):
    from deskpulse.plans import csat
    cfg = dataclasses.replace(DEFAULT, csat_floor=D(2020, 1, 1))
    rows = [upd("r1", "email", "1", D(2024, 1, 1), D(2024, 1, 2), score="good"),
            upd("r1", "email", "1", D(2024, 1, 1), D(2024, 1, 2), score="bad"),
            upd("r1", "email", "1", D(2024, 1, 1), D(2024, 1, 5), score="good")]
    t = tables(spark, email_tickets=rows,
               subteams=[("1", "Ann", "ann@x", "EMEA", D(2023, 1, 1), D(2025, 1, 1), True)])
    got = sorted(r["satisfaction_rating_score"] for r in csat.csat_raw(t, cfg).collect())
    assert got == ["bad", "good"]
