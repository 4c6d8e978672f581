"""Productivity reports (R1 hourly, R2 weekly core, R3 weekly flex).

Tickets are counted per channel with channel-specific rules (C7, see the
table below), then divided by tracked hours (C8) or manual hours (C9).

=======  ==========================================  ==================  ============
channel  source and filter                           de-duplication      roster join
=======  ==========================================  ==================  ============
voice    call legs not to voicemail x call tickets   hourly: distinct    inner
chat     chat tickets with a non-abandoned session   latest per day      inner, first
email    email tickets of channel 'email'            latest per day      after (H1)
web      web tickets                                 latest per day      after (H1)
api      email tickets of channel 'api'              latest per day      inner, first
=======  ==========================================  ==================  ============

The hourly report also keeps only solved/closed email and web tickets,
judged on the latest update.  Ticket counts come from grouped
aggregation (partial aggregation before every shuffle); the per-agent and
per-team totals are roll-ups of those small tables (A2, A4).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskpulse.config import DEFAULT, ReportConfig
from deskpulse.constants import DONE_STATUSES, VOICEMAIL
from deskpulse.functions import (
    hour_of_time_text, like_any, month_start, rate_or_count, round2, seconds_of_day, true_divide, us_date, week_start,
)
from deskpulse.operators import (
    attach_grains, day_intervals, grain_table, in_effect, latest_per_key, null_safe_join, validity_join,
)
from deskpulse.plans.common import PERIODS, lit_like, roster, top_k
from deskpulse.plans.shared import shared



def _agents(t, account: str | None) -> DataFrame:
    return roster(t, account).select("_rid", "agent_name")


def channel_rows(t, cfg: ReportConfig, account: str | None, hourly: bool) -> DataFrame:
    """C7 step 1: the ticket rows that count, with their channel.

    Hourly rows are distinct (channel, local_date_created, local_time_created,
    ticket_id, assignee_id, agent_name); weekly rows are distinct (channel,
    local_date_created, ticket_id, agent_name), except voice, whose weekly
    count counts every matching call leg.  Email tickets are read once for
    their two channels.
    """
    agents = _agents(t, account)
    acct = F.col("client_account") == cfg.account
    cols = (["local_date_created", "local_time_created", "ticket_id", "assignee_id", "agent_name"] if hourly
            else ["local_date_created", "ticket_id", "agent_name"])
    cols = ["channel", *cols]
    upd = ["ticket_id", "local_date_created", "local_time_created", "assignee_id", "status", "date_updated"]
    per_day = ["ticket_id", "local_date_created"]
    on_roster = F.col("assignee_id") == F.col("_rid")
    done = F.col("status").isin(*DONE_STATUSES) if hourly else F.lit(True)

    calls = t.call_tickets
    if hourly:
        calls = calls.where(F.col("channel") == "voice")
    calls = calls.select(F.col("ticket_id").alias("_call"), F.col("local_date_created").alias("_call_day"),
                         "assignee_id").distinct()
    legs = (t.call_legs.where(acct & F.col("ticket_id").isNotNull() & (F.col("forwarded_to") != VOICEMAIL))
             .select("ticket_id", F.col("local_date").alias("local_date_created"),
                     F.col("local_time").alias("local_time_created"), F.lit("voice").alias("channel")))
    voice = legs.join(calls, F.col("ticket_id") == F.col("_call")).join(agents, on_roster).select(*cols)
    if hourly:
        voice = voice.distinct()

    sessions = (t.chat_insights.where(acct & F.col("abandon_time").isNull())
                 .select(F.col("ticket_id").alias("_iid")))
    chat = (t.chat_tickets.where(acct).select(*upd, F.lit("chat").alias("channel"))
             .join(agents, on_roster).join(sessions, F.col("ticket_id") == F.col("_iid"), "left_semi"))
    chat = latest_per_key(chat, per_day, "date_updated").select(*cols).distinct()

    web = latest_per_key(t.web_tickets.where(acct).select(*upd, F.lit("web").alias("channel")), per_day, "date_updated")
    web = web.where(done).join(agents, on_roster).where(F.col("agent_name").isNotNull()).select(*cols).distinct()

    # api: the roster decides before the latest update is chosen; email: after it (H1)
    mail = t.email_tickets.where(acct & F.col("channel").isin("email", "api")).select(*upd, "channel")
    mail = mail.join(agents, on_roster, "left").where((F.col("channel") == "email") | F.col("_rid").isNotNull())
    mail = latest_per_key(mail, ["channel", *per_day], "date_updated")
    mail = mail.where((F.col("channel") == "api") | (F.col("agent_name").isNotNull() & done)).select(*cols).distinct()
    return reduce(DataFrame.unionByName, [voice, chat, web, mail])


def hourly_counts(rows: DataFrame) -> DataFrame:
    """Distinct (channel, day, hour, assignee, agent) with h_tickets = tickets
    of the agent in that hour and channel (over all of the agent's ids)."""
    r = rows.withColumn("hour_", hour_of_time_text("local_time_created"))
    keys = ["channel", "local_date_created", "hour_", "agent_name"]
    n = r.groupBy(*keys, "assignee_id").agg(F.count("ticket_id").alias("_n"))
    # a window partition holds the ids of one agent in one hour and channel, already counted
    return (n.withColumn("h_tickets", F.sum("_n").over(Window.partitionBy(*keys)))
            .select("local_date_created", "hour_", "assignee_id", "agent_name", "channel", "h_tickets"))


def weekly_counts(rows: DataFrame) -> DataFrame:
    """Per (channel, week, agent): tickets; per channel and week: team_tickets."""
    r = rows.withColumn("_week", week_start("local_date_created"))
    a = r.groupBy("channel", "_week", "agent_name").agg(F.count("ticket_id").alias("tickets"))
    team = a.groupBy("channel", "_week").agg(F.sum("tickets").alias("team_tickets"))
    return (null_safe_join(a, team, ["channel", "_week"])
            .select(F.col("_week").alias("local_date_created"), "agent_name", "channel", "tickets", "team_tickets"))


def channel_counts_hourly(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """C7 hourly: agent x hour x channel ticket counts, all rosters."""
    return shared(t, "channel_counts_hourly", cfg, lambda: hourly_counts(channel_rows(t, cfg, None, hourly=True)))


def channel_counts_weekly(t, cfg: ReportConfig = DEFAULT, account: str | None = None) -> DataFrame:
    """C7 weekly: agent x week x channel ticket counts and team totals."""
    account = account or cfg.roster_account
    return shared(t, f"channel_counts_weekly_{account}", cfg,
                  lambda: weekly_counts(channel_rows(t, cfg, account, hourly=False)))


def tracked_hours(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Billable ticket-work seconds per hour/day/week/month and agent,
    one row per (day, hour, agent, supervisor) that has an entry."""
    return shared(t, "tracked_hours", cfg, lambda: _tracked_hours(t, cfg))


def _work_entries(t, cfg: ReportConfig) -> DataFrame:
    return t.tracked_time.where((F.col("division_account") == cfg.tracked_division) & F.col("is_billable")
                                & like_any("activity", cfg.activity_patterns))


def _tracked_rows(t, cfg: ReportConfig) -> DataFrame:
    return _work_entries(t, cfg).select(F.lit("tracked").alias("_tag"), F.col("agent_name").alias("_who"), F.col("start_date").alias("_day"),
                    hour_of_time_text("start_time").alias("_hour"), F.col("supervisor").alias("_with"), "duration_seconds")


def _manual_rows(t) -> DataFrame:
    """Manual seconds belong to the alias; the name only labels the result."""
    return t.manual_time.select(F.lit("manual").alias("_tag"), F.col("agent_alias").alias("_who"), F.col("date").alias("_day"),
                                F.lit(None).cast("bigint").alias("_hour"), F.col("agent_name").alias("_with"), "duration_seconds")


def hours_cube(rows: DataFrame) -> DataFrame:
    """Seconds per hour, day, week and month of tagged rows (C8 tracked, C9 manual), by one set of grouping sets:
    one row per (tag, who, day, hour, with) and the four totals of (tag, who)."""
    rows = rows.withColumn("_week", week_start("_day")).withColumn("_month", month_start("_day"))
    return grain_table(rows, "duration_seconds", {
        "h_dur": ["_tag", "_who", "_day", "_hour"], "d_dur": ["_tag", "_who", "_day"],
        "w_dur": ["_tag", "_who", "_week"], "m_dur": ["_tag", "_who", "_month"]}, fn="sum", extra_keys=["_with"],
        anchor="_who", implied={"_week": "_day", "_month": "_day"})


def _tracked_hours(t, cfg: ReportConfig) -> DataFrame:
    return hours_cube(_tracked_rows(t, cfg)).select(
        F.col("_day").alias("start_date_"), F.col("_hour").alias("hour_au"), F.col("_who").alias("agent_au"),
        F.col("_with").alias("supervisor"), "h_dur", "d_dur", "w_dur", "m_dur")


def manual_hours(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Manually logged seconds per day/week/month, summed per alias and
    reported under the agent name (the alias when the name is missing)."""
    return shared(t, "manual_hours", cfg, lambda: _manual_hours(t, cfg))


def _manual_hours(t, cfg: ReportConfig) -> DataFrame:
    return hours_cube(_manual_rows(t)).select(
        F.col("_day").alias("date"), F.coalesce("_with", "_who").alias("agent_manual"),
        F.col("d_dur").alias("d_dur_manual"), F.col("w_dur").alias("w_dur_manual"), F.col("m_dur").alias("m_dur_manual")).distinct()


def agent_days(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Tracked and manual hours side by side (drill-across): one row per (day, agent) with the lists ``tracked``
    (hour, supervisor and the four totals) and ``manual`` (three totals, distinct).

    Both come out of one cube over the union of their rows; a list holds what one agent has on one day."""
    return shared(t, "agent_days", cfg, lambda: _agent_days(t, cfg))


def _agent_days(t, cfg: ReportConfig) -> DataFrame:
    cube = hours_cube(_tracked_rows(t, cfg).unionByName(_manual_rows(t)))
    tracked = F.col("_tag") == "tracked"
    agent = F.when(tracked, F.col("_who")).otherwise(F.coalesce("_with", "_who"))
    entry = F.struct(F.col("_hour").alias("hour"), F.col("_with").alias("supervisor"), "h_dur", "d_dur", "w_dur", "m_dur")
    totals = F.struct(F.col("d_dur").alias("d_dur_manual"), F.col("w_dur").alias("w_dur_manual"), F.col("m_dur").alias("m_dur_manual"))
    return (cube.select(F.col("_day").alias("_aday"), agent.alias("_agent"), F.when(tracked, entry).alias("tracked"),
                        F.when(~tracked, totals).alias("manual"))
            .where(F.col("_aday").isNotNull() & F.col("_agent").isNotNull())
            .groupBy("_aday", "_agent")
            .agg(F.collect_list("tracked").alias("tracked"), F.collect_set("manual").alias("manual")))


HOURLY_COLS = ["local_date_created", "hour_", "assignee_id", "agent_name", "supervisor", "subteam",
               "is_core_team", "channel", "h_tickets", "h_dur", "d_dur", "w_dur", "m_dur", "d_dur_manual",
               "w_dur_manual", "m_dur_manual", "d_tickets", "w_tickets", "m_tickets", "h_prod", "d_prod",
               "w_prod", "m_prod"]


def _on_duty(t, rows: DataFrame) -> DataFrame:
    team = t.subteams.select(F.col("zendesk_id").alias("_zid"), "agent_name", "subteam", "is_core_team",
                             F.col("start_date").alias("_start"), F.col("end_date").alias("_end"))
    return validity_join(rows, team, "assignee_id", "_zid", "local_date_created", "_start", "_end", "inner")


def _with_agent_days(t, cfg: ReportConfig, x: DataFrame) -> DataFrame:
    return x.join(agent_days(t, cfg), (F.col("local_date_created") == F.col("_aday")) & (F.col("agent_name") == F.col("_agent")), "left")


def tickets_by_supervisor(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Tickets per agent, hour, channel and the supervisor of the agent's ticket work when each came in (the day's
    runs of tracked time, ``operators.intraday``; NULL on days without any).  Each ticket of a channel counts once
    per subteam record that is valid on its day."""
    rows = (channel_rows(t, cfg, None, hourly=True)
            .select("channel", "local_date_created", "local_time_created", "ticket_id", "assignee_id").distinct())
    x = (_on_duty(t, rows).select("channel", "local_date_created", "local_time_created", "ticket_id", "assignee_id",
                                  "agent_name", "subteam", "is_core_team").distinct()
         .withColumn("_at", seconds_of_day("local_time_created")))
    entries = _work_entries(t, cfg).select("agent_name", "start_date", "supervisor", seconds_of_day("start_time").alias("_began"))
    runs = day_intervals(entries, ["agent_name", "start_date"], "_began", "supervisor")
    x = in_effect(x, runs, ["agent_name", "local_date_created"], "_at", ["agent_name", "start_date"], "supervisor")
    return (x.groupBy("local_date_created", hour_of_time_text("local_time_created").alias("hour_"), "assignee_id",
                      "agent_name", "supervisor", "subteam", "is_core_team", "channel")
             .agg(F.count("ticket_id").alias("h_tickets")))


PERIOD_TICKETS = {"d_tickets": ["local_date_created", "agent_name"], "w_tickets": ["_week", "agent_name"],
                  "m_tickets": ["_month", "agent_name"]}


def productivity_hourly_one_supervisor(t, cfg: ReportConfig = DEFAULT, cap: int | None = None,
                                       ordered: bool = False) -> DataFrame:
    """R1 without the supervisor fan-out (H7): a ticket belongs to the supervisor in effect when it came in.

    Columns are R1's.  ``h_tickets`` counts the row's own tickets, so the rows of an hour add up to its tickets, and
    the day, week and month totals count every ticket once.  Hours stay the agent's; a day's manual totals still give
    a row per alias (H9), after the totals."""
    x = tickets_by_supervisor(t, cfg)
    x = x.withColumn("_week", week_start("local_date_created")).withColumn("_month", month_start("local_date_created"))
    x = _with_agent_days(t, cfg, attach_grains(x, "h_tickets", PERIOD_TICKETS, fn="sum", anchor="agent_name", implied=PERIODS))
    # an hour's entries differ by supervisor only, their totals are the agent's
    x = x.withColumn("_au", F.get(F.filter("tracked", lambda e: e["hour"] == F.col("hour_")), F.lit(0)))
    x = x.withColumn("_man", F.explode_outer("manual"))
    return _hourly_out(x.select(
        "local_date_created", "hour_", "assignee_id", "agent_name", "supervisor", "subteam", "is_core_team", "channel",
        "h_tickets", "_au.h_dur", "_au.d_dur", "_au.w_dur", "_au.m_dur", "_man.d_dur_manual", "_man.w_dur_manual",
        "_man.m_dur_manual", *PERIOD_TICKETS), cap, ordered)


def productivity_hourly(t, cfg: ReportConfig = DEFAULT, cap: int | None = None, ordered: bool = False) -> DataFrame:
    """Tickets per agent, hour and channel with tracked and manual hours
    and hour/day/week/month productivity."""
    raw = channel_counts_hourly(t, cfg).withColumnRenamed("agent_name", "_roster_agent")
    # one join brings both kinds of hours; each ticket row meets every supervisor of its hour (H7) and every
    # manual entry of its day (H9), or a row of NULLs
    x = _with_agent_days(t, cfg, _on_duty(t, raw))
    x = x.withColumn("_au", F.explode_outer(F.filter("tracked", lambda e: e["hour"] == F.col("hour_"))))
    x = x.withColumn("_man", F.explode_outer("manual"))
    x = x.select("local_date_created", "hour_", "assignee_id", "agent_name", "_au.supervisor", "subteam",
                 "is_core_team", "channel", "h_tickets", "_au.h_dur", "_au.d_dur", "_au.w_dur", "_au.m_dur",
                 "_man.d_dur_manual", "_man.w_dur_manual", "_man.m_dur_manual").distinct()
    x = x.withColumn("_week", week_start("local_date_created")).withColumn("_month", month_start("local_date_created"))
    return _hourly_out(attach_grains(x, "h_tickets", PERIOD_TICKETS, fn="sum", anchor="agent_name", implied=PERIODS), cap, ordered)


def _hourly_out(x: DataFrame, cap: int | None, ordered: bool) -> DataFrame:
    h_prod = F.when(F.col("h_dur").isNotNull(), true_divide("h_tickets", F.col("h_dur") / 3600.0)) \
              .otherwise(F.col("h_tickets").cast("double"))
    out = x.select(
        us_date("local_date_created").alias("local_date_created"), "hour_", "assignee_id", "agent_name",
        "supervisor", "subteam", "is_core_team", "channel", "h_tickets", "h_dur", "d_dur", "w_dur", "m_dur",
        "d_dur_manual", "w_dur_manual", "m_dur_manual", "d_tickets", "w_tickets", "m_tickets",
        round2(h_prod).alias("h_prod"),
        round2(rate_or_count("d_tickets", "d_dur", "d_dur_manual")).alias("d_prod"),
        round2(rate_or_count("w_tickets", "w_dur", "w_dur_manual")).alias("w_prod"),
        round2(rate_or_count("m_tickets", "m_dur", "m_dur_manual")).alias("m_prod"),
        F.col("local_date_created").alias("_day"))
    return top_k(out, [("_day", "desc"), ("hour_", "desc"), ("agent_name", "asc")],
                 cap, HOURLY_COLS, ordered)


WEEKLY_COLS = ["local_date_created", "agent_name", "prod_tics", "team_tics", "active_hr", "team_hr_au",
               "dur_hr", "team_hr", "prod", "team_prod"]


def _rate_first_non_null(tickets, first_hours, second_hours):
    """C11: tickets / first hours if known, else / second hours if known,
    else the ticket count (no zero guard in the report; 0 hours give NULL)."""
    t = F.col(tickets).cast("double")
    return (F.when(F.col(first_hours).isNotNull(), true_divide(tickets, first_hours))
             .when(F.col(second_hours).isNotNull(), true_divide(tickets, second_hours))
             .otherwise(t))


def productivity_weekly(t, cfg: ReportConfig = DEFAULT, ordered: bool = False) -> DataFrame:
    """R2: weekly tickets per core agent over tracked (else manual) hours,
    with team totals."""
    raw = channel_counts_weekly(t, cfg, cfg.roster_account)
    pt = raw.groupBy("local_date_created", "agent_name").agg(F.sum("tickets").alias("prod_tics"))
    emails = roster(t, cfg.roster_account).select(F.col("agent_email").alias("_sar_email"))
    u = t.tracked_time.where((F.col("client_account") == cfg.tracked_division)
                             & (F.col("function") == cfg.tracked_function))
    act = (u.join(emails, F.col("agent_email") == F.col("_sar_email"))
            .groupBy(week_start("start_date").alias("_aweek"), F.col("agent_name").alias("_aagent"))
            .agg(F.sum("duration_seconds").alias("active_s")))
    man = (t.manual_time.groupBy(week_start("date").alias("_mweek"), F.col("agent_name").alias("_mname"))
            .agg(F.sum("duration_minutes").alias("dur_min")))
    x = pt.where(F.col("local_date_created") >= lit_like(pt, "local_date_created", cfg.weekly_floor))
    x = x.join(act, (F.col("local_date_created") == F.col("_aweek")) & (F.col("agent_name") == F.col("_aagent")), "left")
    x = x.join(man, (F.col("local_date_created") == F.col("_mweek")) & (F.col("agent_name") == F.col("_mname")), "left")
    x = x.withColumn("active_hr", F.col("active_s") / 3600.0).withColumn("dur_hr", F.col("dur_min") / 60.0)
    x = x.withColumn("prod", _rate_first_non_null("prod_tics", "active_hr", "dur_hr"))
    team = (x.groupBy("local_date_created")
             .agg(F.sum("prod_tics").alias("team_tics"), (F.sum("active_s") / 3600.0).alias("team_hr_au"),
                  (F.sum("dur_min") / 60.0).alias("team_hr")))
    x = null_safe_join(x, team, ["local_date_created"])
    x = x.withColumn("team_prod", _rate_first_non_null("team_tics", "team_hr_au", "team_hr"))
    out = x.select(us_date("local_date_created").alias("local_date_created"), *WEEKLY_COLS[1:],
                   F.col("local_date_created").alias("_day"))
    return top_k(out, [("_day", "desc")], None, WEEKLY_COLS, ordered)


FLEX_COLS = ["local_date_created", "agent_name", "channel", "tickets", "prod_tics", "team_prod", "flex_prod_w",
             "team_prod_w", "prod_tics_m", "team_prod_m", "month_date", "flex_prod_m", "team_flex_prod_m"]


def productivity_flex(t, cfg: ReportConfig = DEFAULT, ordered: bool = False) -> DataFrame:
    """Weekly tickets per flex agent and channel against standard hours
    (per week, and per month of the week's Monday, H12)."""
    raw = channel_counts_weekly(t, cfg, cfg.flex_roster_account)
    raw = raw.withColumn("_month", month_start("local_date_created"))
    g = attach_grains(raw, "tickets", {"prod_tics": ["local_date_created", "agent_name"],
                                       "team_prod": ["local_date_created"],
                                       "prod_tics_m": ["_month", "agent_name"],
                                       "team_prod_m": ["_month"]}, fn="sum")
    wh, mh = float(cfg.week_hours), float(cfg.month_hours)
    out = g.select(
        us_date("local_date_created").alias("local_date_created"), "agent_name", "channel", "tickets",
        "prod_tics", "team_prod", (F.col("prod_tics") / wh).alias("flex_prod_w"),
        (F.col("team_prod") / wh).alias("team_prod_w"), "prod_tics_m", "team_prod_m",
        us_date("_month").alias("month_date"), (F.col("prod_tics_m") / mh).alias("flex_prod_m"),
        (F.col("team_prod_m") / mh).alias("team_flex_prod_m"), F.col("local_date_created").alias("_day"))
    return top_k(out, [("_day", "desc")], None, FLEX_COLS, ordered)
