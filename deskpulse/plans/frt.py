"""First-response-time reports.

Shape shared by all of them: pick each ticket's first or latest update
(C1/C2, ties kept), attach the agent (roster, team validity interval or HR
as-of record), keep rows by the agent/date rules, then attach averages of
the response time at several grains (C6).

Filter order follows the reports exactly (H1): filters written next to
the first/latest choice run before it, agent and date rules after it.
Left joins that only add columns commute with the choice, so they run
after it, on one row per ticket instead of one per update.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.config import DEFAULT, ReportConfig
from deskpulse.constants import CHAT_SESSION_TYPE, DONE_STATUSES
from deskpulse.functions import (
    days_between, full_name, hour_of_time_text, month_start, nan_to_null, num_text,
    round_avg_text, us_date, week_start,
)
from deskpulse.operators import (
    asof_nearest, attach_grains, first_per_key, grain_table, latest_per_key, null_safe_join, validity_join,
)
from deskpulse.plans.common import lit_like, roster, top_k
from deskpulse.plans.shared import shared



def _with_periods(df: DataFrame, date_col: str = "local_date_created") -> DataFrame:
    return df.withColumn("_week", week_start(date_col)).withColumn("_month", month_start(date_col))


def _first_update(t, cfg: ReportConfig, source: str, channel: str) -> DataFrame:
    """Solved/closed tickets of one channel, only each ticket's update(s)
    with the smallest creation-to-update lag (shared by R7/R9/R8/R15)."""
    def build():
        tickets = getattr(t, source)
        tk = (tickets.where((F.col("client_account") == cfg.account) & F.col("status").isin(*DONE_STATUSES)
                            & (F.col("channel") == channel))
                     .select("ticket_id", "local_date_created", "local_time_created", "date_updated",
                             "assignee_id", F.col("channel").alias("_ticket_channel"))
                     .withColumn("recent_", days_between("date_updated", "local_date_created")))
        return first_per_key(tk, ["ticket_id"], "recent_")
    return shared(t, f"first_update_{source}_{channel}", cfg, build)


# --------------------------------------------------------------------- R7, R9
MULTI_GRAIN_COLS = ["subteam", "ticket_id", "local_date_created", "hour_", "channel", "assignee_id",
                    "email_address", "agent_name", "frt_calendar", "hourly", "t_hourly", "daily",
                    "t_daily", "weekly", "t_weekly", "monthly", "t_monthly"]
TEAM_GRAINS = {
    "hourly": ["agent_name", "local_date_created", "hour_"],
    "t_hourly": ["local_date_created", "hour_", "subteam"],
    "daily": ["agent_name", "local_date_created"],
    "t_daily": ["local_date_created", "subteam"],
    "weekly": ["agent_name", "_week"],
    "t_weekly": ["subteam", "_week"],
    "monthly": ["agent_name", "_month"],
    "t_monthly": ["subteam", "_month"],
}


def frt_multi_grain(t, cfg: ReportConfig = DEFAULT, channel: str = "chat", cap: int | None = None,
                    ordered: bool = False) -> DataFrame:
    """R7 (chat) / R9 (email): first response per solved ticket with its core
    subteam on the creation date, averaged at hour/day/week/month grain per
    agent and per subteam."""
    if channel == "chat":
        source = "chat_tickets"
        metric = t.chat_insights.select(F.col("ticket_id").alias("_mid"),
                                        F.col("response_time_first").alias("frt_calendar"))
    else:
        source = "email_tickets"
        metric = t.email_metrics.select(F.col("ticket_id").alias("_mid"),
                                        F.col("reply_time_calendar_minutes").alias("frt_calendar"))
    metric = metric.withColumn("channel", F.lit(channel))
    team = (t.subteams.where(F.col("is_core_team"))
             .select("subteam", F.col("zendesk_id").alias("_zid"), "agent_name",
                     F.col("agent_email").alias("email_address"),
                     F.col("start_date").alias("_start"), F.col("end_date").alias("_end")))
    x = _first_update(t, cfg, source, channel)
    x = validity_join(x, team, "assignee_id", "_zid", "local_date_created", "_start", "_end", "left")
    x = x.join(metric, F.col("ticket_id") == F.col("_mid"), "left")
    x = x.where(F.col("agent_name").isNotNull()
                & (F.col("local_date_created") >= lit_like(x, "local_date_created", cfg.frt_floor)))
    rows = x.select("subteam", "ticket_id", "local_date_created",
                    hour_of_time_text("local_time_created").alias("hour_"), "channel",
                    F.col("_zid").alias("assignee_id"), "email_address", "agent_name",
                    "frt_calendar").distinct()
    g = attach_grains(_with_periods(rows), "frt_calendar", TEAM_GRAINS)
    out = g.select(
        "subteam", "ticket_id", us_date("local_date_created").alias("local_date_created"), "hour_",
        "channel", "assignee_id", "email_address", "agent_name",
        num_text("frt_calendar").alias("frt_calendar"),
        *[round_avg_text(n, cfg.half_even_means).alias(n) for n in TEAM_GRAINS],
        F.col("local_date_created").alias("_day"))
    return top_k(out, [("_day", "desc"), ("hour_", "desc"), ("agent_name", "asc")],
                 cap, MULTI_GRAIN_COLS, ordered)


# ------------------------------------------------------------------------ R8
KPI_COLS = ["ticket_id", "local_date_created", "channel", "assignee_id", "email_address", "agent_name",
            "frt_calendar", "daily", "weekly", "monthly"]
AGENT_GRAINS = {"daily": ["agent_name", "local_date_created"], "weekly": ["agent_name", "_week"],
                "monthly": ["agent_name", "_month"]}


def frt_email_kpi(t, cfg: ReportConfig = DEFAULT, cap: int | None = None, ordered: bool = False) -> DataFrame:
    """First response of solved email tickets from the KPI summary, per
    rostered agent, with day/week/month agent averages."""
    r = roster(t, cfg.roster_account)
    # The summary joins on ticket and on its agent name being non-NULL.
    kpi = (t.kpi_summary.where(F.col("agent_name").isNotNull())
            .select(F.col("ticket_id").alias("_kid"), "frt_calendar", "channel").distinct())
    x = _first_update(t, cfg, "email_tickets", "email")
    x = x.join(r, F.col("assignee_id") == F.col("_rid"), "left")
    x = x.join(kpi, F.col("ticket_id") == F.col("_kid"), "left")
    x = x.where(F.col("agent_name").isNotNull()
                & (F.col("local_date_created") >= lit_like(x, "local_date_created", cfg.frt_floor)))
    rows = x.select("ticket_id", "local_date_created", "channel", F.col("_rid").alias("assignee_id"),
                    F.col("agent_email").alias("email_address"), "agent_name", "frt_calendar").distinct()
    g = attach_grains(_with_periods(rows), "frt_calendar", AGENT_GRAINS)
    out = g.select(
        "ticket_id", us_date("local_date_created").alias("local_date_created"), "channel", "assignee_id",
        "email_address", "agent_name", num_text("frt_calendar").alias("frt_calendar"),
        *[round_avg_text(n, cfg.half_even_means).alias(n) for n in AGENT_GRAINS],
        F.col("local_date_created").alias("_day"))
    return top_k(out, [("_day", "desc"), ("agent_name", "asc")], cap, KPI_COLS, ordered)


# ----------------------------------------------------------------------- R15
FLEX_EMAIL_COLS = ["ticket_id", "local_date_created", "channel", "assignee_id", "email_address",
                   "agent_name", "frt_calendar", "daily", "team_daily", "weekly", "team_weekly",
                   "monthly", "team_monthly"]
FLEX_GRAINS = {"daily": ["agent_name", "local_date_created"], "team_daily": ["local_date_created"],
               "weekly": ["agent_name", "_week"], "team_weekly": ["_week"],
               "monthly": ["agent_name", "_month"], "team_monthly": ["_month"]}


def frt_email_flex(t, cfg: ReportConfig = DEFAULT, cap: int | None = None, ordered: bool = False) -> DataFrame:
    """First reply time of solved email tickets of flex agents, with
    agent and team averages per day/week/month."""
    r = roster(t, cfg.flex_roster_account)
    m = (t.email_metrics.select(F.col("ticket_id").alias("_mid"),
                                F.col("reply_time_calendar_minutes").alias("frt_calendar")).distinct())
    x = _first_update(t, cfg, "email_tickets", "email")
    x = x.join(r, F.col("assignee_id") == F.col("_rid"), "left")
    x = x.join(m, F.col("ticket_id") == F.col("_mid"), "left")
    x = x.where(F.col("agent_name").isNotNull())
    rows = x.select("ticket_id", "local_date_created", F.col("_ticket_channel").alias("channel"),
                    F.col("_rid").alias("assignee_id"), F.col("agent_email").alias("email_address"),
                    "agent_name", "frt_calendar").distinct()
    g = attach_grains(_with_periods(rows), "frt_calendar", FLEX_GRAINS)
    out = g.select(
        "ticket_id", us_date("local_date_created").alias("local_date_created"), "channel", "assignee_id",
        "email_address", "agent_name", num_text("frt_calendar").alias("frt_calendar"),
        *[round_avg_text(n, cfg.half_even_means).alias(n) for n in FLEX_GRAINS],
        F.col("local_date_created").alias("_day"))
    return top_k(out, [("_day", "desc"), ("agent_name", "asc")], cap, FLEX_EMAIL_COLS, ordered)


# ----------------------------------------------------------------------- R10
FLEX_CHAT_COLS = ["ticket_id", "local_date_created", "assignee_id", "agent_name", "agent_email",
                  "response_time_first", "daily", "team_daily", "week_date", "weekly", "team_weekly",
                  "month_date", "monthly", "team_monthly"]


def frt_chat_flex(t, cfg: ReportConfig = DEFAULT, ordered: bool = False) -> DataFrame:
    """Chat first response of flex agents on each ticket's latest
    update, NaN read as missing, with agent and team averages."""
    tk = (t.chat_tickets.where(F.col("client_account") == cfg.account)
           .select("ticket_id", "local_date_created", "date_updated", "assignee_id"))
    latest = latest_per_key(tk, ["ticket_id"], "date_updated")
    r = roster(t, cfg.flex_roster_account)
    ins = t.chat_insights.select(F.col("ticket_id").alias("_tid"), "response_time_first")
    x = (latest.join(r, F.col("assignee_id") == F.col("_rid"))
               .join(ins, F.col("ticket_id") == F.col("_tid")))
    rows = x.select("ticket_id", "local_date_created", "assignee_id", "agent_name", "agent_email",
                    nan_to_null("response_time_first").alias("response_time_first")).distinct()
    g = attach_grains(_with_periods(rows), "response_time_first", FLEX_GRAINS)
    out = g.select(
        "ticket_id", us_date("local_date_created").alias("local_date_created"), "assignee_id",
        "agent_name", "agent_email", "response_time_first",
        F.round("daily").alias("daily"), F.round("team_daily").alias("team_daily"),
        us_date("_week").alias("week_date"),
        F.round("weekly").alias("weekly"), F.round("team_weekly").alias("team_weekly"),
        us_date("_month").alias("month_date"),
        F.round("monthly").alias("monthly"), F.round("team_monthly").alias("team_monthly"),
        F.col("local_date_created").alias("_day"))
    return top_k(out, [("_day", "desc")], None, FLEX_CHAT_COLS, ordered)


# ------------------------------------------------------------------------ R6
ASOF_COLS = ["ticket_id", "local_date_created", "channel", "response_time_first", "email_address",
             "agent_name", "supervisor", "daily", "week_date", "weekly", "month_date", "monthly"]


def frt_chat_asof(t, cfg: ReportConfig = DEFAULT, cap: int | None = None, ordered: bool = False) -> DataFrame:
    """Chat first response per rostered agent, with the supervisor of the
    HR record in force on the day (nearest earlier job date, C4)."""
    ins = t.chat_insights.where((F.col("client_account") == cfg.account) & (F.col("type") == CHAT_SESSION_TYPE))
    a = (t.chat_tickets.where(F.col("client_account") == cfg.account)
          .select(F.col("ticket_id").alias("_aid"), "assignee_id").distinct())
    r = roster(t, cfg.roster_account)
    x = (ins.join(a, F.col("ticket_id") == F.col("_aid"), "left")
            .join(r, F.col("assignee_id") == F.col("_rid"), "left"))
    rows = x.select("ticket_id", "assignee_id", "agent_name", F.col("agent_email").alias("email_address"),
                    F.col("type").alias("channel"), F.col("local_date").alias("local_date_created"),
                    "response_time_first").distinct()
    # the daily mean is over the rows before the as-of join; its keys pass the join, so it is attached after it
    daily = grain_table(rows, "response_time_first", {"daily": ["local_date_created", "agent_name"]})
    hr = (t.hr_roster.where(F.col("job_division") == cfg.hr_division)
           .select(full_name("first_name", "last_name").alias("full_name"),
                   F.col("job_supervisor").alias("supervisor"), "job_effectivity_date").distinct())
    x = asof_nearest(rows, hr, fact_key="agent_name", fact_date="local_date_created",
                     dim_key="full_name", dim_date="job_effectivity_date")
    x = x.select("ticket_id", "local_date_created", "channel", "assignee_id", "email_address",
                 "agent_name", "supervisor", "response_time_first").distinct()
    g = attach_grains(_with_periods(x), "response_time_first",
                      {"weekly": ["_week", "agent_name"], "monthly": ["_month", "agent_name"]})
    g = null_safe_join(g, daily, ["local_date_created", "agent_name"])
    out = g.select(
        "ticket_id", us_date("local_date_created").alias("local_date_created"), "channel",
        "response_time_first", F.lower("email_address").alias("email_address"), "agent_name",
        "supervisor", F.round("daily").alias("daily"), us_date("_week").alias("week_date"),
        F.round("weekly").alias("weekly"), us_date("_month").alias("month_date"),
        F.round("monthly").alias("monthly"), F.col("local_date_created").alias("_day"))
    return top_k(out, [("_day", "desc"), ("agent_name", "asc")], cap, ASOF_COLS, ordered)
