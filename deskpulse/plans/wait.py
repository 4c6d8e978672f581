"""Call wait-time reports (R4 with supervisors, R5 without).

Longest leg per ticket (C3) -> solved/closed inbound call tickets -> core
subteam valid on the creation date -> (R4) supervisor from tracked time,
else from the current HR record (C5, C15), else a default label -> date
floor -> averages of the wait at hour/day/week/month grain per agent,
subteam and supervisor (C6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.config import DEFAULT, ReportConfig
from deskpulse.constants import DONE_STATUSES, OUTBOUND
from deskpulse.functions import hour_of_time_text, month_start, round_avg_text, seconds_of_day, us_date, week_start
from deskpulse.operators import attach_grains, current_roster, day_intervals, in_effect, longest_wait, validity_join
from deskpulse.plans.common import lit_like, top_k
from deskpulse.plans.shared import shared

GRAINS = {
    "hourly": ["agent_name", "local_date_created", "hour_"],
    "t_hourly": ["local_date_created", "hour_", "subteam"],
    "v_hourly": ["supervisor", "subteam", "local_date_created", "hour_"],
    "daily": ["agent_name", "local_date_created"],
    "t_daily": ["local_date_created", "subteam"],
    "v_daily": ["supervisor", "local_date_created", "subteam"],
    "weekly": ["agent_name", "_week"],
    "t_weekly": ["subteam", "_week"],
    "v_weekly": ["supervisor", "subteam", "_week"],
    "monthly": ["agent_name", "_month"],
    "t_monthly": ["subteam", "_month"],
    "v_monthly": ["supervisor", "subteam", "_month"],
}
BASE_COLS = ["client_account", "local_date_created", "hour_", "ticket_id", "assignee_id", "email_address",
             "agent_name"]


def tracked_supervisors(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Distinct (day, supervisor, agent) of the division's tracked time
    (shared by R4 and the supervisor-resolution query)."""
    return shared(t, "tracked_supervisors", cfg, lambda: (
        t.tracked_time.where(F.col("division_name") == cfg.tracked_division)
         .select(F.col("start_date").alias("_sdate"), F.col("supervisor").alias("_util_sup"),
                 F.col("agent_name").alias("_agent")).distinct()))


def _led_by_the_days_supervisors(x: DataFrame, t, cfg: ReportConfig) -> DataFrame:
    """Every supervisor of the agent's day (a row each), and of the current HR record."""
    su = tracked_supervisors(t, cfg)
    x = x.join(su, (F.col("local_date_created") == F.col("_sdate")) & (F.col("_agent") == F.col("agent_name")),
               "left")
    cur = shared(t, "current_roster", cfg, lambda: current_roster(t.hr_roster, cfg.hr_division))
    return x.join(cur, F.col("agent_name") == F.col("full_name"), "left")


def _led_by_one_supervisor(x: DataFrame, t, cfg: ReportConfig) -> DataFrame:
    """The supervisor of the agent's tracked time when the ticket was created, and one (the first by name) of the
    current HR record: every row once."""
    entries = (t.tracked_time.where(F.col("division_name") == cfg.tracked_division)
                .select("agent_name", "start_date", seconds_of_day("start_time").alias("_began"),
                        F.col("supervisor").alias("_util_sup")))
    runs = day_intervals(entries, ["agent_name", "start_date"], "_began", "_util_sup")
    x = in_effect(x, runs, ["agent_name", "local_date_created"], "_at", ["agent_name", "start_date"], "_util_sup")
    cur = shared(t, "current_roster", cfg, lambda: current_roster(t.hr_roster, cfg.hr_division))
    cur = cur.groupBy("full_name").agg(F.min("job_supervisor").alias("job_supervisor"))
    return x.join(cur, F.col("agent_name") == F.col("full_name"), "left")


def wait_time(t, cfg: ReportConfig = DEFAULT, with_supervisor: bool = True, cap: int | None = None,
              ordered: bool = False, text_date_order: bool = False, one_supervisor: bool = False) -> DataFrame:
    """``text_date_order`` sorts by the formatted date (mm/dd/yyyy) before the cap, as
    the reports do (O2, H3); otherwise the real date is used.  ``one_supervisor``
    gives a ticket the supervisor in effect when it was created instead of a row
    for each supervisor of its agent's day (C15), so averages count it once."""
    legs = (shared(t, "longest_wait", cfg, lambda: longest_wait(t.call_legs, cfg.account, cfg.longest_wait_compare))
            .select(F.col("ticket_id").alias("_did"), "dur").distinct())
    calls = t.call_tickets.where((F.col("client_account") == cfg.account)
                               & (F.col("via_source_rel") != OUTBOUND)
                               & F.col("status").isin(*DONE_STATUSES))
    solved = (calls.join(legs, F.col("ticket_id") == F.col("_did"), "left")
             .select("ticket_id", "dur", "channel", "local_date_created",
                     hour_of_time_text("local_time_created").alias("hour_"), "assignee_id",
                     *([seconds_of_day("local_time_created").alias("_at")] if one_supervisor else []))
             .distinct())
    team = (t.subteams.where(F.col("is_core_team"))
             .select("subteam", F.col("zendesk_id").alias("_zid"), "agent_name", "agent_email",
                     F.col("start_date").alias("_start"), F.col("end_date").alias("_end")))
    x = validity_join(solved, team, "assignee_id", "_zid", "local_date_created", "_start", "_end", "left")
    x = x.where(F.col("local_date_created") >= lit_like(x, "local_date_created", cfg.wait_time_floor))
    if with_supervisor:
        x = (_led_by_one_supervisor if one_supervisor else _led_by_the_days_supervisors)(x, t, cfg)
        # tracked-time supervisor, else HR, else the default label (one DISTINCT
        # over the final projection equals the report's two nested ones)
        x = x.withColumn("supervisor", F.coalesce("_util_sup", "job_supervisor", F.lit(cfg.default_supervisor)))
        grains = GRAINS
    else:
        grains = {k: v for k, v in GRAINS.items() if not k.startswith("v_")}
    x = (x.select("subteam", "ticket_id", "local_date_created", "hour_", "channel", "assignee_id",
                  F.col("agent_email").alias("email_address"), "agent_name",
                  *(["supervisor"] if with_supervisor else []), "dur").distinct())
    x = x.withColumn("_week", week_start("local_date_created")).withColumn("_month", month_start("local_date_created"))
    g = attach_grains(x, "dur", grains)
    cols = BASE_COLS + (["supervisor"] if with_supervisor else []) + ["dur"] + list(grains)
    out = g.select(
        F.col("subteam").alias("client_account"), us_date("local_date_created").alias("local_date_created"),
        "hour_", "ticket_id", "assignee_id", "email_address", "agent_name",
        *(["supervisor"] if with_supervisor else []), "dur",
        *[round_avg_text(n, cfg.half_even_means).alias(n) for n in grains],
        F.col("local_date_created").alias("_day"))
    day = "local_date_created" if text_date_order else "_day"
    order = ([("client_account", "asc")] if with_supervisor else []) + [
        (day, "desc"), ("hour_", "desc"), ("agent_name", "asc")]
    return top_k(out, order, cap, cols, ordered)


def wait_time_supervisor(t, cfg: ReportConfig = DEFAULT, **how) -> DataFrame:
    """Wait time with supervisor grains (12 averages)."""
    return wait_time(t, cfg, with_supervisor=True, **how)


def wait_time_multi_grain(t, cfg: ReportConfig = DEFAULT, **how) -> DataFrame:
    """Wait time without supervisors (8 averages)."""
    return wait_time(t, cfg, with_supervisor=False, **how)
