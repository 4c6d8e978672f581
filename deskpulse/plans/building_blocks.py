"""Queries that exercise one composite operator each on whole tables
(C1-C6, C14, C15, J4, J5), next to the reports that use them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.config import DEFAULT, ReportConfig
from deskpulse.constants import RATINGS
from deskpulse.functions import days_between, month_start, numeric_id_text, round_avg_text, week_start
from deskpulse.operators import (
    asof_nearest, attach_grains, current_roster as _current_roster, exclude_ids,
    first_per_key, keep_extreme, latest_per_key, longest_wait as _longest_wait, validity_join,
)
from deskpulse.plans.common import PERIODS, roster
from deskpulse.plans.shared import shared
from deskpulse.sources.tables import TICKET_COLS


def all_updates(t, cfg: ReportConfig) -> DataFrame:
    """Updates of the four ticket tables for the account."""
    u = reduce(DataFrame.unionByName, [x.select(*TICKET_COLS) for x in
                                       (t.email_tickets, t.chat_tickets, t.call_tickets, t.web_tickets)])
    return u.where(F.col("client_account") == cfg.account)


def latest_update_per_ticket(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """C1 per ticket: the latest update(s) of every ticket."""
    x = all_updates(t, cfg).select("ticket_id", "channel", "date_updated", "assignee_id", "status")
    return latest_per_key(x, ["ticket_id"], "date_updated").distinct()


def latest_update_one_scan(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """C1 per ticket as ``latest_update_per_ticket``, by the extremes of bins: every source is read once."""
    x = all_updates(t, cfg).select("ticket_id", "channel", "date_updated", "assignee_id", "status")
    return keep_extreme(x, ["ticket_id"], "date_updated", method="bins").distinct()


def first_update_one_scan(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """C2 per ticket as ``first_update_per_ticket``, by the extremes of bins: every source is read once."""
    x = (all_updates(t, cfg).select("ticket_id", "local_date_created", "date_updated", "assignee_id")
         .withColumn("recent_", days_between("date_updated", "local_date_created")))
    return keep_extreme(x, ["ticket_id"], "recent_", largest=False, method="bins").distinct()


def latest_update_per_ticket_day(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """C1 per ticket and creation day."""
    x = all_updates(t, cfg).select("ticket_id", "local_date_created", "date_updated", "assignee_id")
    return latest_per_key(x, ["ticket_id", "local_date_created"], "date_updated").distinct()


def first_update_per_ticket(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """update(s) with the smallest creation-to-update lag per ticket."""
    x = (all_updates(t, cfg).select("ticket_id", "local_date_created", "date_updated", "assignee_id")
         .withColumn("recent_", days_between("date_updated", "local_date_created")))
    return first_per_key(x, ["ticket_id"], "recent_").distinct()


def longest_wait(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Longest call leg(s) per ticket, in seconds."""
    return shared(t, "longest_wait", cfg, lambda: _longest_wait(t.call_legs, cfg.account, cfg.longest_wait_compare))


def _team(t, core_only: bool) -> DataFrame:
    s = t.subteams.where(F.col("is_core_team")) if core_only else t.subteams
    return s.select("subteam", F.col("zendesk_id").alias("_zid"), "agent_name", "is_core_team",
                    F.col("start_date").alias("_start"), F.col("end_date").alias("_end"))


def scd2_team_left(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Every update with the core subteam valid on its creation date
    (NULL when none)."""
    x = all_updates(t, cfg).select("ticket_id", "date_updated", "assignee_id", "local_date_created")
    x = validity_join(x, _team(t, True), "assignee_id", "_zid", "local_date_created", "_start", "_end", "left")
    return x.select("ticket_id", "date_updated", "assignee_id", "local_date_created", "subteam", "agent_name")


def scd2_team_inner(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Tickets whose agent had a subteam record valid on the creation date."""
    x = all_updates(t, cfg).select("ticket_id", "assignee_id", "local_date_created")
    x = validity_join(x, _team(t, False), "assignee_id", "_zid", "local_date_created", "_start", "_end", "inner")
    return x.select("ticket_id", "local_date_created", "assignee_id", "subteam", "agent_name",
                    "is_core_team").distinct()


def asof_supervisor(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """C4: for each update's creation day and rostered agent, the HR
    supervisor(s) of the nearest job record at or before that day."""
    r = roster(t, cfg.roster_account)
    x = (all_updates(t, cfg).join(r, F.col("assignee_id") == F.col("_rid"))
         .select("ticket_id", "local_date_created", "agent_name").distinct())
    from deskpulse.functions import full_name
    hr = (t.hr_roster.where(F.col("job_division") == cfg.hr_division)
           .select(full_name("first_name", "last_name").alias("full_name"),
                   F.col("job_supervisor").alias("supervisor"), "job_effectivity_date").distinct())
    x = asof_nearest(x, hr, "agent_name", "local_date_created", "full_name", "job_effectivity_date")
    return x.select("ticket_id", "local_date_created", "agent_name", "supervisor", "job_effectivity_date")


def current_roster(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Current HR supervisor per person."""
    return shared(t, "current_roster", cfg, lambda: _current_roster(t.hr_roster, cfg.hr_division))


def resolve_supervisor(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """Supervisor per (creation day, core agent): tracked time first,
    then the current HR record, then the default label."""
    x = all_updates(t, cfg).select("assignee_id", "local_date_created")
    x = validity_join(x, _team(t, True), "assignee_id", "_zid", "local_date_created", "_start", "_end", "inner")
    x = x.select("local_date_created", "agent_name").distinct()
    from deskpulse.plans.wait import tracked_supervisors
    su = tracked_supervisors(t, cfg)
    x = x.join(su, (F.col("local_date_created") == F.col("_sdate")) & (F.col("_agent") == F.col("agent_name")), "left")
    cur = current_roster(t, cfg)
    x = x.join(cur, F.col("agent_name") == F.col("full_name"), "left")
    return x.select("local_date_created", "agent_name",
                    F.coalesce("_util_sup", "job_supervisor", F.lit(cfg.default_supervisor)).alias("supervisor")
                    ).distinct()


def rated_without_exclusions(t, cfg: ReportConfig = DEFAULT, method: str = "join") -> DataFrame:
    """C14: rated tickets minus the exclusion list (ids such as '123.0')."""
    x = (all_updates(t, cfg).where(F.col("satisfaction_rating_score").isin(*RATINGS))
         .select("ticket_id", "channel", "satisfaction_rating_score"))
    return exclude_ids(x, "ticket_id", t.dsat_exclusions, numeric_id_text("ext_interaction_id"), method).distinct()


LAG_GRAINS = {"daily": ["agent_name", "local_date_created"], "team_daily": ["local_date_created"],
              "weekly": ["agent_name", "_week"], "team_weekly": ["_week"],
              "monthly": ["agent_name", "_month"], "team_monthly": ["_month"]}


def update_lag_multi_grain(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """C6 on every update: days from creation to update, with rounded
    agent and team averages per day/week/month (agents may be NULL)."""
    r = roster(t, cfg.roster_account)
    x = (all_updates(t, cfg).join(r, F.col("assignee_id") == F.col("_rid"), "left")
         .select("ticket_id", "local_date_created", "date_updated", "agent_name",
                 days_between("date_updated", "local_date_created").alias("lag_days")))
    x = x.withColumn("_week", week_start("local_date_created")).withColumn("_month", month_start("local_date_created"))
    g = attach_grains(x, "lag_days", LAG_GRAINS, anchor="agent_name", implied=PERIODS)
    return g.select("ticket_id", "local_date_created", "date_updated", "agent_name", "lag_days",
                    *[round_avg_text(n, cfg.half_even_means).alias(n) for n in LAG_GRAINS])
