"""Satisfaction reports (R11-R14) on a shared rated-ticket base.

Rated updates of all channels -> good/bad, one account -> core subteam on
the creation date -> first update per ticket (ties kept) -> exclusion list
(C14) as a flag (R11) or removed (R12, R13).  The exclusion key is the
ticket id, the first-update choice's own key, so the anti join may run on
either side of it; it runs after it, so the three reports share one
first-update table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.config import DEFAULT, ReportConfig
from deskpulse.constants import RATINGS
from deskpulse.functions import hour_of_time_text, not_like_all, numeric_id_text, us_date
from deskpulse.operators import exclude_ids, first_per_key, validity_join
from deskpulse.plans.common import lit_like, roster, top_k
from deskpulse.plans.shared import shared

BASE_COLS = ["client_account", "ticket_id", "channel", "local_date_created", "local_time_created",
             "satisfaction_rating_score", "satisfaction_rating_comment", "assignee_id", "tags", "type",
             "date_updated"]


def rated_updates(t, cfg: ReportConfig) -> DataFrame:
    """Rated updates of the four ticket tables, one account."""
    u = reduce(DataFrame.unionByName,
               [x.select(*BASE_COLS) for x in (t.email_tickets, t.chat_tickets, t.call_tickets, t.web_tickets)])
    return u.where(F.col("satisfaction_rating_score").isin(*RATINGS) & (F.col("client_account") == cfg.account))


def csat_base(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """C13 up to the first-update choice: rated updates handled by a core
    subteam agent (excluded subteams dropped) on or after the floor date."""
    team = (t.subteams.where(F.col("is_core_team") & not_like_all("subteam", cfg.subteam_exclude_patterns))
             .select(F.col("agent_name").alias("zendesk_assignee"), "subteam", "agent_email",
                     F.col("zendesk_id").alias("_zid"), F.col("start_date").alias("_start"),
                     F.col("end_date").alias("_end")))
    u = rated_updates(t, cfg)
    u = u.where(F.col("local_date_created") >= lit_like(u, "local_date_created", cfg.csat_floor))
    return validity_join(u, team, "assignee_id", "_zid", "local_date_created", "_start", "_end", "inner")


def csat_first(t, cfg: ReportConfig = DEFAULT) -> DataFrame:
    """First rated update(s) per ticket (shared by R11-R13).  The
    exclusion list is applied after it: its key is the ticket id, the
    choice's own key, so before and after give the same rows."""
    return shared(t, "csat_first", cfg,
                  lambda: first_per_key(csat_base(t, cfg), ["ticket_id"], "date_updated"))


def _exclusion_keys(t) -> DataFrame:
    return t.dsat_exclusions.select(numeric_id_text("ext_interaction_id").alias("_xk"), "ext_interaction_id")


RAW_COLS = ["ticket_id", "channel", "local_date_created", "hour_", "satisfaction_rating_score",
            "satisfaction_rating_comment", "tags", "type", "uncontrollable_dsat", "zendesk_assignee", "subteam"]
_INNER = ["ticket_id", "channel", "local_date_created", "local_time_created", "satisfaction_rating_score",
          "satisfaction_rating_comment", "tags", "type", "zendesk_assignee", "date_updated", "subteam"]


def _raw_out(x: DataFrame, excl_col, ordered: bool) -> DataFrame:
    out = x.select(
        "ticket_id", "channel", us_date("local_date_created").alias("local_date_created"),
        hour_of_time_text("local_time_created").alias("hour_"), "satisfaction_rating_score",
        "satisfaction_rating_comment", "tags", "type", excl_col.alias("uncontrollable_dsat"),
        "zendesk_assignee", "subteam", F.col("local_date_created").alias("_day"),
        F.col("local_time_created").alias("_time"))
    return top_k(out, [("_day", "asc"), ("_time", "asc"), ("ticket_id", "asc")], None, RAW_COLS, ordered)


def csat_raw(t, cfg: ReportConfig = DEFAULT, ordered: bool = False) -> DataFrame:
    """First rated update per ticket, with the exclusion id as a flag."""
    x = csat_first(t, cfg).join(_exclusion_keys(t), F.col("ticket_id") == F.col("_xk"), "left")
    x = x.select(*_INNER, "ext_interaction_id").distinct()
    return _raw_out(x, numeric_id_text("ext_interaction_id"), ordered)


def csat_clean(t, cfg: ReportConfig = DEFAULT, ordered: bool = False) -> DataFrame:
    """As R11 with excluded tickets removed."""
    x = exclude_ids(csat_first(t, cfg), "ticket_id", t.dsat_exclusions, numeric_id_text("ext_interaction_id"), cfg.exclusions)
    x = x.select(*_INNER).distinct()
    return _raw_out(x, F.lit(None).cast("string"), ordered)


NARROW_COLS = ["ticket_id", "channel", "local_date_created", "assignee_id", "name_", "email_", "csat",
               "hour_", "subteam"]


def csat_narrow(t, cfg: ReportConfig = DEFAULT, ordered: bool = False) -> DataFrame:
    """Narrow satisfaction list (ticket, agent, email, hour, rating); ordered by
    the formatted date, as the report is (O2)."""
    x = exclude_ids(csat_first(t, cfg), "ticket_id", t.dsat_exclusions, numeric_id_text("ext_interaction_id"), cfg.exclusions)
    out = x.select(
        "ticket_id", "channel", us_date("local_date_created").alias("local_date_created"),
        "assignee_id", F.col("zendesk_assignee").alias("name_"), F.col("agent_email").alias("email_"),
        F.col("satisfaction_rating_score").alias("csat"),
        hour_of_time_text("local_time_created").alias("hour_"), "subteam").distinct()
    return top_k(out, [("local_date_created", "desc"), ("hour_", "desc"), ("ticket_id", "asc")], None, NARROW_COLS,
                 ordered)


FLEX_COLS = ["ticket_id", "channel", "local_date_created", "assignee_id", "name_", "email_", "csat"]


def csat_flex(t, cfg: ReportConfig = DEFAULT, ordered: bool = False) -> DataFrame:
    """Ratings of flex agents from five sources (no first-update
    choice), exclusions removed."""
    cols = ["ticket_id", "channel", "local_date_created", "assignee_id", "satisfaction_rating_score"]
    srcs = (t.email_tickets, t.chat_tickets, t.web_tickets, t.kpi_summary, t.call_tickets)
    u = reduce(DataFrame.unionByName, [
        s.where((F.col("client_account") == cfg.account) & F.col("satisfaction_rating_score").isin(*RATINGS))
         .select(*cols) for s in srcs])
    u = u.where(F.col("local_date_created") > lit_like(u, "local_date_created", cfg.csat_flex_after)).distinct()
    r = roster(t, cfg.flex_roster_account).where(F.col("_rid").isNotNull() & F.col("agent_email").isNotNull())
    x = u.join(r, F.col("assignee_id") == F.col("_rid"))
    x = exclude_ids(x, "ticket_id", t.dsat_exclusions, numeric_id_text("ext_interaction_id"), cfg.exclusions)
    out = x.select("ticket_id", "channel", us_date("local_date_created").alias("local_date_created"),
                   "assignee_id", F.col("agent_name").alias("name_"), F.col("agent_email").alias("email_"),
                   F.col("satisfaction_rating_score").alias("csat"))
    return top_k(out, [("local_date_created", "desc"), ("name_", "asc")], None, FLEX_COLS, ordered)
