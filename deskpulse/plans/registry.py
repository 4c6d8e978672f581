"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deskpulse.config import DEFAULT
from deskpulse.plans import attendance as att
from deskpulse.plans import building_blocks as bb, csat, frt, productivity as prod, wait
from deskpulse.sources import load_tables


def _report(fn, **kw) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_tables(spark, sf_dir, on_use=True), DEFAULT, **kw)
    run.__name__ = getattr(fn, "__name__", "report")
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "attendance": _report(att.attendance),
    "frt_chat_multi_grain": _report(frt.frt_multi_grain, channel="chat"),
    "frt_email_multi_grain": _report(frt.frt_multi_grain, channel="email"),
    "frt_email_kpi": _report(frt.frt_email_kpi),
    "frt_email_flex": _report(frt.frt_email_flex),
    "frt_chat_flex": _report(frt.frt_chat_flex),
    "frt_chat_asof": _report(frt.frt_chat_asof),
    "csat_raw": _report(csat.csat_raw),
    "csat_clean": _report(csat.csat_clean),
    "csat_narrow": _report(csat.csat_narrow),
    "csat_flex": _report(csat.csat_flex),
    "wait_time_supervisor": _report(wait.wait_time_supervisor),
    "wait_time_multi_grain": _report(wait.wait_time_multi_grain),
    "wait_time_one_supervisor": _report(wait.wait_time_supervisor, one_supervisor=True),
    "text_date_sort_top_k": _report(wait.wait_time_multi_grain, cap=500, text_date_order=True),
    "real_date_sort_top_k": _report(wait.wait_time_multi_grain, cap=500),
    "channel_counts_hourly": _report(prod.channel_counts_hourly),
    "channel_counts_weekly": _report(prod.channel_counts_weekly),
    "tracked_hours": _report(prod.tracked_hours),
    "manual_hours": _report(prod.manual_hours),
    "productivity_hourly": _report(prod.productivity_hourly),
    "productivity_hourly_one_supervisor": _report(prod.productivity_hourly_one_supervisor),
    "productivity_weekly": _report(prod.productivity_weekly),
    "productivity_flex": _report(prod.productivity_flex),
    "latest_update_per_ticket": _report(bb.latest_update_per_ticket),
    "latest_update_per_ticket_day": _report(bb.latest_update_per_ticket_day),
    "first_update_per_ticket": _report(bb.first_update_per_ticket),
    "latest_update_one_scan": _report(bb.latest_update_one_scan),
    "first_update_one_scan": _report(bb.first_update_one_scan),
    "longest_wait": _report(bb.longest_wait),
    "scd2_team_left": _report(bb.scd2_team_left),
    "scd2_team_inner": _report(bb.scd2_team_inner),
    "asof_supervisor": _report(bb.asof_supervisor),
    "current_roster": _report(bb.current_roster),
    "resolve_supervisor": _report(bb.resolve_supervisor),
    "rated_without_exclusions": _report(bb.rated_without_exclusions),
    "rated_without_exclusions_split": _report(bb.rated_without_exclusions, method="bloom"),
    "update_lag_multi_grain": _report(bb.update_lag_multi_grain),
}

# SURVEY §2 inventory IDs exercised by each registered query.
INVENTORY: dict[str, tuple[str, ...]] = {
    "attendance": ("R16", "F1", "F2", "Q1", "Q9", "O1", "O3"),
    "frt_chat_multi_grain": ("R7", "C2", "C6", "J3", "J4", "J10", "F4", "F5", "F6", "F8", "F9", "F12", "O1", "O3"),
    "frt_email_multi_grain": ("R9", "C2", "C6", "J3", "J4", "J10", "F8", "F12", "O3"),
    "frt_email_kpi": ("R8", "C2", "C6", "J3", "J10", "J14", "O3"),
    "frt_email_flex": ("R15", "C2", "C6", "J3", "J10", "J13", "O3"),
    "frt_chat_flex": ("R10", "C1", "C6", "J1", "J2", "F17", "W1", "W7"),
    "frt_chat_asof": ("R6", "C4", "C6", "J3", "J6", "J12", "F15", "F16", "O3"),
    "csat_raw": ("R11", "C13", "J4", "J8", "J9", "U1", "F11", "Q8"),
    "csat_clean": ("R12", "C13", "C14", "J7"),
    "csat_narrow": ("R13", "C13", "C14"),
    "csat_flex": ("R14", "C14", "U1", "U2", "J9", "Q9"),
    "wait_time_supervisor": ("R4", "C3", "C5", "C6", "C15", "F7", "J4", "J11", "J12", "O2", "O3", "P5"),
    "wait_time_multi_grain": ("R5", "C3", "C6", "F7", "J4", "O2", "O3"),
    "text_date_sort_top_k": ("O2", "O3", "R5"),
    "real_date_sort_top_k": ("O1", "O3", "R5"),
    "channel_counts_hourly": ("C7", "A1", "A2", "W3", "P3", "J1", "J13", "Q2", "Q3", "Q4"),
    "channel_counts_weekly": ("C7", "A2", "A5", "W3", "W6"),
    "tracked_hours": ("C8", "A3", "W2", "W6", "Q5", "Q6", "Q7"),
    "manual_hours": ("C9", "A3", "W2", "P5"),
    "productivity_hourly": ("R1", "C7", "C8", "C9", "C10", "C11", "A4", "J5", "J11", "F10", "F13", "F14", "O3"),
    "productivity_weekly": ("R2", "C7", "C8", "C9", "C11", "A4", "P4", "F14"),
    "productivity_flex": ("R3", "C7", "C12", "A4", "P6", "F13"),
    "latest_update_per_ticket": ("C1", "W4", "Q10"),
    "latest_update_per_ticket_day": ("C1", "W4", "Q10"),
    "first_update_per_ticket": ("C2", "W5", "F8"),
    "longest_wait": ("C3", "F7"),
    "scd2_team_left": ("J4", "J2", "Q5"),
    "scd2_team_inner": ("J5",),
    "asof_supervisor": ("C4", "J6", "F15"),
    "current_roster": ("C5",),
    "resolve_supervisor": ("C15", "C5", "P5", "J11"),
    "rated_without_exclusions": ("C14", "J7", "F11"),
    "wait_time_one_supervisor": ("R4", "C15", "C3", "C6", "J4"),
    "productivity_hourly_one_supervisor": ("R1", "C15", "C7", "C10", "C11", "J5"),
    "latest_update_one_scan": ("C1", "W4"),
    "first_update_one_scan": ("C2", "W5", "F8"),
    "rated_without_exclusions_split": ("C14", "J7", "F11"),
    "update_lag_multi_grain": ("C6", "W1", "F8", "H13"),
}
