"""Shift, clock and absence lines per agent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.config import DEFAULT, ReportConfig
from deskpulse.functions import us_date, us_datetime_of_date
from deskpulse.plans.common import lit_like, top_k

ATTENDANCE_COLS = ["agent_email", "shift_start", "shift_end", "clock_in", "clock_out",
                   "absenteeism", "tardiness", "agent_name", "local_date_created"]


def attendance(t, cfg: ReportConfig = DEFAULT, cap: int | None = None, ordered: bool = False) -> DataFrame:
    a = t.attendance
    a = a.where((F.col("client_account") == cfg.account)
                & (F.col("shift_start") >= lit_like(a, "shift_start", cfg.attendance_floor)))
    if "shift_day" in a.columns:  # partitioned by the day of the shift: the floor also picks the folders
        a = a.where(F.col("shift_day") >= lit_like(a, "shift_day", cfg.attendance_floor.date()))
    out = a.select(
        "agent_email",
        us_datetime_of_date("shift_start").alias("shift_start"),
        us_datetime_of_date("shift_end").alias("shift_end"),
        us_datetime_of_date("clock_in").alias("clock_in"),
        us_datetime_of_date("clock_out").alias("clock_out"),
        F.col("absenteeism").cast("string").alias("absenteeism"),
        F.col("tardiness").cast("string").alias("tardiness"),
        "agent_name",
        us_date(F.to_date("shift_start")).alias("local_date_created"),
        F.to_date("shift_start").alias("_day"),
    )
    return top_k(out, [("_day", "desc"), ("agent_name", "asc")], cap, ATTENDANCE_COLS, ordered)
