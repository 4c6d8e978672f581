"""Column helpers (F1-F18): built-in Spark functions only, so every
expression stays inside whole-stage code generation."""

from deskpulse.functions.dates import (
    us_date, us_datetime_of_date, parse_us_date, week_start, month_start,
    hour_of_time_text, seconds_of_day, days_between,
)
from deskpulse.functions.numbers import (
    mmss_to_seconds, nan_to_null, round_avg_text, num_text, numeric_id_text,
    true_divide, round2, rate_or_count,
)
from deskpulse.functions.text import full_name, like_any, not_like_all

__all__ = [
    "us_date", "us_datetime_of_date", "parse_us_date", "week_start", "month_start",
    "hour_of_time_text", "seconds_of_day", "days_between", "mmss_to_seconds", "nan_to_null",
    "round_avg_text", "num_text", "numeric_id_text", "true_divide", "round2",
    "rate_or_count", "full_name", "like_any", "not_like_all",
]
