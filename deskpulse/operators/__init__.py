"""Reusable DataFrame operators.

Each operator is a composition of built-in DataFrame operations; none
collects data to the driver.
"""

from deskpulse.operators.dedupe import keep_extreme, latest_per_key, first_per_key, longest_wait
from deskpulse.operators.joins import (
    null_safe_join, validity_join, asof_nearest, current_roster,
)
from deskpulse.operators.exclusion import exclude_ids, split_by_filter
from deskpulse.operators.intraday import day_intervals, in_effect
from deskpulse.operators.grains import grain_table, attach_grains

__all__ = [
    "keep_extreme", "latest_per_key", "first_per_key", "longest_wait",
    "null_safe_join", "validity_join", "asof_nearest", "exclude_ids",
    "split_by_filter", "day_intervals", "in_effect", "current_roster", "grain_table", "attach_grains",
]
