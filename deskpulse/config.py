"""Report parameters.

Every literal the report queries hard-code (accounts, date floors, division
names, activity patterns, standard hours) is a field here.  The
defaults fit the fixture tables built by ``deskpulse.sources.fixtures``; a
deployment passes its own values.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class ReportConfig:
    # Accounts: the core account owns the tickets; rosters are split into a
    # core and a flex roster by their own account column.
    account: str = "acct_a"
    roster_account: str = "acct_a"
    flex_roster_account: str = "acct_a_flex"

    # Divisions / functions used to scope tracked time and the HR roster.
    tracked_division: str = "Division A"      # hourly report, wait-time supervisor
    tracked_function: str = "Service Delivery"  # weekly core report
    hr_division: str = "Care"

    # Activity names that count as ticket work (LIKE patterns, OR-ed).
    activity_patterns: tuple[str, ...] = ("%Ticket Active%", "%Tickets Active%", "%Helpdesk%")
    # Subteams dropped from satisfaction reports (NOT LIKE patterns, AND-ed).
    subteam_exclude_patterns: tuple[str, ...] = ("%ASIA%", "%MIDDLE%")
    # Label used when no supervisor is found.
    default_supervisor: str = "Flex Pool"

    # Date floors (inclusive unless stated).
    wait_time_floor: dt.date = dt.date(1996, 4, 1)
    frt_floor: dt.date = dt.date(1996, 1, 1)
    csat_floor: dt.date = dt.date(1996, 1, 1)
    csat_flex_after: dt.date = dt.date(1996, 1, 31)   # exclusive
    weekly_floor: dt.date = dt.date(1996, 1, 15)
    attendance_floor: dt.datetime = dt.datetime(2024, 1, 5, 0, 0, 0)

    # How the longest call leg is chosen: "seconds", or "text" as the reports compare (H8).
    longest_wait_compare: str = "seconds"

    # Rounded means: halves away from zero, or to the even neighbour (H5).
    half_even_means: bool = False

    # How listed tickets are excluded: "join", or "bloom" for a list too long to broadcast (C14).
    exclusions: str = "join"

    # Standard hours for the flex productivity rates.
    week_hours: int = 40
    month_hours: int = 160


DEFAULT = ReportConfig()
