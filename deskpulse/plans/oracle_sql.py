"""Oracle SQL (DuckDB) for every registered report query.

Written from SURVEY §2, independently of the Spark plans: each operator of the
inventory is one flat CTE, extremes per key are ``rank()`` (C1-C3), averages
and sums per grain are grouped aggregates joined back on their keys (C6), the
nearest earlier record is a correlated maximum (C4), and exclusions are
``NOT EXISTS`` (C14). The inputs are the fixture views, the literals come from
``ReportConfig``. Ordering keys spell out NULL placement and end with every
output column, so that a row cap picks one well-defined set of rows; integer
sums are cast to bigint (DuckDB widens them).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from deskpulse.config import DEFAULT as C
from deskpulse.plans.oracle_fixtures import with_fixtures


# ------------------------------------------------------------ expressions
def text(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def day(expr: str) -> str:
    """a date as mm/dd/yyyy."""
    return f"strftime({expr}, '%m/%d/%Y')"


def midnight(expr: str) -> str:
    """the date of a timestamp, printed with a time of day."""
    return f"strftime(cast({expr} AS date), '%m/%d/%Y %H:%M:%S')"


def period(unit: str, expr: str) -> str:
    """first day of the week or month."""
    return f"cast(date_trunc('{unit}', {expr}) AS date)"


def hour(expr: str) -> str:
    """hour of a time text."""
    return f"hour(cast({expr} AS time))"


def mean_text(expr: str) -> str:
    """a rounded mean as text without a decimal part, NaN as NaN."""
    return f"if(isnan({expr}), 'NaN', cast(cast(round({expr}) AS bigint) AS varchar))"


def number_text(expr: str) -> str:
    """a number as text, whole numbers without a decimal part."""
    whole = f"cast(cast(floor({expr}) AS bigint) AS varchar)"
    return f"CASE WHEN isnan({expr}) THEN 'NaN' WHEN {expr} = floor({expr}) THEN {whole} ELSE cast({expr} AS varchar) END"


def id_text(expr: str) -> str:
    """the whole part of a numeric text as text; NULL if it is no number."""
    return f"cast(cast(trunc(try_cast({expr} AS decimal(38, 6))) AS decimal(38, 0)) AS varchar)"


def seconds(expr: str) -> str:
    """mm:ss in seconds."""
    return f"(cast(split_part({expr}, ':', 1) AS bigint) * 60 + cast(split_part({expr}, ':', 2) AS bigint))"


def cents(expr: str) -> str:
    """two decimals, half away from zero."""
    return f"cast(round(cast({expr} AS decimal(38, 10)), 2) AS double)"


def per(count: str, hours: str) -> str:
    """true division; zero hours give NULL."""
    return f"cast({count} AS double) / nullif(cast({hours} AS double), 0)"


def any_of(column: str, values: Sequence[str]) -> str:
    return f"{column} IN ({', '.join(map(text, values))})"


# --------------------------------------------------------------- operators
def statement(ctes: Mapping[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + "\n" + body


def report(ctes: Mapping[str, str], source: str, columns: Mapping[str, str], order: Sequence[str] = (), cap: int | None = None) -> str:
    """The output columns of ``source``; with a cap, the first rows in report order (O1, O3)."""
    listed = ", ".join(f"{e} AS {n}" if e != n else n for n, e in columns.items())
    if cap is None:
        return statement(ctes, f"SELECT {listed} FROM {source}")
    ties = [f"{n} ASC NULLS LAST" for n in columns]
    return statement(ctes, f"SELECT {listed} FROM {source} ORDER BY {', '.join([*order, *ties])} LIMIT {cap}")


NEWEST_DAY = ["local_day DESC NULLS FIRST"]


def extremes(source: str, keys: Sequence[str], by: str, largest: bool, columns: str = "*") -> str:
    """Rows that tie for the extreme of each key."""
    way = "DESC" if largest else "ASC"
    return f"SELECT {columns} FROM {source} WHERE {by} IS NOT NULL QUALIFY rank() OVER (PARTITION BY {', '.join(keys)} ORDER BY {by} {way}) = 1"


def grains(source: str, value: str, sets: Mapping[str, Sequence[str]], fn: str = "avg") -> tuple[dict[str, str], str]:
    """One grouped aggregate per grain, and the join that attaches them to
    ``source`` (NULL keys join their own group)."""
    cte, joins = {}, []
    for name, keys in sets.items():
        total = f"cast(sum({value}) AS bigint)" if fn == "sum" else f"{fn}({value})"
        cte[f"by_{name}"] = f"SELECT {', '.join(keys)}, {total} AS {name} FROM {source} GROUP BY {', '.join(keys)}"
        same = " AND ".join(f"by_{name}.{k} IS NOT DISTINCT FROM f.{k}" for k in keys)
        joins.append(f"JOIN by_{name} ON {same}")
    names = "".join(f", by_{n}.{n}" for n in sets)
    cte["graded"] = f"SELECT f.*{names} FROM {source} f {' '.join(joins)}"
    return cte, "graded"


PERIODS = f"{period('week', 'local_day')} AS week_day, {period('month', 'local_day')} AS month_day"
BY_AGENT = {"daily": ["agent_name", "local_day"], "weekly": ["agent_name", "week_day"], "monthly": ["agent_name", "month_day"]}
BY_ALL = {"daily": ["local_day"], "weekly": ["week_day"], "monthly": ["month_day"]}
FLEX = {k: v for g in ("daily", "weekly", "monthly") for k, v in ((g, BY_AGENT[g]), (f"team_{g}", BY_ALL[g]))}
BY_TEAM = {
    "hourly": ["agent_name", "local_day", "hour_"], "t_hourly": ["subteam", "local_day", "hour_"],
    "daily": ["agent_name", "local_day"], "t_daily": ["subteam", "local_day"],
    "weekly": ["agent_name", "week_day"], "t_weekly": ["subteam", "week_day"],
    "monthly": ["agent_name", "month_day"], "t_monthly": ["subteam", "month_day"],
}

OWN = f"client_account = {text(C.account)}"
DONE = any_of("status", ["solved", "closed"])
RATED = any_of("satisfaction_rating_score", ["good", "bad"])
TICKETS = ["email_tickets", "chat_tickets", "call_tickets", "web_tickets"]


def members(account: str | None) -> str:
    """The agent roster, of one account or whole."""
    where = f" WHERE client_account = {text(account)}" if account else ""
    return f"SELECT assignee_id AS rostered_id, agent_name, agent_email FROM agent_roster{where}"


def teams(core: bool = True, more: str = "") -> str:
    """Subteam records with their validity."""
    where = f"WHERE {'is_core_team' if core else 'true'}{more}"
    return f"SELECT zendesk_id, agent_name, agent_email, subteam, is_core_team, start_date AS valid_from, end_date AS valid_to FROM subteams {where}"


ON_DUTY = "m.zendesk_id = u.assignee_id AND u.local_date_created >= m.valid_from AND u.local_date_created <= m.valid_to"


def updates(columns: str, where: str = OWN) -> str:
    """Updates of the four ticket tables."""
    return " UNION ALL ".join(f"SELECT {columns} FROM {t} WHERE {where}" for t in TICKETS)


def hr_records() -> str:
    return f"SELECT DISTINCT first_name || ' ' || last_name AS person, job_supervisor AS supervisor, job_effectivity_date AS since FROM hr_roster WHERE job_division = {text(C.hr_division)}"


HR_NOW = {
    "hr": f"SELECT first_name || ' ' || last_name AS person, * FROM hr_roster WHERE job_division = {text(C.hr_division)}",
    "hr_last": "SELECT person, max(status_effectivity_date) AS s, max(job_effectivity_date) AS j, max(created_on) AS c FROM hr GROUP BY person",
    "hr_now": """SELECT DISTINCT hr.person, hr.job_supervisor FROM hr JOIN hr_last USING (person)
      WHERE (status_effectivity_date, job_effectivity_date, created_on) = (s, j, c) AND profile_status = 'Active'""",
}
TRACKED_BY = f"SELECT DISTINCT start_date, agent_name, supervisor FROM tracked_time WHERE division_name = {text(C.tracked_division)}"
NOT_EXCLUDED = f"NOT EXISTS (SELECT 1 FROM dsat_exclusions x WHERE {id_text('x.ext_interaction_id')} = f.ticket_id)"

ORACLE: dict[str, str] = {}


# ------------------------------------------------------------- attendance
ORACLE["attendance"] = report(
    {"lines": f"""SELECT *, cast(shift_start AS date) AS local_day FROM attendance
       WHERE {OWN} AND shift_start >= TIMESTAMP {text(C.attendance_floor)}"""},
    "lines",
    {"agent_email": "agent_email", **{c: midnight(c) for c in ("shift_start", "shift_end", "clock_in", "clock_out")},
     "absenteeism": "cast(absenteeism AS varchar)", "tardiness": "cast(tardiness AS varchar)", "agent_name": "agent_name", "local_date_created": day("local_day")},
)


# ---------------------------------------------------- first response times
def first_updates(source: str, channel: str) -> dict[str, str]:
    """C2 over solved tickets of one channel (H1: before any agent rule)."""
    return {
        "done": f"SELECT *, date_updated - local_date_created AS lag_days FROM {source} WHERE {OWN} AND {DONE} AND channel = {text(channel)}",
        "first_": extremes("done", ["ticket_id"], "lag_days", largest=False),
    }


def response_by_team(source: str, channel: str, metric: str) -> str:
    ctes = {
        **first_updates(source, channel),
        "metric": metric,
        "team": teams(),
        "facts": f"""SELECT DISTINCT m.subteam, u.ticket_id, u.local_date_created AS local_day, {hour('u.local_time_created')} AS hour_,
            if(r.ticket_id IS NULL, NULL, {text(channel)}) AS channel, m.zendesk_id AS assignee_id, m.agent_email AS email_address, m.agent_name, r.frt
          FROM first_ u JOIN team m ON {ON_DUTY} LEFT JOIN metric r ON r.ticket_id = u.ticket_id
          WHERE m.agent_name IS NOT NULL AND u.local_date_created >= DATE {text(C.frt_floor)}""",
        "dated": f"SELECT *, {PERIODS} FROM facts",
    }
    more, source = grains("dated", "frt", BY_TEAM)
    columns = {"subteam": "subteam", "ticket_id": "ticket_id", "local_date_created": day("local_day")}
    columns |= {c: c for c in ("hour_", "channel", "assignee_id", "email_address", "agent_name")} | {"frt_calendar": number_text("frt")}
    return report(ctes | more, source, columns | {n: mean_text(n) for n in BY_TEAM})


ORACLE["frt_chat_multi_grain"] = response_by_team("chat_tickets", "chat", "SELECT ticket_id, response_time_first AS frt FROM chat_insights")
ORACLE["frt_email_multi_grain"] = response_by_team("email_tickets", "email", "SELECT ticket_id, reply_time_calendar_minutes AS frt FROM email_metrics")


def email_response(account: str, metric: str, channel: str, floor: bool, sets: Mapping[str, Sequence[str]]) -> str:
    after = f" AND u.local_date_created >= DATE {text(C.frt_floor)}" if floor else ""
    ctes = {
        **first_updates("email_tickets", "email"),
        "metric": metric,
        "agent": members(account),
        "facts": f"""SELECT DISTINCT u.ticket_id, u.local_date_created AS local_day, {channel} AS channel, a.rostered_id AS assignee_id,
            a.agent_email AS email_address, a.agent_name, r.frt
          FROM first_ u JOIN agent a ON a.rostered_id = u.assignee_id LEFT JOIN metric r ON r.ticket_id = u.ticket_id
          WHERE a.agent_name IS NOT NULL{after}""",
        "dated": f"SELECT *, {PERIODS} FROM facts",
    }
    more, source = grains("dated", "frt", sets)
    columns = {"ticket_id": "ticket_id", "local_date_created": day("local_day")} | {c: c for c in ("channel", "assignee_id", "email_address", "agent_name")}
    return report(ctes | more, source, columns | {"frt_calendar": number_text("frt")} | {n: mean_text(n) for n in sets})


ORACLE["frt_email_kpi"] = email_response(
    C.roster_account, "SELECT ticket_id, frt_calendar AS frt, channel FROM kpi_summary WHERE agent_name IS NOT NULL", "r.channel", True, BY_AGENT
)
ORACLE["frt_email_flex"] = email_response(C.flex_roster_account, "SELECT ticket_id, reply_time_calendar_minutes AS frt FROM email_metrics", "u.channel", False, FLEX)


def chat_flex() -> str:
    ctes = {
        "own": f"SELECT ticket_id, local_date_created, date_updated, assignee_id FROM chat_tickets WHERE {OWN}",
        "newest": extremes("own", ["ticket_id"], "date_updated", largest=True),
        "agent": members(C.flex_roster_account),
        "facts": """SELECT DISTINCT u.ticket_id, u.local_date_created AS local_day, u.assignee_id, a.agent_name, a.agent_email,
            if(isnan(r.response_time_first), NULL, r.response_time_first) AS response_time_first
          FROM newest u JOIN agent a ON a.rostered_id = u.assignee_id JOIN chat_insights r ON r.ticket_id = u.ticket_id""",
        "dated": f"SELECT *, {PERIODS} FROM facts",
    }
    more, source = grains("dated", "response_time_first", FLEX)
    columns = {"ticket_id": "ticket_id", "local_date_created": day("local_day")} | {c: c for c in ("assignee_id", "agent_name", "agent_email", "response_time_first")}
    columns |= {n: f"round({n})" for n in FLEX} | {"week_date": day("week_day"), "month_date": day("month_day")}
    return report(ctes | more, source, columns)


ORACLE["frt_chat_flex"] = chat_flex()


def chat_asof() -> str:
    ctes = {
        "session": f"SELECT ticket_id, type, local_date, response_time_first FROM chat_insights WHERE {OWN} AND type = 'chat'",
        "handled": f"SELECT DISTINCT ticket_id, assignee_id FROM chat_tickets WHERE {OWN}",
        "agent": members(C.roster_account),
        "facts": """SELECT DISTINCT s.ticket_id, h.assignee_id, a.agent_name, a.agent_email, s.type AS channel, s.local_date AS local_day, s.response_time_first
          FROM session s LEFT JOIN handled h USING (ticket_id) LEFT JOIN agent a ON a.rostered_id = h.assignee_id""",
        "per_day": "SELECT agent_name, local_day, round(avg(response_time_first)) AS daily FROM facts GROUP BY agent_name, local_day",
        "hr": hr_records(),
        "moment": """SELECT d.agent_name, d.local_day, max(hr.since) AS since FROM (SELECT DISTINCT agent_name, local_day FROM facts) d
          JOIN hr ON hr.person = d.agent_name AND hr.since <= d.local_day GROUP BY d.agent_name, d.local_day""",
        "led": """SELECT DISTINCT f.ticket_id, f.local_day, f.channel, f.assignee_id, f.agent_email, f.agent_name, hr.supervisor, p.daily, f.response_time_first
          FROM facts f JOIN moment m ON m.agent_name = f.agent_name AND m.local_day = f.local_day
          JOIN hr ON hr.person = m.agent_name AND hr.since = m.since
          JOIN per_day p ON p.agent_name = f.agent_name AND p.local_day = f.local_day""",
        "dated": f"SELECT *, {PERIODS} FROM led",
    }
    more, source = grains("dated", "response_time_first", {k: BY_AGENT[k] for k in ("weekly", "monthly")})
    return report(ctes | more, source, {
        "ticket_id": "ticket_id", "local_date_created": day("local_day"), "channel": "channel", "response_time_first": "response_time_first",
        "email_address": "lower(agent_email)", "agent_name": "agent_name", "supervisor": "supervisor", "daily": "daily",
        "week_date": day("week_day"), "weekly": "round(weekly)", "month_date": day("month_day"), "monthly": "round(monthly)",
    })


ORACLE["frt_chat_asof"] = chat_asof()


# ------------------------------------------------------------ satisfaction
RATING_COLUMNS = "ticket_id, channel, local_date_created, local_time_created, satisfaction_rating_score, satisfaction_rating_comment, assignee_id, tags, type, date_updated"


def first_ratings() -> dict[str, str]:
    """First rated update of a ticket handled by a core agent on duty."""
    shut = "".join(f" AND subteam NOT LIKE {text(p)}" for p in C.subteam_exclude_patterns)
    return {
        "rated": updates(RATING_COLUMNS, f"{OWN} AND {RATED} AND local_date_created >= DATE {text(C.csat_floor)}"),
        "team": teams(more=shut),
        "on_duty": f"SELECT u.*, m.agent_name, m.agent_email, m.subteam FROM rated u JOIN team m ON {ON_DUTY} WHERE m.agent_name IS NOT NULL",
        "first_": extremes("on_duty", ["ticket_id"], "date_updated", largest=False),
    }


def ratings(flagged: bool) -> str:
    """R11 keeps excluded tickets and shows the exclusion id, R12 drops them."""
    kept = "date_updated, f.ticket_id, channel, local_date_created, local_time_created, satisfaction_rating_score, satisfaction_rating_comment, tags, type, agent_name, subteam"
    if flagged:
        rows = f"SELECT DISTINCT {kept}, x.ext_interaction_id AS mark FROM first_ f LEFT JOIN dsat_exclusions x ON {id_text('x.ext_interaction_id')} = f.ticket_id"
    else:
        rows = f"SELECT DISTINCT {kept}, cast(NULL AS varchar) AS mark FROM first_ f WHERE {NOT_EXCLUDED}"
    columns = {"ticket_id": "ticket_id", "channel": "channel", "local_date_created": day("local_date_created"), "hour_": hour("local_time_created")}
    columns |= {c: c for c in ("satisfaction_rating_score", "satisfaction_rating_comment", "tags", "type")}
    return report(first_ratings() | {"rows_": rows}, "rows_", columns | {"uncontrollable_dsat": id_text("mark"), "zendesk_assignee": "agent_name", "subteam": "subteam"})


ORACLE["csat_raw"] = ratings(flagged=True)
ORACLE["csat_clean"] = ratings(flagged=False)
ORACLE["csat_narrow"] = report(
    first_ratings() | {"rows_": f"""SELECT DISTINCT ticket_id, channel, {day('local_date_created')} AS local_date_created, assignee_id, agent_name AS name_,
      agent_email AS email_, satisfaction_rating_score AS csat, {hour('local_time_created')} AS hour_, subteam FROM first_ f WHERE {NOT_EXCLUDED}"""},
    "rows_",
    {c: c for c in ("ticket_id", "channel", "local_date_created", "assignee_id", "name_", "email_", "csat", "hour_", "subteam")},
)
ORACLE["csat_flex"] = report(
    {
        "rated": " UNION ".join(
            f"SELECT ticket_id, channel, local_date_created, assignee_id, satisfaction_rating_score FROM {t} WHERE {OWN} AND {RATED}" for t in [*TICKETS, "kpi_summary"]
        ),
        "agent": members(C.flex_roster_account),
        "rows_": f"""SELECT f.*, a.agent_name, a.agent_email FROM rated f JOIN agent a ON a.rostered_id = f.assignee_id
          WHERE a.agent_email IS NOT NULL AND f.local_date_created > DATE {text(C.csat_flex_after)} AND {NOT_EXCLUDED}""",
    },
    "rows_",
    {"ticket_id": "ticket_id", "channel": "channel", "local_date_created": day("local_date_created"), "assignee_id": "assignee_id",
     "name_": "agent_name", "email_": "agent_email", "csat": "satisfaction_rating_score"},
)


# -------------------------------------------------------------- wait times
LONGEST = {
    "legs": f"SELECT ticket_id, status, {seconds('wait_time')} AS dur FROM call_legs WHERE {OWN}",
    "longest": extremes("legs", ["ticket_id"], "dur", largest=True, columns="DISTINCT ticket_id, status, dur"),
}


def led_once(source: str, entries: str) -> dict[str, str]:
    """The supervisor that began last at or before ``at``, else the day's first."""
    return {
        "began": f"SELECT agent_name, start_date, cast(start_time AS time) AS began, min(supervisor) AS boss FROM tracked_time WHERE {entries} AND supervisor IS NOT NULL GROUP BY ALL",
        "led": f"""SELECT f.*, coalesce(arg_max(b.boss, b.began) FILTER (WHERE b.began <= f.at), arg_min(b.boss, b.began)) AS boss
          FROM {source} f LEFT JOIN began b ON b.start_date = f.local_day AND b.agent_name = f.agent_name GROUP BY ALL""",
    }


def waits_led_once() -> str:
    ctes, columns = waits(True)
    before = {"calls": ctes["calls"].replace("c.assignee_id", "c.assignee_id, cast(c.local_time_created AS time) AS at", 1),
              "duty": f"SELECT DISTINCT m.subteam, c.*, m.agent_email AS email_address, m.agent_name FROM calls c LEFT JOIN team m ON {ON_DUTY.replace('u.', 'c.')}"}
    before |= led_once("duty", f"division_name = {text(C.tracked_division)}")
    before["hr_one"] = "SELECT person, min(job_supervisor) AS job_supervisor FROM hr_now GROUP BY person"
    before["facts"] = f"""SELECT DISTINCT subteam, ticket_id, local_day, hour_, channel, assignee_id, email_address, agent_name,
        coalesce(boss, job_supervisor, {text(C.default_supervisor)}) AS supervisor, dur FROM led LEFT JOIN hr_one ON person = agent_name"""
    start = {k: v for k, v in ctes.items() if k not in ("calls", "facts", "dated") and not k.startswith("by_") and k != "graded"}
    return report(start | before | {k: v for k, v in ctes.items() if k not in start and k not in before}, "graded", columns)


def waits(led: bool) -> tuple[dict[str, str], dict[str, str]]:
    lead = f"coalesce(t.supervisor, h.job_supervisor, {text(C.default_supervisor)}) AS supervisor, " if led else ""
    joins = "LEFT JOIN tracked t ON t.start_date = c.local_day AND t.agent_name = m.agent_name LEFT JOIN hr_now h ON h.person = m.agent_name" if led else ""
    ctes = {
        **LONGEST,
        "calls": f"""SELECT DISTINCT c.ticket_id, w.dur, c.channel, c.local_date_created AS local_day, c.local_date_created, {hour('c.local_time_created')} AS hour_, c.assignee_id
          FROM call_tickets c LEFT JOIN (SELECT DISTINCT ticket_id, dur FROM longest) w USING (ticket_id)
          WHERE {OWN} AND via_source_rel <> 'outbound' AND {DONE} AND c.local_date_created >= DATE {text(C.wait_time_floor)}""",
        "team": teams(),
        **(HR_NOW | {"tracked": TRACKED_BY} if led else {}),
        "facts": f"""SELECT DISTINCT m.subteam, c.ticket_id, c.local_day, c.hour_, c.channel, c.assignee_id, m.agent_email AS email_address, m.agent_name, {lead}c.dur
          FROM calls c LEFT JOIN team m ON {ON_DUTY.replace('u.', 'c.')} {joins}""",
        "dated": f"SELECT *, {PERIODS} FROM facts",
    }
    sets: dict[str, Sequence[str]] = {}
    for name, keys in BY_TEAM.items():
        sets[name] = keys
        if led and name.startswith("t_"):
            sets["v_" + name[2:]] = ["supervisor", *keys]
    more, _ = grains("dated", "dur", sets)
    columns = {"client_account": "subteam", "local_date_created": day("local_day")} | {c: c for c in ("hour_", "ticket_id", "assignee_id", "email_address", "agent_name")}
    columns |= {"supervisor": "supervisor"} if led else {}
    return ctes | more, columns | {"dur": "dur"} | {n: mean_text(n) for n in sets}


ORACLE["wait_time_supervisor"] = report(waits(True)[0], "graded", waits(True)[1])
ORACLE["wait_time_multi_grain"] = report(waits(False)[0], "graded", waits(False)[1])
ORACLE["wait_time_one_supervisor"] = waits_led_once()
TOP_K = 500
_WAITS = waits(False)
ORACLE["text_date_sort_top_k"] = report(_WAITS[0], "graded", _WAITS[1], [f"{day('local_day')} DESC NULLS FIRST", "hour_ DESC NULLS FIRST", "agent_name ASC NULLS LAST"], TOP_K)
ORACLE["real_date_sort_top_k"] = report(_WAITS[0], "graded", _WAITS[1], [*NEWEST_DAY, "hour_ DESC NULLS FIRST", "agent_name ASC NULLS LAST"], TOP_K)


# ------------------------------------------------------------ productivity
def counted(account: str | None, hourly: bool) -> dict[str, str]:
    """Per channel the rows that count (``n_*`` CTEs), with their agents."""
    done = f" AND {DONE}" if hourly else ""
    own = {"agent": members(account)}
    own["live_chat"] = f"SELECT * FROM chat_tickets f WHERE {OWN} AND EXISTS (SELECT 1 FROM chat_insights i WHERE i.ticket_id = f.ticket_id AND i.{OWN} AND i.abandon_time IS NULL)"
    own["mail"] = f"SELECT * FROM email_tickets WHERE {OWN} AND channel = 'email'"
    own["web"] = f"SELECT * FROM web_tickets WHERE {OWN}"
    own["api"] = f"SELECT * FROM email_tickets WHERE {OWN} AND channel = 'api'"
    spoken = "voice" if hourly else None
    only = f" WHERE channel = {text(spoken)}" if spoken else ""
    own["handled"] = f"SELECT DISTINCT ticket_id, local_date_created, assignee_id FROM call_tickets{only}"
    unique = "DISTINCT " if hourly else ""
    own["n_voice"] = f"""SELECT {unique}l.local_date AS local_day, l.local_time AS at_time, l.ticket_id, h.assignee_id, a.agent_name
      FROM call_legs l JOIN handled h ON h.ticket_id = l.ticket_id JOIN agent a ON a.rostered_id = h.assignee_id
      WHERE l.{OWN} AND l.forwarded_to <> 'Voicemail'"""
    row = "local_date_created AS local_day, local_time_created AS at_time, ticket_id, assignee_id, agent_name" if hourly else "local_date_created AS local_day, ticket_id, agent_name"
    for name, source in (("chat", "live_chat"), ("api", "api")):  # the roster first, then the latest update of the day
        own[f"{name}_known"] = f"SELECT f.*, a.agent_name FROM {source} f JOIN agent a ON a.rostered_id = f.assignee_id"
        own[f"n_{name}"] = extremes(f"{name}_known", ["ticket_id", "local_date_created"], "date_updated", True, f"DISTINCT {row}")
    for name, source in (("email", "mail"), ("web", "web")):  # the latest update of the day first, then status and roster
        own[f"{name}_latest"] = extremes(source, ["ticket_id", "local_date_created"], "date_updated", True)
        own[f"n_{name}"] = f"SELECT DISTINCT {row} FROM {name}_latest f JOIN agent a ON a.rostered_id = f.assignee_id WHERE agent_name IS NOT NULL{done}"
    return own


CHANNELS = ["voice", "chat", "email", "web", "api"]


def hourly_counts() -> dict[str, str]:
    ctes = counted(None, hourly=True)
    each = []
    for c in CHANNELS:
        ctes[f"h_{c}"] = f"SELECT local_day, {hour('at_time')} AS hour_, assignee_id, agent_name, ticket_id FROM n_{c}"
        ctes[f"t_{c}"] = f"SELECT local_day, hour_, agent_name, count(ticket_id) AS h_tickets FROM h_{c} GROUP BY ALL"
        each.append(f"""SELECT DISTINCT f.local_day, f.hour_, f.assignee_id, f.agent_name, {text(c)} AS channel, t.h_tickets FROM h_{c} f
          JOIN t_{c} t ON t.local_day IS NOT DISTINCT FROM f.local_day AND t.hour_ IS NOT DISTINCT FROM f.hour_ AND t.agent_name IS NOT DISTINCT FROM f.agent_name""")
    return ctes | {"hour_counts": " UNION ALL ".join(each)}


def weekly_counts(account: str) -> dict[str, str]:
    ctes = counted(account, hourly=False)
    each = []
    for c in CHANNELS:
        ctes[f"w_{c}"] = f"SELECT {period('week', 'local_day')} AS week_day, agent_name, count(ticket_id) AS tickets FROM n_{c} GROUP BY ALL"
        ctes[f"a_{c}"] = f"SELECT week_day, cast(sum(tickets) AS bigint) AS team_tickets FROM w_{c} GROUP BY week_day"
        each.append(f"SELECT f.week_day, f.agent_name, {text(c)} AS channel, f.tickets, a.team_tickets FROM w_{c} f JOIN a_{c} a ON a.week_day IS NOT DISTINCT FROM f.week_day")
    return ctes | {"week_counts": " UNION ALL ".join(each)}


ORACLE["channel_counts_hourly"] = report(
    hourly_counts(), "hour_counts", {"local_date_created": "local_day"} | {c: c for c in ("hour_", "assignee_id", "agent_name", "channel", "h_tickets")}
)
ORACLE["channel_counts_weekly"] = report(
    weekly_counts(C.roster_account), "week_counts", {"local_date_created": "week_day"} | {c: c for c in ("agent_name", "channel", "tickets", "team_tickets")}
)


def tracked() -> dict[str, str]:
    """Billable ticket work per hour, day, week and month."""
    work = " OR ".join(f"activity LIKE {text(p)}" for p in C.activity_patterns)
    ctes = {
        "entries": f"""SELECT start_date AS local_day, {hour('start_time')} AS hour_, agent_name, supervisor, duration_seconds, {PERIODS.replace('local_day', 'start_date')}
          FROM tracked_time WHERE division_account = {text(C.tracked_division)} AND is_billable AND ({work})""",
    }
    sets = {"h_dur": ["agent_name", "local_day", "hour_"], "d_dur": ["agent_name", "local_day"], "w_dur": ["agent_name", "week_day"], "m_dur": ["agent_name", "month_day"]}
    more, source = grains("entries", "duration_seconds", sets, "sum")
    return ctes | more | {"work_hours": f"SELECT DISTINCT local_day, hour_, agent_name, supervisor, {', '.join(sets)} FROM {source}"}


def manual() -> dict[str, str]:
    """Manual hours summed per alias, shown under the name if there is one."""
    ctes = {"logged": f'SELECT "date" AS local_day, agent_alias, agent_name, duration_seconds, {PERIODS.replace("local_day", chr(34) + "date" + chr(34))} FROM manual_time'}
    names = {"d_dur_manual": "local_day", "w_dur_manual": "week_day", "m_dur_manual": "month_day"}
    for n, p in names.items():
        ctes[f"by_{n}"] = f"SELECT agent_alias, {p}, cast(sum(duration_seconds) AS bigint) AS {n} FROM logged GROUP BY ALL"
    joins = " ".join(f"JOIN by_{n} ON by_{n}.agent_alias IS NOT DISTINCT FROM f.agent_alias AND by_{n}.{p} = f.{p}" for n, p in names.items())
    return ctes | {"manual_hours": f"SELECT DISTINCT f.local_day, coalesce(f.agent_name, f.agent_alias) AS person, {', '.join(names)} FROM logged f {joins}"}


ORACLE["tracked_hours"] = report(
    tracked(), "work_hours", {"start_date_": "local_day", "hour_au": "hour_", "agent_au": "agent_name"} | {c: c for c in ("supervisor", "h_dur", "d_dur", "w_dur", "m_dur")}
)
ORACLE["manual_hours"] = report(manual(), "manual_hours", {'"date"': "local_day", "agent_manual": "person"} | {c: c for c in ("d_dur_manual", "w_dur_manual", "m_dur_manual")})


def rate(tickets: str, tracked_seconds: str, manual_seconds: str) -> str:
    """Tickets per hour by the first kind of hours that applies, else the
    count. Tracked time applies unless it is missing or zero; zero manual time
    counts as missing; if only a zero is known, there is no rate."""
    known = lambda s: f"nullif({s}, 0)"
    hours = f"coalesce({known(tracked_seconds)}, {known(manual_seconds)}) / 3600.0"
    return f"CASE WHEN {known(tracked_seconds)} IS NULL AND {known(manual_seconds)} IS NULL THEN cast({tickets} AS double) ELSE cast({tickets} AS double) / ({hours}) END"


def hourly_productivity() -> str:
    tracked_ctes = {k.replace("graded", "graded_work"): v for k, v in tracked().items()}
    tracked_ctes["work_hours"] = tracked_ctes["work_hours"].replace("FROM graded", "FROM graded_work")
    ctes = {
        **hourly_counts(),
        **tracked_ctes,
        **manual(),
        "team": teams(core=False),
        "facts": """SELECT DISTINCT u.local_day, u.hour_, u.assignee_id, m.agent_name, w.supervisor, m.subteam, m.is_core_team, u.channel, u.h_tickets,
            w.h_dur, w.d_dur, w.w_dur, w.m_dur, l.d_dur_manual, l.w_dur_manual, l.m_dur_manual
          FROM hour_counts u JOIN team m ON m.zendesk_id = u.assignee_id AND u.local_day >= m.valid_from AND u.local_day <= m.valid_to
          LEFT JOIN work_hours w ON w.local_day = u.local_day AND w.hour_ = u.hour_ AND w.agent_name = m.agent_name
          LEFT JOIN manual_hours l ON l.local_day = u.local_day AND l.person = m.agent_name""",
        "dated": f"SELECT *, {PERIODS} FROM facts",
    }
    sets = {"d_tickets": BY_AGENT["daily"], "w_tickets": BY_AGENT["weekly"], "m_tickets": BY_AGENT["monthly"]}
    more, source = grains("dated", "h_tickets", sets, "sum")
    return report(ctes | more, source, HOURLY)


_PLAIN = "hour_ assignee_id agent_name supervisor subteam is_core_team channel h_tickets h_dur d_dur w_dur m_dur d_dur_manual w_dur_manual m_dur_manual d_tickets w_tickets m_tickets"
HOURLY = {"local_date_created": day("local_day")} | {c: c for c in _PLAIN.split()}
HOURLY["h_prod"] = cents(f"if(h_dur IS NULL, cast(h_tickets AS double), {per('h_tickets', 'h_dur / 3600.0')})")
HOURLY |= {f"{p}_prod": cents(rate(f"{p}_tickets", f"{p}_dur", f"{p}_dur_manual")) for p in "dwm"}

ORACLE["productivity_hourly"] = hourly_productivity()


def hourly_productivity_led_once() -> str:
    work = " OR ".join(f"activity LIKE {text(p)}" for p in C.activity_patterns)
    tracked_ctes = {k.replace("graded", "graded_work"): v for k, v in tracked().items()}
    tracked_ctes["work_hours"] = tracked_ctes["work_hours"].replace("FROM graded", "FROM graded_work").replace("supervisor, ", "")
    each = " UNION ALL ".join(f"SELECT DISTINCT {text(c)} AS channel, local_day, at_time, ticket_id, assignee_id FROM n_{c}" for c in CHANNELS)
    ctes = {
        **counted(None, hourly=True),
        **tracked_ctes,
        **manual(),
        "team": teams(core=False),
        "each_ticket": each,
        "duty": """SELECT DISTINCT u.*, cast(u.at_time AS time) AS at, m.agent_name, m.subteam, m.is_core_team
          FROM each_ticket u JOIN team m ON m.zendesk_id = u.assignee_id AND u.local_day >= m.valid_from AND u.local_day <= m.valid_to""",
        **led_once("duty", f"division_account = {text(C.tracked_division)} AND is_billable AND ({work})"),
        "facts": f"""SELECT local_day, {hour('at_time')} AS hour_, assignee_id, agent_name, boss AS supervisor, subteam, is_core_team, channel, count(ticket_id) AS h_tickets
          FROM led GROUP BY ALL""",
        "dated": f"SELECT *, {PERIODS} FROM facts",
    }
    sets = {"d_tickets": BY_AGENT["daily"], "w_tickets": BY_AGENT["weekly"], "m_tickets": BY_AGENT["monthly"]}
    more, source = grains("dated", "h_tickets", sets, "sum")
    more["all_hours"] = f"""SELECT u.*, w.h_dur, w.d_dur, w.w_dur, w.m_dur, l.d_dur_manual, l.w_dur_manual, l.m_dur_manual FROM {source} u
      LEFT JOIN work_hours w ON w.local_day = u.local_day AND w.hour_ = u.hour_ AND w.agent_name = u.agent_name
      LEFT JOIN manual_hours l ON l.local_day = u.local_day AND l.person = u.agent_name"""
    return report(ctes | more, "all_hours", HOURLY)


def first_known(tickets: str, *hours: str) -> str:
    """C11: tickets over the first hours that are known, else the count."""
    whens = " ".join(f"WHEN {h} IS NOT NULL THEN {per(tickets, h)}" for h in hours)
    return f"CASE {whens} ELSE cast({tickets} AS double) END"


ORACLE["productivity_hourly_one_supervisor"] = hourly_productivity_led_once()
ORACLE["productivity_weekly"] = report(
    {
        **weekly_counts(C.roster_account),
        "done": f"SELECT week_day, agent_name, cast(sum(tickets) AS bigint) AS prod_tics FROM week_counts WHERE week_day >= DATE {text(C.weekly_floor)} GROUP BY ALL",
        "active": f"""SELECT {period('week', 't.start_date')} AS week_day, t.agent_name, cast(sum(t.duration_seconds) AS bigint) AS active_s
          FROM tracked_time t JOIN agent a ON a.agent_email = t.agent_email
          WHERE t.client_account = {text(C.tracked_division)} AND t.function = {text(C.tracked_function)} GROUP BY ALL""",
        "logged": f"""SELECT {period('week', '"date"')} AS week_day, agent_name, cast(sum(duration_minutes) AS bigint) AS manual_min FROM manual_time GROUP BY ALL""",
        "rows_": """SELECT d.*, active_s, active_s / 3600.0 AS active_hr, manual_min, manual_min / 60.0 AS dur_hr
          FROM done d LEFT JOIN active t ON t.week_day = d.week_day AND t.agent_name = d.agent_name LEFT JOIN logged l ON l.week_day = d.week_day AND l.agent_name = d.agent_name""",
        "whole": """SELECT week_day, cast(sum(prod_tics) AS bigint) AS team_tics, cast(sum(active_s) AS double) / 3600.0 AS team_hr_au, cast(sum(manual_min) AS double) / 60.0 AS team_hr
          FROM rows_ GROUP BY week_day""",
        "both_": "SELECT r.*, w.team_tics, w.team_hr_au, w.team_hr FROM rows_ r JOIN whole w USING (week_day)",
    },
    "both_",
    {"local_date_created": day("week_day"), "agent_name": "agent_name", "prod_tics": "prod_tics", "team_tics": "team_tics",
     "active_hr": "cast(active_hr AS double)", "team_hr_au": "team_hr_au", "dur_hr": "cast(dur_hr AS double)", "team_hr": "team_hr",
     "prod": first_known("prod_tics", "active_hr", "dur_hr"), "team_prod": first_known("team_tics", "team_hr_au", "team_hr")},
)


def flex_productivity() -> str:
    ctes = weekly_counts(C.flex_roster_account) | {"dated": f"SELECT week_day, agent_name, channel, tickets, {period('month', 'week_day')} AS month_day FROM week_counts"}
    sets = {"prod_tics": ["agent_name", "week_day"], "team_prod": ["week_day"], "prod_tics_m": ["agent_name", "month_day"], "team_prod_m": ["month_day"]}
    more, source = grains("dated", "tickets", sets, "sum")
    columns = {"local_date_created": day("week_day")} | {c: c for c in ("agent_name", "channel", "tickets", *sets)} | {"month_date": day("month_day")}
    columns |= {"flex_prod_w": per("prod_tics", str(C.week_hours)), "team_prod_w": per("team_prod", str(C.week_hours))}
    return report(ctes | more, source, columns | {"flex_prod_m": per("prod_tics_m", str(C.month_hours)), "team_flex_prod_m": per("team_prod_m", str(C.month_hours))})


ORACLE["productivity_flex"] = flex_productivity()


# -------------------------------------------------------- single operators
ORACLE["latest_update_per_ticket"] = statement(
    {"u": updates("ticket_id, channel, date_updated, assignee_id, status")}, extremes("u", ["ticket_id"], "date_updated", True, "DISTINCT *")
)
ORACLE["latest_update_per_ticket_day"] = statement(
    {"u": updates("ticket_id, local_date_created, date_updated, assignee_id")}, extremes("u", ["ticket_id", "local_date_created"], "date_updated", True, "DISTINCT *")
)
ORACLE["first_update_per_ticket"] = statement(
    {"u": updates("ticket_id, local_date_created, date_updated, assignee_id, date_updated - local_date_created AS recent_")}, extremes("u", ["ticket_id"], "recent_", False, "DISTINCT *")
)
ORACLE["longest_wait"] = statement(LONGEST, "SELECT * FROM longest")
ORACLE["current_roster"] = statement(HR_NOW, "SELECT person AS full_name, job_supervisor FROM hr_now")
ORACLE["rated_without_exclusions"] = statement(
    {"u": updates("ticket_id, channel, satisfaction_rating_score", f"{OWN} AND {RATED}")}, f"SELECT DISTINCT * FROM u f WHERE {NOT_EXCLUDED}"
)
ORACLE["rated_without_exclusions_split"] = ORACLE["rated_without_exclusions"]
ORACLE["latest_update_one_scan"] = ORACLE["latest_update_per_ticket"]
ORACLE["first_update_one_scan"] = ORACLE["first_update_per_ticket"]
ORACLE["scd2_team_left"] = statement(
    {"u": updates("ticket_id, date_updated, assignee_id, local_date_created"), "team": teams()}, f"SELECT u.*, m.subteam, m.agent_name FROM u LEFT JOIN team m ON {ON_DUTY}"
)
ORACLE["scd2_team_inner"] = statement(
    {"u": updates("ticket_id, assignee_id, local_date_created"), "team": teams(core=False)},
    f"SELECT DISTINCT u.ticket_id, u.local_date_created, u.assignee_id, m.subteam, m.agent_name, m.is_core_team FROM u JOIN team m ON {ON_DUTY}",
)
ORACLE["asof_supervisor"] = statement(
    {
        "u": updates("ticket_id, local_date_created, assignee_id"),
        "agent": members(C.roster_account),
        "hr": hr_records(),
        "facts": "SELECT DISTINCT u.ticket_id, u.local_date_created, a.agent_name FROM u JOIN agent a ON a.rostered_id = u.assignee_id",
        "moment": """SELECT d.agent_name, d.local_date_created, max(hr.since) AS since FROM (SELECT DISTINCT agent_name, local_date_created FROM facts) d
          JOIN hr ON hr.person = d.agent_name AND hr.since <= d.local_date_created GROUP BY ALL""",
    },
    """SELECT f.ticket_id, f.local_date_created, f.agent_name, hr.supervisor, hr.since AS job_effectivity_date
    FROM facts f JOIN moment m USING (agent_name, local_date_created) JOIN hr ON hr.person = f.agent_name AND hr.since = m.since""",
)
ORACLE["resolve_supervisor"] = statement(
    {"u": updates("assignee_id, local_date_created"), "team": teams(), "tracked": TRACKED_BY, **HR_NOW},
    f"""SELECT DISTINCT u.local_date_created, m.agent_name, coalesce(t.supervisor, h.job_supervisor, {text(C.default_supervisor)}) AS supervisor
    FROM u JOIN team m ON {ON_DUTY} LEFT JOIN tracked t ON t.start_date = u.local_date_created AND t.agent_name = m.agent_name LEFT JOIN hr_now h ON h.person = m.agent_name""",
)


def update_lags() -> str:
    ctes = {
        "u": updates("ticket_id, local_date_created, date_updated, assignee_id"),
        "agent": members(C.roster_account),
        "facts": "SELECT u.ticket_id, u.local_date_created AS local_day, u.date_updated, a.agent_name, u.date_updated - u.local_date_created AS lag_days FROM u LEFT JOIN agent a ON a.rostered_id = u.assignee_id",
        "dated": f"SELECT *, {PERIODS} FROM facts",
    }
    more, source = grains("dated", "lag_days", FLEX)
    return report(ctes | more, source, {"ticket_id": "ticket_id", "local_date_created": "local_day"} | {c: c for c in ("date_updated", "agent_name", "lag_days")} | {n: mean_text(n) for n in FLEX})


ORACLE["update_lag_multi_grain"] = update_lags()


def oracle_sql() -> dict[str, str]:
    return {k: with_fixtures(v) for k, v in ORACLE.items()}
