"""The fixture inputs as plain SQL views (DuckDB dialect), for oracle checks.

Mirrors ``deskpulse.sources.fixtures`` expression by expression; the test
suite checks that both give identical rows.
"""

from __future__ import annotations


def _acct(k):
    return f"CASE WHEN {k} % 10 = 0 THEN 'acct_b' ELSE 'acct_a' END"


def _pad2(x):
    return f"if(length(cast({x} AS varchar)) < 2, lpad(cast({x} AS varchar), 2, '0'), cast({x} AS varchar))"


def _agent(x):
    return f"(({x} + 1) // 2)"


def _person(x):
    return f"'NATION ' || cast({x} AS varchar)"


def _mail(x):
    return f"'nation.' || cast({x} AS varchar) || '@example.com'"


TICKET_COLS = ("client_account, ticket_id, channel, status, type, tags, assignee_id, "
               "local_date_created, local_time_created, date_updated, "
               "satisfaction_rating_score, satisfaction_rating_comment")

FIXTURE_VIEWS: dict[str, str] = {
    "fx_ticket": f"""
SELECT {_acct('o.o_custkey')} AS client_account,
  cast(o.o_orderkey AS varchar) AS ticket_id,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'voice' WHEN '2-HIGH' THEN 'chat'
    WHEN '3-MEDIUM' THEN 'email' WHEN '4-NOT SPECIFIED' THEN 'web' ELSE 'api' END AS channel,
  CASE o.o_orderstatus WHEN 'F' THEN 'solved' WHEN 'P' THEN 'closed' ELSE 'open' END AS status,
  CASE WHEN o.o_orderkey % 3 = 0 THEN 'question' ELSE 'incident' END AS type,
  'tier_' || lower(o.o_orderstatus) AS tags,
  cast(l.l_suppkey AS varchar) AS assignee_id,
  cast(o.o_orderdate AS date) AS local_date_created,
  {_pad2('o.o_orderkey % 24')} || ':30:00' AS local_time_created,
  cast(l.l_shipdate AS date) AS date_updated,
  CASE l.l_returnflag WHEN 'A' THEN 'good' WHEN 'R' THEN 'bad' END AS satisfaction_rating_score,
  CASE l.l_returnflag WHEN 'A' THEN 'thanks' WHEN 'R' THEN 'too slow' END AS satisfaction_rating_comment,
  CASE WHEN o.o_orderkey % 13 = 0 THEN 'outbound' WHEN o.o_orderkey % 17 = 0 THEN NULL
    ELSE 'inbound' END AS via_source_rel
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
    "email_tickets": f"SELECT {TICKET_COLS} FROM fx_ticket WHERE channel IN ('email', 'api')",
    "chat_tickets": f"SELECT {TICKET_COLS} FROM fx_ticket WHERE channel = 'chat'",
    "call_tickets": f"SELECT {TICKET_COLS}, via_source_rel FROM fx_ticket WHERE channel = 'voice'",
    "web_tickets": f"SELECT {TICKET_COLS} FROM fx_ticket WHERE channel = 'web'",
    "call_legs": f"""
SELECT {_acct('user_id')} AS client_account,
  cast(event_id // 3 AS varchar) AS ticket_id,
  CASE event_type WHEN 'error' THEN 'Voicemail' WHEN 'view' THEN NULL ELSE 'Agent' END AS forwarded_to,
  event_type AS status,
  {_pad2('cast(floor(value / 60) AS bigint)')} || ':' || {_pad2('cast(floor(value) AS bigint) % 60')} AS wait_time,
  cast(DATE '1998-01-01' + cast(event_id % 365 AS integer) AS date) AS local_date,
  {_pad2('hour(ts)')} || ':00:00' AS local_time
FROM events""",
    "chat_insights": f"""
SELECT {_acct('o_custkey')} AS client_account,
  cast(o_orderkey AS varchar) AS ticket_id,
  CASE WHEN o_orderkey % 23 = 0 THEN 'offline' ELSE 'chat' END AS type,
  cast(o_orderdate AS date) AS local_date,
  CASE WHEN o_orderkey % 50 = 0 THEN cast('NaN' AS double)
       WHEN o_orderkey % 17 = 0 THEN NULL
       ELSE cast(cast(floor(o_totalprice / 100) AS bigint) AS double) END AS response_time_first,
  CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey % 300 END AS abandon_time
FROM orders WHERE o_orderpriority = '2-HIGH'""",
    "email_metrics": """
SELECT cast(o_orderkey AS varchar) AS ticket_id,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 1440 END AS reply_time_calendar_minutes
FROM orders WHERE o_orderpriority = '3-MEDIUM'""",
    "agent_roster": f"""
SELECT CASE WHEN {_agent('s_suppkey')} % 4 = 3 THEN 'acct_a_flex' ELSE 'acct_a' END AS client_account,
  cast(s_suppkey AS varchar) AS assignee_id, {_person(_agent('s_suppkey'))} AS agent_name, {_mail(_agent('s_suppkey'))} AS agent_email
FROM supplier WHERE s_suppkey % 6 <> 5""",
    "kpi_summary": """
SELECT DISTINCT t.client_account, t.ticket_id, t.channel, a.agent_name, t.assignee_id,
  t.satisfaction_rating_score, t.local_date_created, m.reply_time_calendar_minutes AS frt_calendar
FROM email_tickets t JOIN email_metrics m ON m.ticket_id = t.ticket_id
LEFT JOIN agent_roster a ON a.assignee_id = t.assignee_id
WHERE t.channel = 'email'""",
    "subteams": f"""
SELECT cast(s_suppkey AS varchar) AS zendesk_id, {_person(_agent('s_suppkey'))} AS agent_name, {_mail(_agent('s_suppkey'))} AS agent_email,
  r_name AS subteam, DATE '1995-01-01' AS start_date, DATE '1998-06-30' AS end_date, {_agent('s_suppkey')} % 7 <> 0 AS is_core_team
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
UNION ALL
SELECT cast(s_suppkey AS varchar), {_person(_agent('s_suppkey'))}, {_mail(_agent('s_suppkey'))},
  r_name, DATE '1998-07-01', CASE WHEN s_suppkey % 25 <> 24 THEN DATE '2001-12-31' END, {_agent('s_suppkey')} % 7 <> 0
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = (n_regionkey + 1) % 5""",
    "tracked_time": f"""
SELECT CASE WHEN l_suppkey % 10 = 0 THEN 'Division B' ELSE 'Division A' END AS client_account,
  CASE WHEN l_suppkey % 10 = 0 THEN 'Division B' ELSE 'Division A' END AS division_account,
  CASE WHEN l_suppkey % 10 = 0 THEN 'Division B' ELSE 'Division A' END AS division_name,
  CASE WHEN l_linenumber = 7 THEN 'Training' ELSE 'Service Delivery' END AS function,
  {_person(_agent('l_suppkey'))} AS agent_name,
  {_mail(_agent('l_suppkey'))} AS agent_email,
  'SUP_' || cast(l_suppkey % 6 AS varchar) AS supervisor,
  CASE WHEN l_linestatus = 'F' THEN 'Ticket Active' WHEN l_linenumber = 1 THEN 'Helpdesk Review'
       ELSE 'Break' END AS activity,
  cast(l_shipdate AS date) AS start_date,
  {_pad2('l_orderkey % 24')} || ':00:00' AS start_time,
  cast(l_quantity * 60 AS bigint) AS duration_seconds,
  l_returnflag <> 'N' AS is_billable
FROM lineitem""",
    "hr_roster": f"""
SELECT 'NATION' AS first_name, cast({_agent('s_suppkey')} AS varchar) AS last_name,
  'sup' || cast(s_suppkey AS varchar) || '@example.com' AS email_address,
  'Support' AS job_department,
  CASE WHEN s_suppkey % 9 = 0 THEN 'Other' ELSE 'Care' END AS job_division,
  CASE WHEN s_acctbal < 1000 THEN 'Inactive' ELSE 'Active' END AS profile_status,
  s_name AS job_supervisor,
  make_date(cast(1995 + moment % 3 AS integer), 1, 1) AS status_effectivity_date,
  make_date(cast(1993 + moment % 6 AS integer), cast(1 + moment % 12 AS integer), 1) AS job_effectivity_date,
  make_date(cast(1994 + moment % 2 AS integer), 1, 1) AS created_on
FROM (SELECT *, CASE WHEN {_agent('s_suppkey')} % 5 = 0 THEN {_agent('s_suppkey')} ELSE s_suppkey END AS moment FROM supplier)""",
    "manual_time": f"""
SELECT cast(o_orderdate AS date) AS "date",
  {_person('o_custkey // 30')} AS agent_alias,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL
       WHEN o_orderkey % 7 = 0 THEN {_person('(o_custkey // 30 + 1)')}
       ELSE {_person('o_custkey // 30')} END AS agent_name,
  (o_orderkey % 8) * 900 AS duration_seconds,
  (o_orderkey % 8) * 15 AS duration_minutes
FROM orders WHERE o_orderstatus = 'F'""",
    "dsat_exclusions": """
SELECT cast(doc_id AS varchar) || '.0' AS ext_interaction_id FROM labels WHERE toxic = 1""",
    "attendance": f"""
SELECT {_acct('user_id')} AS client_account,
  'agent' || cast(user_id AS varchar) || '@example.com' AS agent_email,
  'NATION ' || cast(user_id % 25 AS varchar) AS agent_name,
  ts AS shift_start,
  ts + INTERVAL 8 HOUR AS shift_end,
  ts + to_minutes(cast(event_id % 20 AS bigint)) AS clock_in,
  CASE WHEN event_type <> 'error'
       THEN ts + INTERVAL 8 HOUR + to_minutes(cast(event_id % 30 AS bigint)) END AS clock_out,
  event_id % 2 AS absenteeism,
  event_id % 3 AS tardiness
FROM events""",
}


def with_fixtures(body: str) -> str:
    """Put every fixture view as a CTE before ``body`` (and before its own CTEs)."""
    ctes = ",\n".join(f"{k} AS ({v}\n)" for k, v in FIXTURE_VIEWS.items())
    return f"WITH {ctes},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {ctes}\n{body}"
