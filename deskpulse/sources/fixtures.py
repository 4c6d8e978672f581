"""Report inputs derived from the driver's TPC-H-style parquet tables.

The mapping is fixed (see FIXTURES.md); it turns orders/lineitem into
ticket updates, events into call legs and shifts, nation/region/supplier
into rosters, and labels into rating exclusions.  Every table is a lazy
DataFrame over the parquet scan, so filters and projections of the reports
reach the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskpulse.sources.tables import SCHEMAS


def _pad2(c):
    s = c.cast("string")  # longer numbers stay whole
    return F.when(F.length(s) < 2, F.lpad(s, 2, "0")).otherwise(s)


def _acct(key):
    return F.when(key % 10 == 0, F.lit("acct_b")).otherwise(F.lit("acct_a"))


def _name(num):
    return F.concat(F.lit("NATION "), num.cast("string"))


def _email(num):
    return F.concat(F.lit("nation."), num.cast("string"), F.lit("@example.com"))


def _agent(supplier_key):
    """Agent number of a supplier key: two ids per agent."""
    return F.floor((supplier_key + 1) / 2).cast("bigint")


def ticket_updates(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row per ticket update: orders are tickets, line items updates."""
    o, l = orders.alias("o"), lineitem.alias("l")
    j = o.join(l, F.col("l.l_orderkey") == F.col("o.o_orderkey"))
    key, cust = F.col("o.o_orderkey"), F.col("o.o_custkey")
    return j.select(
        _acct(cust).alias("client_account"),
        key.cast("string").alias("ticket_id"),
        F.when(F.col("o.o_orderpriority") == "1-URGENT", "voice")
         .when(F.col("o.o_orderpriority") == "2-HIGH", "chat")
         .when(F.col("o.o_orderpriority") == "3-MEDIUM", "email")
         .when(F.col("o.o_orderpriority") == "4-NOT SPECIFIED", "web")
         .otherwise("api").alias("channel"),
        F.when(F.col("o.o_orderstatus") == "F", "solved")
         .when(F.col("o.o_orderstatus") == "P", "closed")
         .otherwise("open").alias("status"),
        F.when(key % 3 == 0, "question").otherwise("incident").alias("type"),
        F.concat(F.lit("tier_"), F.lower(F.col("o.o_orderstatus"))).alias("tags"),
        # every update has the agent of its supplier, so tickets change hands and agents grow with the data
        F.col("l.l_suppkey").cast("string").alias("assignee_id"),
        F.col("o.o_orderdate").cast("date").alias("local_date_created"),
        F.concat(_pad2(key % 24), F.lit(":30:00")).alias("local_time_created"),
        F.col("l.l_shipdate").cast("date").alias("date_updated"),
        F.when(F.col("l.l_returnflag") == "A", "good")
         .when(F.col("l.l_returnflag") == "R", "bad").alias("satisfaction_rating_score"),
        F.when(F.col("l.l_returnflag") == "A", "thanks")
         .when(F.col("l.l_returnflag") == "R", "too slow").alias("satisfaction_rating_comment"),
        F.when(key % 13 == 0, "outbound").when(key % 17 == 0, F.lit(None))
         .otherwise("inbound").alias("via_source_rel"),
    )


def fixture_tables(spark: SparkSession, sf_dir: str, updates: DataFrame | None = None) -> dict[str, DataFrame]:
    rd = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    orders, lineitem, nation = rd("orders"), rd("lineitem"), rd("nation")
    region, supplier, events, labels = rd("region"), rd("supplier"), rd("events"), rd("labels")

    upd = ticket_updates(orders, lineitem) if updates is None else updates
    tcols = SCHEMAS["email_tickets"]
    email = upd.where(F.col("channel").isin("email", "api")).select(*tcols)
    chat = upd.where(F.col("channel") == "chat").select(*tcols)
    call = upd.where(F.col("channel") == "voice").select(*SCHEMAS["call_tickets"])
    web = upd.where(F.col("channel") == "web").select(*tcols)

    e = events
    legs = e.select(
        _acct(F.col("user_id")).alias("client_account"),
        F.floor(F.col("event_id") / 3).cast("string").alias("ticket_id"),
        F.when(F.col("event_type") == "error", "Voicemail")
         .when(F.col("event_type") == "view", F.lit(None))
         .otherwise("Agent").alias("forwarded_to"),
        F.col("event_type").alias("status"),
        F.concat(_pad2(F.floor(F.col("value") / 60)), F.lit(":"),
                 _pad2(F.floor(F.col("value")) % 60)).alias("wait_time"),
        F.date_add(F.lit(dt.date(1998, 1, 1)), (F.col("event_id") % 365).cast("int")).alias("local_date"),
        F.concat(_pad2(F.hour("ts")), F.lit(":00:00")).alias("local_time"),
    )

    hi = orders.where(F.col("o_orderpriority") == "2-HIGH")
    k = F.col("o_orderkey")
    insights = hi.select(
        _acct(F.col("o_custkey")).alias("client_account"),
        k.cast("string").alias("ticket_id"),
        F.when(k % 23 == 0, "offline").otherwise("chat").alias("type"),
        F.col("o_orderdate").cast("date").alias("local_date"),
        F.when(k % 50 == 0, F.lit(float("nan")))
         .when(k % 17 == 0, F.lit(None).cast("double"))
         .otherwise(F.floor(F.col("o_totalprice") / 100).cast("double")).alias("response_time_first"),
        F.when(k % 9 == 0, k % 300).alias("abandon_time"),
    )

    metrics = orders.where(F.col("o_orderpriority") == "3-MEDIUM").select(
        k.cast("string").alias("ticket_id"),
        F.when(k % 11 != 0, k % 1440).alias("reply_time_calendar_minutes"),
    )

    s = F.col("s_suppkey")
    agent = _agent(s)
    roster = supplier.where(s % 6 != 5).select(  # every sixth id is not rostered
        F.when(agent % 4 == 3, "acct_a_flex").otherwise("acct_a").alias("client_account"),
        s.cast("string").alias("assignee_id"),
        _name(agent).alias("agent_name"),
        _email(agent).alias("agent_email"),
    )

    t, m, a = email.alias("t"), metrics.alias("m"), roster.alias("a")
    kpi = (t.where(F.col("t.channel") == "email")
           .join(m, F.col("m.ticket_id") == F.col("t.ticket_id"))
           .join(a, F.col("a.assignee_id") == F.col("t.assignee_id"), "left")
           .select("t.client_account", "t.ticket_id", "t.channel", "a.agent_name", "t.assignee_id",
                   "t.satisfaction_rating_score", "t.local_date_created",
                   F.col("m.reply_time_calendar_minutes").alias("frt_calendar"))
           .distinct())

    def era(region_key, start, end):
        n = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        return n.join(region, F.col("r_regionkey") == region_key).select(
            s.cast("string").alias("zendesk_id"),
            _name(agent).alias("agent_name"),
            _email(agent).alias("agent_email"),
            F.col("r_name").alias("subteam"),
            F.lit(start).alias("start_date"),
            end.alias("end_date"),
            (agent % 7 != 0).alias("is_core_team"),
        )
    subteams = era(F.col("n_regionkey"), dt.date(1995, 1, 1), F.lit(dt.date(1998, 6, 30))).unionByName(
        era((F.col("n_regionkey") + 1) % 5, dt.date(1998, 7, 1),
            F.when(s % 25 != 24, F.lit(dt.date(2001, 12, 31)))))

    sk = F.col("l_suppkey")
    div = F.when(sk % 10 == 0, "Division B").otherwise("Division A")
    tracked = lineitem.select(
        div.alias("client_account"), div.alias("division_account"), div.alias("division_name"),
        F.when(F.col("l_linenumber") == 7, "Training").otherwise("Service Delivery").alias("function"),
        _name(_agent(sk)).alias("agent_name"),
        _email(_agent(sk)).alias("agent_email"),
        F.concat(F.lit("SUP_"), (sk % 6).cast("string")).alias("supervisor"),
        F.when(F.col("l_linestatus") == "F", "Ticket Active")
         .when(F.col("l_linenumber") == 1, "Helpdesk Review")
         .otherwise("Break").alias("activity"),
        F.col("l_shipdate").cast("date").alias("start_date"),
        F.concat(_pad2(F.col("l_orderkey") % 24), F.lit(":00:00")).alias("start_time"),
        (F.col("l_quantity") * 60).cast("bigint").alias("duration_seconds"),
        (F.col("l_returnflag") != "N").alias("is_billable"),
    )

    # two records per person; every fifth person's two records share their dates
    when = F.when(agent % 5 == 0, agent).otherwise(s)
    hr = supplier.select(
        F.lit("NATION").alias("first_name"),
        agent.cast("string").alias("last_name"),
        F.concat(F.lit("sup"), s.cast("string"), F.lit("@example.com")).alias("email_address"),
        F.lit("Support").alias("job_department"),
        F.when(s % 9 == 0, "Other").otherwise("Care").alias("job_division"),
        F.when(F.col("s_acctbal") < 1000, "Inactive").otherwise("Active").alias("profile_status"),
        F.col("s_name").alias("job_supervisor"),
        F.make_date((1995 + when % 3).cast("int"), F.lit(1), F.lit(1)).alias("status_effectivity_date"),
        F.make_date((1993 + when % 6).cast("int"), (1 + when % 12).cast("int"), F.lit(1)).alias("job_effectivity_date"),
        F.make_date((1994 + when % 2).cast("int"), F.lit(1), F.lit(1)).alias("created_on"),
    )

    c = F.col("o_custkey")
    alias = F.floor(c / 30).cast("bigint")
    manual = orders.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderdate").cast("date").alias("date"),
        _name(alias).alias("agent_alias"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
         .when(k % 7 == 0, _name(alias + 1))
         .otherwise(_name(alias)).alias("agent_name"),
        ((k % 8) * 900).alias("duration_seconds"),
        ((k % 8) * 15).alias("duration_minutes"),
    )

    excl = labels.where(F.col("toxic") == 1).select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".0")).alias("ext_interaction_id"))

    ts, eid = F.col("ts"), F.col("event_id")
    eight = F.make_dt_interval(F.lit(0), F.lit(8))
    attendance = e.select(
        _acct(F.col("user_id")).alias("client_account"),
        F.concat(F.lit("agent"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("agent_email"),
        _name(F.col("user_id") % 25).alias("agent_name"),
        ts.alias("shift_start"),
        (ts + eight).alias("shift_end"),
        (ts + F.make_dt_interval(F.lit(0), F.lit(0), (eid % 20).cast("int"))).alias("clock_in"),
        F.when(F.col("event_type") != "error",
               ts + eight + F.make_dt_interval(F.lit(0), F.lit(0), (eid % 30).cast("int"))).alias("clock_out"),
        (eid % 2).alias("absenteeism"),
        (eid % 3).alias("tardiness"),
    )

    return {
        "email_tickets": email, "chat_tickets": chat, "call_tickets": call, "web_tickets": web,
        "call_legs": legs, "chat_insights": insights, "email_metrics": metrics, "kpi_summary": kpi,
        "attendance": attendance, "agent_roster": roster, "subteams": subteams,
        "tracked_time": tracked, "hr_roster": hr, "manual_time": manual, "dsat_exclusions": excl,
    }


#: Ticket input -> the channels of the updates that it holds.
CHANNELS = {"email_tickets": ("email", "api"), "chat_tickets": ("chat",), "call_tickets": ("voice",), "web_tickets": ("web",)}


def input_writer(spark: SparkSession, sf_dir: str, out_root: str) -> Callable[[str], DataFrame]:
    """``write(name)``: writes one input under ``out_root`` and returns the scan of its files.

    The updates are joined and written once, with one folder per ticket input; the four inputs are
    scans of their folders, so no update is written a second time."""
    derived = fixture_tables(spark, sf_dir)
    made = {}

    def updates() -> DataFrame:
        if "updates" not in made:
            upd = ticket_updates(*(spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("orders", "lineitem")))
            named = [F.when(F.col("channel").isin(*channels), name) for name, channels in CHANNELS.items()]
            upd = upd.withColumn("_input", F.coalesce(*named))
            upd.write.mode("overwrite").partitionBy("_input").parquet(f"{out_root}/_updates")
            made["updates"] = spark.read.schema(upd.schema).parquet(f"{out_root}/_updates")
        return made["updates"]

    def write(name: str) -> DataFrame:
        if name in CHANNELS:
            return updates().where(F.col("_input") == name).select(*SCHEMAS[name])
        df = derived[name]
        if name == "kpi_summary":
            df = fixture_tables(spark, sf_dir, updates().where(F.col("_input") == "email_tickets"))[name]
        df.write.mode("overwrite").parquet(f"{out_root}/{name}")
        return spark.read.parquet(f"{out_root}/{name}").select(*SCHEMAS[name])

    return write


# Inputs keyed by ticket: bucketing them on ticket_id (same bucket count for
# all) lets per-ticket aggregations and ticket-to-ticket joins run without a
# shuffle.  A deployment would lay out its fact tables the same way.
TICKET_KEYED = ("email_tickets", "chat_tickets", "call_tickets", "web_tickets", "call_legs",
                "chat_insights", "email_metrics", "kpi_summary")


def write_fixtures(spark: SparkSession, sf_dir: str, out_root: str, table_prefix: str | None = None,
                   buckets: int | None = None) -> dict[str, str]:
    """Write every input once under ``out_root/<name>`` (a shared folder on a
    cluster), so reports scan real files.

    With ``table_prefix`` the ticket-keyed inputs are saved as catalog tables
    bucketed by ``ticket_id`` (``buckets`` buckets, default: one per core);
    returns name -> catalog table for those, the rest are plain parquet.
    """
    buckets = buckets or max(spark.sparkContext.defaultParallelism, 8)
    tables = {}
    rd = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    # the updates feed five inputs: joined once, then scanned
    ticket_updates(rd("orders"), rd("lineitem")).write.mode("overwrite").parquet(f"{out_root}/_updates")
    updates = spark.read.parquet(f"{out_root}/_updates")
    for name, df in fixture_tables(spark, sf_dir, updates).items():
        path = f"{out_root}/{name}"
        if table_prefix and name in TICKET_KEYED:
            tname = f"{table_prefix}_{name}"
            (df.write.bucketBy(buckets, "ticket_id").sortBy("ticket_id").mode("overwrite")
               .option("path", path).saveAsTable(tname))
            tables[name] = tname
        else:
            df.write.mode("overwrite").parquet(path)
    return tables
