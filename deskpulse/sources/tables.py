"""The fifteen report inputs and their column contracts."""

from __future__ import annotations

import hashlib
import os
import threading

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, NumericType

from deskpulse.functions import parse_us_date

# Column contract of each input.  Ids (ticket, assignee, roster id) are text
# everywhere, so joins never need casts on either side (J2); the loaders cast
# real tables to the types below.
TICKET_COLS = ["client_account", "ticket_id", "channel", "status", "type", "tags",
               "assignee_id", "local_date_created", "local_time_created", "date_updated",
               "satisfaction_rating_score", "satisfaction_rating_comment"]

SCHEMAS = {
    "email_tickets": TICKET_COLS,
    "chat_tickets": TICKET_COLS,
    "call_tickets": TICKET_COLS + ["via_source_rel"],
    "web_tickets": TICKET_COLS,
    "call_legs": ["client_account", "ticket_id", "forwarded_to", "status", "wait_time",
                  "local_date", "local_time"],
    "chat_insights": ["client_account", "ticket_id", "type", "local_date",
                      "response_time_first", "abandon_time"],
    "email_metrics": ["ticket_id", "reply_time_calendar_minutes"],
    "kpi_summary": ["client_account", "ticket_id", "channel", "agent_name", "assignee_id",
                    "satisfaction_rating_score", "local_date_created", "frt_calendar"],
    "attendance": ["client_account", "agent_email", "agent_name", "shift_start", "shift_end",
                   "clock_in", "clock_out", "absenteeism", "tardiness"],
    "agent_roster": ["client_account", "assignee_id", "agent_name", "agent_email"],
    "subteams": ["zendesk_id", "agent_name", "agent_email", "subteam", "start_date",
                 "end_date", "is_core_team"],
    "tracked_time": ["client_account", "division_account", "division_name", "function",
                     "agent_name", "agent_email", "supervisor", "activity", "start_date",
                     "start_time", "duration_seconds", "is_billable"],
    "hr_roster": ["first_name", "last_name", "email_address", "job_department",
                  "job_division", "profile_status", "job_supervisor",
                  "status_effectivity_date", "job_effectivity_date", "created_on"],
    "manual_time": ["date", "agent_alias", "agent_name", "duration_seconds",
                    "duration_minutes"],
    "dsat_exclusions": ["ext_interaction_id"],
}


#: Types of the contract; columns that are not listed are text.
TYPES = {
    **dict.fromkeys(["local_date_created", "date_updated", "local_date", "start_date", "end_date", "date",
                     "status_effectivity_date", "job_effectivity_date", "created_on"], "date"),
    **dict.fromkeys(["shift_start", "shift_end", "clock_in", "clock_out"], "timestamp"),
    **dict.fromkeys(["abandon_time", "reply_time_calendar_minutes", "frt_calendar", "absenteeism", "tardiness",
                     "duration_seconds", "duration_minutes"], "bigint"),
    **dict.fromkeys(["is_core_team", "is_billable"], "boolean"),
    "response_time_first": "double",
}


#: Columns that a date-partitioned layout adds to an input: name -> the column whose date it is.
DERIVED = {"attendance": {"shift_day": "shift_start"}}


def conform(df: DataFrame, name: str) -> DataFrame:
    """The contract columns of one input in the contract's types.  Whole
    numbers become id text without a decimal part, whatever numeric type the
    source stores them in; dates stored as text are read as ISO or mm/dd/yyyy
    dates (F3; NULL for other text).  Columns that already fit stay bare, so
    filters on them reach the scan.  A partition column of ``DERIVED`` is kept
    if the source has it."""
    out = []
    for c in SCHEMAS[name]:
        want, have = TYPES.get(c, "string"), df.schema[c].dataType
        col = F.col(c)
        if isinstance(have, NumericType) and isinstance(have, (DoubleType, FloatType, DecimalType)) and want == "string":
            col = col.cast("decimal(38,0)")
        if isinstance(have, NumericType) and want in ("bigint", "double"):
            want = have.simpleString()  # numbers keep their own width
        if want == "date" and have.simpleString() == "string":
            out.append(F.coalesce(col.try_cast("date"), parse_us_date(col)).alias(c))
            continue
        out.append((col if have.simpleString() == want else col.cast(want)).alias(c))
    return df.select(*out, *[c for c in DERIVED.get(name, ()) if c in df.columns])


@dataclass
class Tables:
    email_tickets: DataFrame
    chat_tickets: DataFrame
    call_tickets: DataFrame
    web_tickets: DataFrame
    call_legs: DataFrame
    chat_insights: DataFrame
    email_metrics: DataFrame
    kpi_summary: DataFrame
    attendance: DataFrame
    agent_roster: DataFrame
    subteams: DataFrame
    tracked_time: DataFrame
    hr_roster: DataFrame
    manual_time: DataFrame
    dsat_exclusions: DataFrame
    _small: dict = field(default_factory=dict, repr=False)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: dict[str, str]) -> "Tables":
        """Bind each input to a catalog table: ``names`` maps field -> table."""
        return cls(**{k: conform(spark.table(v), k) for k, v in names.items()})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> "Tables":
        """Read each input from ``root/<field>`` parquet (e.g. written by
        ``deskpulse.sources.fixtures.write_fixtures``, or partitioned by date by
        ``deskpulse.sources.layout.write_partitioned``)."""
        return cls(**{k: conform(spark.read.parquet(f"{root}/{k}"), k) for k in SCHEMAS})


class TablesOnUse(Tables):
    """Tables whose inputs are made one by one: ``make(name)`` gives an input when it is first used."""

    __repr__ = object.__repr__

    @classmethod
    def over(cls, make) -> "TablesOnUse":
        t = object.__new__(cls)
        t._small, t._make, t._making = {}, make, threading.RLock()
        return t

    def __getattr__(self, name):
        if name not in SCHEMAS or "_make" not in self.__dict__:
            raise AttributeError(name)
        with self._making:
            if name not in self.__dict__:
                self.__dict__[name] = self._make(name)
            return self.__dict__[name]


_loaded: dict = {}
_lock = threading.RLock()


def load_tables(spark: SparkSession, sf_dir: str, materialize: bool = True,
                bucket_inputs: bool = False, on_use: bool = False) -> Tables:
    """Inputs derived from the driver's parquet tables under ``sf_dir``.

    With ``materialize`` (the default) the fifteen derived inputs are
    written once per application as parquet under the shared checkpoint
    folder (``spark.checkpoint.dir``), and every report then scans those
    files, the way reports scan their source tables in a deployment:
    filters and column pruning reach the files and the planner sees real
    table sizes.  Without it the inputs stay lazy views over ``sf_dir``.
    With ``on_use`` an input is written when a report first asks for it, so
    one report alone writes only the inputs that it reads.
    ``bucket_inputs`` saves the ticket-keyed inputs as tables bucketed by
    ticket_id (shuffle-free per-ticket aggregation and ticket joins); on
    sf0.1 in local mode it was slower (97 s vs 75 s for all queries), so it
    is off by default.
    """
    with _lock:
        t = _load_tables(spark, sf_dir, materialize, bucket_inputs)
    if not on_use:
        for name in SCHEMAS:
            getattr(t, name)
    return t


def _load_tables(spark: SparkSession, sf_dir: str, materialize: bool, bucket_inputs: bool) -> Tables:
    from deskpulse.sources.fixtures import fixture_tables, input_writer, write_fixtures
    if not materialize:
        return Tables(**fixture_tables(spark, sf_dir))
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), bucket_inputs)
    if key in _loaded:
        return _loaded[key]
    from deskpulse.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    if base is None:  # no shared folder named: keep the inputs lazy
        _loaded[key] = Tables(**fixture_tables(spark, sf_dir))
        return _loaded[key]
    base = base.rstrip("/")
    tag = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:12]
    # one folder per application: the checkpoint folder is shared, so two
    # applications must never overwrite each other's inputs
    app = spark.sparkContext.applicationId
    root = f"{base}/deskpulse-inputs/{app}/{tag}"
    if not bucket_inputs:
        _loaded[key] = TablesOnUse.over(input_writer(spark, sf_dir, root))
        return _loaded[key]
    prefix = "deskpulse_in_" + hashlib.sha1(f"{app}/{tag}".encode()).hexdigest()[:12]
    bucketed = write_fixtures(spark, sf_dir, f"{root}-bucketed", table_prefix=prefix)
    frames = {k: (spark.table(bucketed[k]) if k in bucketed else spark.read.parquet(f"{root}-bucketed/{k}"))
              for k in SCHEMAS}
    _loaded[key] = Tables(**{k: v.select(*SCHEMAS[k]) for k, v in frames.items()})
    return _loaded[key]
