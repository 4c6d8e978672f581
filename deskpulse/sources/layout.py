"""Inputs partitioned by date (S1, Q9): the layout of large report inputs.

The reports' date floors are plain comparisons of date columns.  Where a table
is partitioned by that column they become partition filters: days before the
floor are never listed or read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from deskpulse.sources.tables import DERIVED, SCHEMAS, Tables

#: Input -> the date column it is partitioned by.
PARTITION_DATES = {
    **dict.fromkeys(["email_tickets", "chat_tickets", "call_tickets", "web_tickets", "kpi_summary"], "local_date_created"),
    **dict.fromkeys(["call_legs", "chat_insights"], "local_date"),
    "tracked_time": "start_date",
    "manual_time": "date",
    "attendance": "shift_day",
}


def write_partitioned(tables: Tables, root: str, names=None) -> None:
    """Write inputs (all, or ``names``) under ``root/<name>`` as parquet, those
    of ``PARTITION_DATES`` with one folder per day; ``Tables.from_parquet``
    reads them.

    Rows are rebalanced by day before the write: adaptive execution puts small
    days together in a task and splits a day that holds a large share of the
    rows over several, so neither a task nor a file grows with a hot day.
    Rows without a date keep a folder of their own.  An empty input is written
    without folders, so that its columns can still be read.
    """
    for name in names or SCHEMAS:
        df = getattr(tables, name)
        day = PARTITION_DATES.get(name)
        if day is None or df.isEmpty():
            df.write.mode("overwrite").parquet(f"{root}/{name}")
            continue
        if day not in df.columns:
            df = df.withColumn(day, F.to_date(DERIVED[name][day]))
        df.hint("rebalance", F.col(day)).write.mode("overwrite").partitionBy(day).parquet(f"{root}/{name}")
