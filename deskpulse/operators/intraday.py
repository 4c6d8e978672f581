"""The value in effect at a time of day (C15, H7), such as the supervisor an
agent was under when a ticket came in.

Entries of tracked time begin at times of a day and carry a value.  A join on
(agent, day) alone gives a ticket every value of the day; here entries are
merged into intervals within the day, and a ticket meets exactly one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def day_intervals(entries: DataFrame, keys: Sequence[str], at: str, value: str) -> DataFrame:
    """Runs of entries with the same ``value`` within each ``keys`` group
    (agent and day): (keys, value, ``_from``, ``_until``) in seconds of the day.

    A run lasts until the next one begins, the last one to the end of the day,
    and the first one also holds before its first entry, so the intervals of a
    group cover the day once.  Of entries that begin in the same second the
    smallest value counts; entries without value, time or key are left out.

    The entries are first reduced to one row per second (partial aggregation on
    every task), so a window partition holds at most the seconds of one day of
    one agent, however many entries there are.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, at, value]])
    begun = entries.where(known).groupBy(*keys, at).agg(F.min(value).alias(value))
    in_day = Window.partitionBy(*keys).orderBy(at)
    turns = (begun.withColumn("_before", F.lag(value).over(in_day))
                  .where(F.col("_before").isNull() | (F.col("_before") != F.col(value))))
    return turns.select(*keys, value, F.when(F.col("_before").isNull(), F.lit(0)).otherwise(F.col(at)).alias("_from"),
                        F.lead(at).over(in_day).alias("_until"))


def in_effect(facts: DataFrame, intervals: DataFrame, fact_keys: Sequence[str], at: str, keys: Sequence[str],
              value: str) -> DataFrame:
    """Every row of ``facts`` once, with the ``value`` of the interval that
    holds at ``at`` (seconds of the day; NULL counts as the day's first
    second), NULL if its day has no interval.  A hash join on the keys with the
    range check as residual; ``facts`` has no column named ``value``."""
    names = {k: f"_iv{i}" for i, k in enumerate(keys)}
    iv = intervals.select(*[F.col(k).alias(n) for k, n in names.items()], value, "_from", "_until")
    moment = F.coalesce(F.col(at), F.lit(0))
    cond = reduce(lambda a, b: a & b, [F.col(f) == F.col(names[k]) for f, k in zip(fact_keys, keys)])
    cond = cond & (moment >= F.col("_from")) & (F.col("_until").isNull() | (moment < F.col("_until")))
    return facts.join(iv, cond, "left").drop(*names.values(), "_from", "_until")
