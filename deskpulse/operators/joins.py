"""Join operators: validity-interval (SCD2) join, as-of join, current HR record
(J4-J6, J13, C4, C5).

No join carries a broadcast hint: Spark broadcasts a side whose file or
runtime size it has measured below the session's threshold, and otherwise
plans a shuffled join and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskpulse.constants import ACTIVE_PROFILE


def _and(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal-or-both-NULL ``keys`` (a NULL group joins its own
    aggregate, as a window partition would see it).  Keys appear once."""
    rn = {k: f"_r_{i}_{k}" for i, k in enumerate(keys)}
    r = right.select(*[F.col(c).alias(rn.get(c, c)) for c in right.columns])
    cond = _and([F.col(k).eqNullSafe(F.col(rn[k])) for k in keys])
    return left.join(r, cond, how).drop(*rn.values())


#: Keys that the facts of one id are dealt over in a validity join.
VALIDITY_BINS = 16


def _month_number(c) -> Column:
    return F.year(c) * 12 + F.month(c)


def validity_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, fact_date: str,
                  start: str = "start_date", end: str = "end_date", how: str = "left",
                  open_end: bool = False, bins: int = VALIDITY_BINS) -> DataFrame:
    """Match a dimension row valid on the fact's date:
    ``fact_key = dim_key AND fact_date BETWEEN start AND end``.

    The join key is (id, month of the date modulo ``bins``); the range check
    is a residual of the hash join.  An interval is entered under every bin
    that one of its months has, at most ``bins`` of them however long it is,
    so a fact meets each of its intervals once, and an id that holds a large
    share of the facts is ``bins`` keys instead of one.  ``bins=1`` joins by id.

    A NULL ``end`` never matches (BETWEEN with NULL is not true, H10) unless
    ``open_end``; facts without a date match nothing.  Column names of the
    two sides must not clash.
    """
    until = F.col(fact_date) <= F.col(end)
    valid = F.col(start) <= F.col(end)
    if open_end:
        until, valid = until | F.col(end).isNull(), valid | F.col(end).isNull()
    cond = (F.col(fact_key) == F.col(dim_key)) & (F.col(fact_date) >= F.col(start)) & until
    if bins == 1:
        return facts.join(dim, cond, how)
    first, last = _month_number(start), _month_number(end)
    months = F.when(last - first < bins - 1, F.transform(F.sequence(first, last), lambda m: F.pmod(m, F.lit(bins))))
    dealt = (dim.where(valid & F.col(start).isNotNull())
                .withColumn("_dim_bin", F.explode(F.coalesce(months, F.sequence(F.lit(0), F.lit(bins - 1))))))
    binned = facts.withColumn("_fact_bin", F.pmod(_month_number(fact_date), F.lit(bins)))
    return binned.join(dealt, cond & (F.col("_fact_bin") == F.col("_dim_bin")), how).drop("_fact_bin", "_dim_bin")


def asof_nearest(facts: DataFrame, dim: DataFrame, fact_key: str, fact_date: str,
                 dim_key: str, dim_date: str) -> DataFrame:
    """C4: for each fact row, the dimension rows with ``dim_key = fact_key``
    and the latest ``dim_date <= fact_date`` (all rows at that date, so ties
    are kept).  Facts with no such row, or with a NULL key or date, are
    dropped.

    The answer depends only on (key, fact date), so it is found once per
    distinct pair, without pairing every fact date with every earlier
    record, by a scan in two levels.  The distinct pairs and the distinct
    (key, effective date) records are unioned.  Within each (key, month) a
    running ``max`` ordered by date (records before facts on equal dates)
    carries the latest effective date forward; the months' own maxima,
    scanned per key, give the date carried into each month, which is added
    back where a month has no earlier record of its own.  So a window
    partition holds one key's dates of one month, or one row per month of a
    key, whatever the share of the facts or the length of the history of a
    key.  Two equi-joins attach the dimension rows and return to the facts.
    """
    k, t = F.col("_asof_k"), F.col("_asof_t")
    pairs = (facts.select(F.col(fact_key).alias("_asof_k"), F.col(fact_date).alias("_asof_t"))
                  .where(k.isNotNull() & t.isNotNull()).distinct().withColumn("_asof_fact", F.lit(1)))
    eff = (dim.select(F.col(dim_key).alias("_asof_k"), F.col(dim_date).alias("_asof_t"))
              .where(k.isNotNull() & t.isNotNull()).distinct().withColumn("_asof_fact", F.lit(0)))
    binned = lambda df: df.withColumn("_asof_bin", F.trunc("_asof_t", "month"))
    inside = (Window.partitionBy("_asof_k", "_asof_bin").orderBy("_asof_t", "_asof_fact")
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = Window.partitionBy("_asof_k").orderBy("_asof_bin").rowsBetween(Window.unboundedPreceding, -1)
    cur = (binned(pairs.unionByName(eff))
           .withColumn("_asof_own", F.max(F.when(F.col("_asof_fact") == 0, t)).over(inside))
           .where(F.col("_asof_fact") == 1).drop("_asof_fact"))
    # months of a key: with records (their maximum), and with pairs only (which take what is carried in)
    months = (binned(eff).groupBy("_asof_k", "_asof_bin").agg(F.max("_asof_t").alias("_asof_last"))
              .unionByName(binned(pairs).select("_asof_k", "_asof_bin", F.lit(None).cast(eff.schema["_asof_t"].dataType)
                                                .alias("_asof_last")).distinct())
              .groupBy("_asof_k", "_asof_bin").agg(F.max("_asof_last").alias("_asof_last")))
    carried = (months.withColumn("_asof_in", F.max("_asof_last").over(before))
                     .select(k.alias("_asof_ck"), F.col("_asof_bin").alias("_asof_cb"), "_asof_in"))
    cur = (cur.join(carried, (k == F.col("_asof_ck")) & (F.col("_asof_bin") == F.col("_asof_cb")))
              .withColumn("_asof_eff", F.coalesce("_asof_own", "_asof_in"))
              .where(F.col("_asof_eff").isNotNull()).select("_asof_k", "_asof_t", "_asof_eff"))
    best = cur.join(dim,
                    (k == F.col(dim_key)) & (F.col("_asof_eff") == F.col(dim_date)))
    best = (best.drop(dim_key, "_asof_eff")
                .withColumnRenamed("_asof_k", fact_key).withColumnRenamed("_asof_t", fact_date))
    return facts.join(best, [fact_key, fact_date], "inner")


def current_roster(hr: DataFrame, division: str) -> DataFrame:
    """HR rows holding, per full name, the latest status date, the latest
    job date *and* the latest creation date at once; then active ones only.

    Returns distinct (full_name, job_supervisor).  A person none of whose
    rows holds all three maxima has no current record.
    """
    from deskpulse.functions import full_name
    h = (hr.where(F.col("job_division") == division)
           .select(full_name("first_name", "last_name").alias("full_name"), "profile_status",
                   "job_supervisor", "status_effectivity_date", "job_effectivity_date", "created_on"))
    mx = h.groupBy("full_name").agg(
        F.max("status_effectivity_date").alias("_ms"),
        F.max("job_effectivity_date").alias("_mj"),
        F.max("created_on").alias("_mc"))
    mx = mx.withColumnRenamed("full_name", "_fn")
    cur = h.join(mx,
                 (F.col("full_name") == F.col("_fn")) & (F.col("status_effectivity_date") == F.col("_ms"))
                 & (F.col("job_effectivity_date") == F.col("_mj")) & (F.col("created_on") == F.col("_mc")))
    return cur.where(F.col("profile_status") == ACTIVE_PROFILE).select("full_name", "job_supervisor").distinct()
