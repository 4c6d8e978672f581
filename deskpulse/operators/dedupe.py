"""Extreme rows per key, ties kept."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskpulse.functions import mmss_to_seconds


#: Bins that the rows of one key are dealt over.
KEY_BINS = 16


def keep_extreme(df: DataFrame, keys: Sequence[str], order_col: str, largest: bool = True,
                 method: str = "join", bins: int = KEY_BINS) -> DataFrame:
    """Rows whose ``order_col`` equals the max (``largest``) or min over
    ``keys``; every tied row is kept, rows with a NULL ``order_col`` never are
    (same result as ``col = max(col) OVER (PARTITION BY keys)``).

    ``method="bins"`` reads its input once, in two levels.  The rows
    are exchanged once, by (keys, bin), where the bin is a hash of the whole
    row.  A bin's extreme needs no further exchange.  The extremes of a key's
    bins, at most ``bins`` short entries, meet in one group, which names the
    bins that hold the key's extreme; rows are kept by a join on (keys, bin)
    that finds them where they already are.  A key with a third of the rows is
    ``bins`` partitions, even when all its rows tie.  Columns of map type can't be
    hashed; use another method for them.

    ``method="join"`` (default): the extreme per key comes from a grouped aggregation,
    and rows are kept by an equi-join on (keys, extreme value).  The input is
    read twice; adaptive execution broadcasts the extremes when they are
    measured small, and then no row is shuffled.

    ``method="window"``: ``rank() = 1`` over (keys ordered by ``order_col``);
    Spark plans a ``WindowGroupLimit`` on both sides of the shuffle.  One
    pass over the input, but all rows of one key meet in one task.
    """
    c = F.col(order_col)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(c.desc() if largest else c.asc())
        return (df.where(c.isNotNull())
                  .withColumn("_rank", F.rank().over(w))
                  .where(F.col("_rank") == 1)
                  .drop("_rank"))
    agg = F.max if largest else F.min
    if method == "bins":
        return _keep_extreme_of_bins(df, keys, order_col, agg, largest, bins)
    ext = df.groupBy(*keys).agg(agg(order_col).alias("_ext"))
    rn = {k: f"_ek{i}" for i, k in enumerate(keys)}
    ext = ext.select(*[F.col(k).alias(rn[k]) for k in keys], "_ext")
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(rn[k])) for k in keys]) & (c == F.col("_ext"))
    return df.join(ext, cond, "inner").drop(*rn.values(), "_ext")


def _keep_extreme_of_bins(df: DataFrame, keys: Sequence[str], order_col: str, agg, largest: bool, bins: int) -> DataFrame:
    # As a struct, equal keys may hold NULLs, and the join below needs no other partitioning than the one made here.
    # Neither key is nullable: an inferred not-null filter would make the two readers' exchanges differ.
    x = (df.where(F.col(order_col).isNotNull())
           .select("*", F.struct(*keys).alias("_key"), F.coalesce(F.pmod(F.xxhash64(*df.columns), F.lit(bins)), F.lit(0)).alias("_bin"))
           .repartition("_key", "_bin"))
    # The hash keeps every column in use, so that both readers of the exchange need the same columns and Spark fills
    # it once (``ReusedExchange``).
    per_bin = x.groupBy("_key", "_bin").agg(agg(order_col).alias("_ext"), F.bit_xor(F.xxhash64(*df.columns)).alias("_used"))
    per_key = per_bin.groupBy("_key").agg(agg("_ext").alias("_best"), F.collect_list(F.struct("_bin", "_ext", "_used")).alias("_bins"))
    won = (per_key.select(F.col("_key").alias("_wkey"), F.explode(F.filter("_bins", lambda b: b["_ext"] == F.col("_best"))).alias("_w"))
                  .where(F.col("_w._used").isNotNull())
                  .select("_wkey", F.col("_w._bin").alias("_wbin"), F.col("_w._ext").alias("_wext")))
    # no row of a winning bin is beyond its extreme, so this is equality, kept out of the join's keys
    at_extreme = F.col(order_col) >= F.col("_wext") if largest else F.col(order_col) <= F.col("_wext")
    return (x.join(won, (F.col("_key") == F.col("_wkey")) & (F.col("_bin") == F.col("_wbin")) & at_extreme)
             .select(*df.columns))


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Latest rows per key (ties kept)."""
    return keep_extreme(df, keys, ts, largest=True)


def first_per_key(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """First (smallest) rows per key (ties kept)."""
    return keep_extreme(df, keys, col, largest=False)


def longest_wait(legs: DataFrame, account: str, compare: str = "seconds") -> DataFrame:
    """The longest call leg(s) of each ticket of ``account``.

    Returns distinct (ticket_id, status, dur) where ``dur`` is the wait in
    seconds.  ``compare="seconds"`` picks the longest by seconds;
    ``compare="text"`` picks the largest 'mm:ss' text, which is the same
    for zero-padded text.
    """
    x = (legs.where(F.col("client_account") == account)
             .select("ticket_id", "status", "wait_time")
             .withColumn("dur", mmss_to_seconds("wait_time")))
    order = "dur" if compare == "seconds" else "wait_time"
    x = keep_extreme(x, ["ticket_id"], order, largest=True)
    return x.select("ticket_id", "status", "dur").distinct()
