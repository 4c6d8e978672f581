"""Aggregates of one measure at several grains, attached to every row
(C6 multi-grain average; A2-A5 counts and sums per key; W1-W3, W6).

``AVG(x) OVER (PARTITION BY k)`` on the facts would sort the whole input once
per key set and put every row of a large partition (one busy day, one team)
into a single task; one aggregate and one join per grain would read and
shuffle the facts once per grain.  Here all grains are computed together:

1. one aggregation reduces the measure to mergeable partials (sum, count, NaN
   count) per finest key;
2. one aggregation of those by grouping sets (Spark's ``Expand``) gives the totals
   of every group of every grain in one exchange; each task combines its rows
   first, so a hot period is one row per task and grain;
3. each finest key looks its groups' totals up in one equi-join on (grain,
   masked keys), and one aggregation puts a key's grains side by side;
4. that table is joined with the rows once.

The number of exchanges does not depend on the number of grains.  The tables of
steps 2 and 3 have one row per group, or per finest key and grain, not per fact.
Steps 2 and 3 read the same exchange of step 1 (``ReusedExchange``).

Step 3 has a row per finest key and grain, and where most rows have a finest key
of their own (many agents, few updates a day) that is several times the facts.
For such inputs the caller names an ``anchor`` (the agent) and the keys that
another one implies (week and month of a day):

- grains with the anchor have small groups of finest keys (the days of one
  agent's month).  The table of step 1 is exchanged by the group, its totals are
  aggregated there, and a hash join in place adds them to the rows: one exchange
  per grain, no row per key and grain.  A grain that implies all keys needs none;
- grains without it (teams) have few groups: steps 2 and 3 above on the table
  that has one row per their own keys, joined last, when it is measured small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from deskpulse.operators.joins import null_safe_join


def _unique(seq):
    return list(dict.fromkeys(seq))


def _grouping_number(keys: Sequence[str], grain: frozenset) -> int:
    """What ``grouping_id()`` is for the set: one bit per key, set where the key is left out, the last key lowest."""
    return sum(1 << i for i, k in enumerate(reversed(keys)) if k not in grain)


def grain_table(df: DataFrame, value: str, grains: Mapping[str, Sequence[str]], fn: str = "avg",
                extra_keys: Sequence[str] = (), nan_as_null: bool = False, anchor: str | None = None,
                implied: Mapping[str, str] | None = None) -> DataFrame:
    """One row per finest key (``extra_keys`` + all grain keys) with one
    column per grain: the ``fn`` (avg, sum or count) of ``value`` over the
    rows sharing that grain's keys.  NULL keys form their own group, as in
    a window partition.

    Fractional values are summed as decimals (six places), so a mean does not
    depend on the order of summation; a group that holds a NaN gives NaN (H11)
    unless ``nan_as_null``.

    With an ``anchor`` every grain has that key, and ``implied`` maps keys to the key
    that determines them (see above).
    """
    if anchor is None:
        return grain_tables(df, {value: (grains, fn)}, extra_keys, nan_as_null)
    keys = _unique([*extra_keys, *[k for ks in grains.values() for k in ks]])
    fine = df.groupBy(*keys).agg(*_partials(df, value, 0, nan_as_null))
    return _anchored(df, fine, keys, value, grains, fn, nan_as_null, implied or {})


def grain_tables(df: DataFrame, measures: Mapping[str, tuple[Mapping[str, Sequence[str]], str]],
                 extra_keys: Sequence[str] = (), nan_as_null: bool = False) -> DataFrame:
    """``grain_table`` for several measures at once: value column -> (grains, fn).  All measures and grains
    share the steps above; a key set that several grains use is aggregated once."""
    columns = [(name, value, frozenset(ks), fn) for value, (grains, fn) in measures.items() for name, ks in grains.items()]
    keys = _unique([*extra_keys, *[k for grains, _ in measures.values() for ks in grains.values() for k in ks]])
    of = {v: i for i, v in enumerate(measures)}
    partials = [p for i, value in enumerate(measures) for p in _partials(df, value, i, nan_as_null)]
    finish = lambda value, fn: _finish(df, value, of[value], fn, nan_as_null)
    return _looked_up(df.groupBy(*keys).agg(*partials), keys, columns, finish)


def _looked_up(fine: DataFrame, keys: Sequence[str], columns, finish) -> DataFrame:
    """Steps 2 and 3 on the partials ``fine`` per finest key."""
    sets = _unique(ks for _, _, ks, _ in columns)
    if sets == [frozenset(keys)]:
        return fine.select(*keys, *[finish(value, fn).alias(name) for name, value, _, fn in columns])

    number = {ks: _grouping_number(keys, ks) for ks in sets}
    sums = [c for c in fine.columns if c not in keys]
    totals = fine.groupingSets([[F.col(k) for k in keys if k in ks] for ks in sets], *keys).agg(
        F.grouping_id().cast("bigint").alias("_grain"), *[F.sum(c).alias(c) for c in sums])
    totals = totals.select("_grain", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *sums)
    # The keys keep their own partials in use, so that this side needs the same columns of step 1 as the totals and
    # Spark fills that exchange once.
    asked = fine.select(*keys, *[F.col(c).alias(f"_own{c}") for c in sums],
                        F.explode(F.array(*[F.lit(n).cast("bigint") for n in number.values()])).alias("_g"))
    masked = [F.when(F.col("_g").isin(*[number[ks] for ks in sets if k in ks]), F.col(k)) for k in keys if any(k in ks for ks in sets)]
    places = [i for i, k in enumerate(keys) if any(k in ks for ks in sets)]
    same = [m.eqNullSafe(F.col(f"_k{i}")) for i, m in zip(places, masked)]
    found = asked.join(totals, reduce(lambda a, b: a & b, same, F.col("_grain") == F.col("_g")))

    impossible = reduce(lambda a, b: a & b, [F.col(f"_own{c}") == F.lit(-1) for c in sums], F.col("_own_n0") < 0)
    out = [F.max(F.when((F.col("_g") == number[ks]) & ~F.coalesce(impossible, F.lit(False)), finish(value, fn))).alias(name)
           for name, value, ks, fn in columns]
    return found.groupBy(*keys).agg(*out)


def _implies_all(grain: Sequence[str], keys: Sequence[str], implied: Mapping[str, str]) -> bool:
    return all(k in grain or implied.get(k) in grain for k in keys)


def _anchored(df: DataFrame, fine: DataFrame, keys: Sequence[str], value: str, grains: Mapping[str, Sequence[str]],
              fn: str, nan_as_null: bool, implied: Mapping[str, str]) -> DataFrame:
    """Grains of small groups: ``fine`` meets each grain's totals where an exchange by the grain's keys puts it."""
    sums = [c for c in fine.columns if c not in keys]
    total = _finish(df, value, 0, fn, nan_as_null)
    own = [name for name, ks in grains.items() if _implies_all(ks, keys, implied)]
    x = fine.select("*", *[total.alias(name) for name in own])
    for name, ks in grains.items():
        if name in own:
            continue
        # A struct of keys may hold NULLs and is itself never NULL.  The hashes keep every column in use on both sides, so
        # that both readers of the exchange need the same columns and Spark fills it once (as in ``keep_extreme``).
        placed = x.select("*", F.struct(*ks).alias("_group")).repartition("_group")
        found = placed.groupBy("_group").agg(*[F.sum(c).alias(c) for c in sums], F.bit_xor(F.xxhash64(*x.columns)).alias("_used"))
        found = found.select(F.col("_group").alias("_total_of"), total.alias(name), "_used")
        counted = (F.col("_n0") >= 0) | (F.xxhash64(*x.columns) == F.col("_used"))  # always true
        # a task's totals are fewer than its rows, and a hot group is one of them: hashed, the rows need no sort
        x = placed.join(found.hint("shuffle_hash"), (F.col("_group") == F.col("_total_of")) & counted)
        # keys that need both sides: a filter of theirs stays above the join, or only one of the readers would have it
        x = x.select(*[F.when(F.col("_used").isNotNull(), F.col(k)).alias(k) for k in keys], *placed.columns[len(keys):-1], name)
    return x.select(*keys, *grains)


def _fractional(df: DataFrame, value: str) -> bool:
    return isinstance(df.schema[value].dataType, (DoubleType, FloatType))


def _partials(df: DataFrame, value: str, i: int, nan_as_null: bool) -> list[Column]:
    """Mergeable parts of one measure: sum and count, and for fractional values the number of NaN."""
    v = F.col(value)
    if not _fractional(df, value):
        return [F.sum(v).alias(f"_s{i}"), F.count(v).alias(f"_n{i}")]
    nan = F.isnan(v)
    return [F.sum(F.when(~nan, v.cast("decimal(24,6)"))).alias(f"_s{i}"),
            F.count(F.when(~nan, v) if nan_as_null else v).alias(f"_n{i}"),
            F.count(F.when(nan, 1)).alias(f"_nan{i}")]


def _finish(df: DataFrame, value: str, i: int, fn: str, nan_as_null: bool) -> Column:
    s, n = F.col(f"_s{i}"), F.col(f"_n{i}")
    if fn == "count":
        return n
    fractional = _fractional(df, value)
    poisoned = F.col(f"_nan{i}") > 0 if fractional and not nan_as_null else F.lit(False)
    if fn == "avg":
        return F.when(poisoned, F.lit(float("nan"))).when(n > 0, s.cast("double") / n)
    if fn == "sum":
        return F.when(poisoned, F.lit(float("nan"))).otherwise(s.cast("double")) if fractional else s
    raise ValueError(fn)


def attach_grains(df: DataFrame, value: str, grains: Mapping[str, Sequence[str]], fn: str = "avg",
                  nan_as_null: bool = False, anchor: str | None = None, implied: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` with one extra column per grain (see ``grain_table``).  With an ``anchor``, grains may leave it out."""
    if anchor is None:
        keys = _unique([k for ks in grains.values() for k in ks])
        return null_safe_join(df, grain_table(df, value, grains, fn, nan_as_null=nan_as_null), keys)
    implied = implied or {}
    anchored = {name: ks for name, ks in grains.items() if anchor in ks}
    others = {name: ks for name, ks in grains.items() if anchor not in ks}
    keys = _unique([k for ks in grains.values() for k in ks])
    base = lambda ks: [k for k in ks if implied.get(k) not in ks]
    fine = df.groupBy(*keys).agg(*_partials(df, value, 0, nan_as_null))
    out = null_safe_join(df, _anchored(df, fine, keys, value, anchored, fn, nan_as_null, implied)
                         .select(*base(keys), *anchored), base(keys))
    if others:
        few = _unique([k for ks in others.values() for k in ks])
        sums = [c for c in fine.columns if c not in keys]
        table = _looked_up(fine.groupBy(*few).agg(*[F.sum(c).alias(c) for c in sums]), few,
                           [(name, value, frozenset(ks), fn) for name, ks in others.items()],
                           lambda value, fn: _finish(df, value, 0, fn, nan_as_null))
        out = null_safe_join(out, table.select(*base(few), *others), base(few))
    return out.select(*df.columns, *grains)
