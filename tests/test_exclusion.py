"""The Bloom split gives the anti join's rows and shuffles few."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from deskpulse.config import ReportConfig
from deskpulse.operators import exclude_ids, split_by_filter
from deskpulse.plans import csat
from deskpulse.sources import load_tables
from inputs import SMALL

IDS = st.one_of(st.none(), st.integers(0, 40).map(str))


@settings(max_examples=8, deadline=None)
@given(st.lists(IDS, min_size=1, max_size=30), st.lists(IDS, max_size=20), st.sampled_from([1, 1024]))
def test_split_equals_the_anti_join(spark, ids, listed, blocks):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(ids)], "ticket_id string, n int")
    ex = spark.createDataFrame([(k,) for k in listed], "x string")
    rows = lambda **kw: sorted(r["n"] for r in exclude_ids(df, "ticket_id", ex, F.col("x"), **kw).collect())
    got = rows(method="bloom", blocks=blocks)
    assert got == rows() == [i for i, k in enumerate(ids) if k is None or k not in listed]


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_list_above_the_broadcast_limit_moves_few_rows(spark, no_broadcast):
    rated = spark.range(200_000).select(F.col("id").cast("string").alias("ticket_id"))
    listed = spark.range(0, 200_000, 50).select(F.col("id").cast("string").alias("x"))
    possible, clear = split_by_filter(rated, "ticket_id", listed, "x")
    n = possible.count()
    assert 4000 <= n < 0.1 * 200_000 and n < 4100
    assert clear.count() == 200_000 - n
    out = exclude_ids(rated, "ticket_id", listed, F.col("x"), method="bloom")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 196_000
    # rows that the filter clears reach the result without an exchange of their own: only the anti join below has one
    clear_plan = clear._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(ticket_id" not in clear_plan and "BroadcastHashJoin" in clear_plan
    assert "LeftAnti" in plan and "BroadcastNestedLoopJoin" not in plan


def test_reports_are_the_same_with_either_way(spark):
    t = load_tables(spark, SMALL)
    for report in (csat.csat_clean, csat.csat_narrow, csat.csat_flex):
        a, b = (sorted(map(repr, report(t, ReportConfig(exclusions=m)).collect())) for m in ("join", "bloom"))
        assert a == b and a
