"""Top-k and report order."""

from hypothesis import given, settings, strategies as st

from inputs import SMALL
from deskpulse.plans import attendance, csat, frt, productivity, wait
from deskpulse.plans.common import top_k
from deskpulse.sources import load_tables

ORDER = [("d", "desc"), ("name", "asc")]


def reference(data):
    """Descending keys put NULL first, ascending ones last; the rest are ties."""
    return sorted(data, key=lambda r: (r[0] is not None, -(r[0] or 0), r[1] is None, r[1] or "", r[2]))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(["a", "b", None]),
                          st.integers(0, 3)), min_size=0, max_size=60),
       st.integers(1, 12))
def test_cap_and_order(spark, data, k):
    df = spark.createDataFrame(data, "d int, name string, x int").repartition(7)
    cols = ["d", "name", "x"]
    assert [tuple(r) for r in top_k(df, ORDER, k, cols).collect()] == reference(data)[:k]
    assert [tuple(r) for r in top_k(df, ORDER, None, cols, ordered=True).collect()] == reference(data)
    assert top_k(df, ORDER, None, cols).count() == len(data)


def test_every_report_has_its_order(spark):
    t = load_tables(spark, SMALL)
    reports = [attendance.attendance, frt.frt_multi_grain, frt.frt_email_kpi, frt.frt_email_flex, frt.frt_chat_flex,
               frt.frt_chat_asof, csat.csat_raw, csat.csat_clean, csat.csat_narrow, csat.csat_flex,
               productivity.productivity_hourly, productivity.productivity_weekly, productivity.productivity_flex,
               wait.wait_time_supervisor, wait.wait_time_multi_grain]
    for report in reports:
        plain, sorted_ = report(t), report(t, ordered=True)
        assert plain.columns == sorted_.columns
        assert "Sort [" in sorted_._jdf.queryExecution().optimizedPlan().toString(), report


def test_caps_cut_the_newest_rows(spark):
    t = load_tables(spark, SMALL)
    for report in (attendance.attendance, productivity.productivity_hourly, frt.frt_chat_asof):
        whole = [repr(r) for r in report(t, ordered=True).collect()]  # repr: NaN equals NaN
        assert [repr(r) for r in report(t, cap=5).collect()] == whole[:5]
