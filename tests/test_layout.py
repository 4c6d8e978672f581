"""Inputs partitioned by date; date floors become partition filters."""

import re

import pytest
from pyspark.sql import functions as F

from deskpulse.plans import attendance as att, frt, wait
from deskpulse.sources import load_tables
from deskpulse.sources.layout import PARTITION_DATES, write_partitioned
from deskpulse.sources.tables import SCHEMAS, Tables
from inputs import SMALL

DAYS = "1996-03-20", "1996-04-20"  # around the wait-time floor, to keep the number of folders small


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    t = load_tables(spark, SMALL)
    near = {}
    for name in SCHEMAS:
        df, day = getattr(t, name), PARTITION_DATES.get(name)
        known = day in df.columns
        near[name] = df.where(F.col(day).between(*DAYS) | F.col(day).isNull()) if known else df
    plain = Tables(**near)
    root = str(tmp_path_factory.mktemp("by_day"))
    write_partitioned(plain, root)
    return plain, Tables.from_parquet(spark, root)


REPORTS = {
    "R4": (lambda t: wait.wait_time_supervisor(t), "local_date_created"),
    "R7": (lambda t: frt.frt_multi_grain(t, channel="chat"), "local_date_created"),
    "R9": (lambda t: frt.frt_multi_grain(t, channel="email"), "local_date_created"),
    "R16": (lambda t: att.attendance(t), "shift_day"),
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_floors_are_partition_filters(both, name):
    report, day = REPORTS[name]
    plain, by_day = both
    assert sorted(map(repr, report(plain).collect())) == sorted(map(repr, report(by_day).collect()))
    found = re.findall(r"PartitionFilters: \[([^\]]*)\]", report(by_day)._jdf.queryExecution().executedPlan().toString())
    assert any(re.search(rf"{day}#\d+ >= ", f) for f in found), found


def test_the_floor_also_prunes_the_tracked_time_it_is_joined_with(both):
    plan = wait.wait_time_supervisor(both[1])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*start_date#\d+ >= ", plan)


def test_a_selective_dimension_prunes_days_at_run_time(spark, both, tmp_path):
    spark.createDataFrame([("1996-04-02", "holiday"), ("1996-04-05", "open")], "day string, kind string").select(
        F.col("day").cast("date").alias("day"), "kind").write.parquet(str(tmp_path / "cal"))
    cal = spark.read.parquet(str(tmp_path / "cal")).where("kind = 'holiday'")
    x = both[1].call_tickets.join(cal, F.col("local_date_created") == F.col("day"))
    assert "dynamicpruning" in x._jdf.queryExecution().executedPlan().toString()
    assert x.count() == both[0].call_tickets.where("local_date_created = date'1996-04-02'").count()


def test_rows_without_a_date_are_kept(spark, tmp_path):
    t = load_tables(spark, SMALL)
    legs = t.call_legs.limit(20).withColumn("local_date", F.when(F.col("wait_time") > "02", F.col("local_date")))
    rows = [tuple(r) for r in legs.collect()]
    write_partitioned(Tables(**{**{n: getattr(t, n) for n in SCHEMAS}, "call_legs": spark.createDataFrame(rows, legs.schema)}),
                      str(tmp_path), ["call_legs"])
    back = spark.read.parquet(str(tmp_path / "call_legs")).select(*legs.columns)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))
