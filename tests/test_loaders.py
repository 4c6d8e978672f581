"""The loaders bring real tables to the contract: columns, types, text ids."""

import datetime as dt

from pyspark.sql import functions as F

from inputs import SMALL
from deskpulse.plans import csat
from deskpulse.sources.fixtures import fixture_tables
from deskpulse.sources.tables import SCHEMAS, TYPES, Tables, conform


def test_ids_of_any_type_become_the_same_text(spark):
    for kind in ("bigint", "double", "decimal(20,0)", "string", "int"):
        df = spark.range(3).select((F.col("id") + 7).cast("bigint").cast(kind).alias("ticket_id"),
                                   F.lit(5).cast("int").alias("reply_time_calendar_minutes"), F.lit("x").alias("extra"))
        out = conform(df, "email_metrics")
        assert out.columns == SCHEMAS["email_metrics"] and dict(out.dtypes)["ticket_id"] == "string"
        assert sorted(r["ticket_id"] for r in out.collect()) == ["7", "8", "9"]


def test_dates_and_flags_are_cast(spark):
    schema = ", ".join(f"{c} string" for c in SCHEMAS["subteams"])
    row = conform(spark.createDataFrame([("1", "A", "a@x", "T", "2024-01-02", None, "true")], schema), "subteams").first()
    assert row["start_date"] == dt.date(2024, 1, 2) and row["is_core_team"] is True


def test_text_dates_are_read_in_either_form(spark):
    schema = ", ".join(f"{c} string" for c in SCHEMAS["subteams"])
    rows = [("1", "A", "a@x", "T", "01/31/2024", "2024-02-01", "true"), ("2", "A", "a@x", "T", "31/31/2024", "", "true")]
    got = [(r["start_date"], r["end_date"]) for r in conform(spark.createDataFrame(rows, schema), "subteams").orderBy("zendesk_id").collect()]
    assert got == [(dt.date(2024, 1, 31), dt.date(2024, 2, 1)), (None, None)]


def test_reports_on_text_dates_equal_those_on_dates(spark):
    tables = fixture_tables(spark, SMALL)
    texts = {k: conform(df.select(*[F.date_format(c, "MM/dd/yyyy").alias(c) if TYPES.get(c) == "date" else c for c in df.columns]), k)
             for k, df in tables.items()}
    plain, parsed = (sorted(map(repr, csat.csat_flex(t).collect())) for t in (Tables(**tables), Tables(**texts)))
    assert plain == parsed and plain


def test_bigint_and_text_ids_give_the_same_report(spark, tmp_path):
    tables = fixture_tables(spark, SMALL)
    names = {}
    for k, df in tables.items():
        ids = [c for c in ("ticket_id", "assignee_id", "zendesk_id") if c in df.columns]
        df.select(*[F.col(c).cast("bigint") if c in ids else F.col(c) for c in df.columns]).createOrReplaceTempView(f"raw_{k}")
        df.write.parquet(str(tmp_path / k))
        names[k] = f"raw_{k}"
    numeric, text = Tables.from_catalog(spark, names), Tables.from_parquet(spark, str(tmp_path))
    rows = [sorted(map(repr, csat.csat_raw(t).collect())) for t in (numeric, text)]
    assert rows[0] == rows[1] and rows[0]
    assert set(TYPES) <= {c for cols in SCHEMAS.values() for c in cols}
