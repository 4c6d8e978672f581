"""Inputs that are written when a report asks for them."""

import datetime as dt
import os

from deskpulse.sources.fixtures import fixture_tables
from deskpulse.sources.tables import load_tables

DAY = dt.date(1996, 3, 1)


def write_source(spark, root):
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None]
    tables = {
        "orders": ([(i, i, p, "F", DAY, 100.0) for i, p in enumerate(priorities)] + [(None, 1, "2-HIGH", "O", None, None)],
                   "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_orderstatus string, o_orderdate date, o_totalprice double"),
        "lineitem": ([(i, s, 1, 5.0, "A", "F", DAY) for i in (0, 1, 2, 2, 3, 4, 5, None) for s in (1, 1, None)],
                     "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate date"),
        "nation": ([(0, "N", 0)], "n_nationkey bigint, n_name string, n_regionkey bigint"),
        "region": ([(0, "R")], "r_regionkey bigint, r_name string"),
        "supplier": ([(1, "S", 0, 5.0), (1, "S", 0, 5.0)], "s_suppkey bigint, s_name string, s_nationkey bigint, s_acctbal double"),
        "events": ([(3, 1, "click", 70.0, dt.datetime(2024, 1, 1))], "event_id bigint, user_id bigint, event_type string, value double, ts timestamp_ntz"),
        "labels": ([(1, 1)], "doc_id bigint, toxic int"),
    }
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_only_used_inputs_are_written_and_updates_once(spark, tmp_path):
    sf = write_source(spark, tmp_path)
    t = load_tables(spark, sf, on_use=True)
    assert t.web_tickets.count() == 3
    path = t.web_tickets.inputFiles()[0].removeprefix("file:")
    root = path[: path.index("/_updates")]
    assert os.listdir(root) == ["_updates"]
    lazy = fixture_tables(spark, sf)
    for name, df in lazy.items():
        got = getattr(t, name)
        assert got.columns == df.columns and sorted(map(repr, got.collect())) == sorted(map(repr, df.collect())), name
    assert not {"email_tickets", "chat_tickets", "call_tickets", "web_tickets"} & set(os.listdir(root))
