from brute import union_find
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from deskpulse.llm.components import components


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components_equal_union_find(spark, edges):
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    edges = [e for e in edges if e[0] != e[1]]
    want = union_find({x for e in edges for x in e}, edges)
    assert {r["node"]: r["component_id"] for r in components(df).collect()} == want


def test_long_chain(spark):
    df = spark.range(200).selectExpr("id as a", "id + 1 as b")
    out = components(df)
    assert out.count() == 201 and out.select("component_id").distinct().count() == 1
