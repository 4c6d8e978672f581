import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle_compare import compare, duck

from deskpulse.llm import url_filter as uf


def run(globs, texts):
    raw = [t.encode() for t in texts]
    return uf.Automaton(globs).run(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


@settings(max_examples=80, deadline=None)
@given(globs=st.lists(st.text("ab*?", max_size=30), min_size=1, max_size=12), texts=st.lists(st.text("ab?é", max_size=20), min_size=1, max_size=8))
def test_automaton_equals_regex(globs, texts):
    want = [[bool(re.fullmatch(".*".join(map(re.escape, g.split("*"))), t, re.S)) for g in globs] for t in texts]
    assert run(globs, texts).tolist() == want


def test_many_words_and_long_urls():
    globs = [f"*x{i}y*" for i in range(100)]
    got = run(globs, ["a" * 100_000 + "x42y", "x7yx99y", ""])
    assert np.flatnonzero(got[0]).tolist() == [42] and np.flatnonzero(got[1]).tolist() == [7, 99] and not got[2].any()


def test_verdicts_and_defined_cases(spark):
    urls = {
        1: None, 2: "no-scheme/en/", 3: "http://example.com/en/x", 4: "https://WWW.Example.com/en/", 5: "http://a.net/es/1?u=/fr/", 6: "http://net/fr/", 7: "http://xnet/fr/",
        8: "http://example.com", 9: "http://spam-farm.example.org/", 10: "http://a.org/x.net/es/", 11: "http://b.org?://c.net/es/", 12: "http://d.com/#/en/", 13: "",
    }
    rows = [(i, u, "x", 1) for i, u in urls.items()]
    df = spark.createDataFrame(rows + rows[:1], "page_id long, url string, host string, hit int")
    out = uf.judge_urls(df)
    assert out.columns == ["page_id", "url", "host", "hit", "judged"] and out.count() == 14
    got = {r["page_id"]: (r["judged"]["rule"], r["judged"]["verdict"]) for r in out.collect()}
    assert got == {
        1: (None, "allow"), 2: (None, "allow"), 3: ("example.com/en/", "block"), 4: ("www.example.com/en/", "allow"), 5: ("net/es/", "block"), 6: ("net/fr/", "block"), 7: (None, "allow"),
        8: (None, "allow"), 9: (None, "block"), 10: (None, "allow"), 11: (None, "allow"), 12: ("com/", "allow"), 13: (None, "allow"),
    }
    assert uf.judge_urls(df.limit(0)).count() == 0


def test_whole_table_against_sql(spark):
    d = "/root/testdata/sf0.01"
    assert compare(uf.op9_url_filter(spark, d), duck(d), uf.op9_sql())["values_match"]
