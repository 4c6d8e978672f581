import hashlib

from brute import pii_base

from deskpulse.llm import pii
from deskpulse.llm.io import table

SCHEMA = "doc_id long, text string, found string, c int, candidates int"
CASES = [
    "", None, "a.b@c.de f@g h@i.j_k@l.m x+y%z@a-b.c-d. +@.", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.004 00000000001.1.1.1 9999999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111114111", "+1 (017) 555-7713 +49 30 1234 +1) 2 +12345678901234567", "é€ 4111111111111111 é a@b.c",
    "1" * 20_000, "1 " * 20_000, "+" + "1 " * 5_000, "a" * 30_000 + "@", "a.b@" * 2_000, "x@y" + ".z" * 5_000, "7." * 20_000,
]


def test_base_spans_equal_the_plain_patterns(spark):
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(CASES)]
    out = {r["doc_id"]: r["base"] for r in pii.pii_spans(spark.createDataFrame(rows + rows[2:4], SCHEMA)).collect()}
    assert {i: [tuple(s) for s in v] for i, v in out.items()} == {i: sorted(pii_base(t or "")) for i, t in enumerate(CASES)}


def test_contract_digest_and_whole_table(spark):
    d = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in table(spark, d, "documents").collect()}
    for r in pii.op4_pii(spark, d).collect():
        base = pii_base(texts[r["doc_id"]])
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == i for x in base) for i in range(4)]
        assert set(said.split(",")) <= set(r["spans"].split(","))


def test_the_method_adds_likely_spans_and_leaves_unlikely_ones(spark):
    good = [(i, f"call (0{i % 10}7) 555-77{i % 90 + 10} or +1 (017) 555-77{i % 90 + 10}, mail u{i}@h.com", "x", 1, 2) for i in range(300)]
    bad = [(1000 + i, f"order {4000000000000000 + 7 * i + (1 if i % 2 else 0)} of 12 at 10:30", "x", 1, 2) for i in range(300)]
    d = spark.createDataFrame(good + bad, SCHEMA)
    out = {r["doc_id"]: r for r in pii.pii_spans(d).collect()}
    assert all(len(out[i]["spans"]) == len(out[i]["base"]) + 1 for i in range(300))
    assert all(out[i]["spans"] == out[i]["base"] for i in range(1000, 1300))


def test_redaction(spark):
    rows = [(1, "€ mail a.b@c.org, 1.2.3.4 or +1 (017) 555-7713.", "x", 1, 2), (2, None, "x", 1, 2), (3, "", "x", 1, 2)]
    out = pii.redact_pii(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "found", "c", "candidates"]
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "€ mail [EMAIL], [IP] or [PHONE].", 2: None, 3: ""}
    assert pii.redact_pii(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = pii.pii_spans(table(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
