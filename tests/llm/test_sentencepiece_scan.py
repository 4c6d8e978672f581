import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deskpulse.llm import sentencepiece_scan as scan

with open(scan.MODEL, "rb") as f:
    PROTO = f.read()


class Model:
    value = PROTO


def scanned(text: str, size: int, fan: int = 16) -> list:
    """The scan's stages without Spark, in chunks of ``size`` characters."""
    v = scan.vocabulary(PROTO)
    norm = scan.SPACE + text.replace(" ", scan.SPACE)
    n, rows = -(-len(norm) // size), []
    for k in range(n):
        a, b = max(k * size - v.longest, 0), min((k + 1) * size + v.longest, len(norm))
        rows.append({"key": "x", "k": k, "chunks": n, "part": norm[a:b], "lead": k * size - a, "stop": min((k + 1) * size, len(norm)) - a})
    t = [r for x in scan._transfer([pa.RecordBatch.from_pylist(rows)], Model) for r in x.to_pylist()]
    for r, x in zip(rows, around(t, fan), strict=True):
        r |= {"enter": x["enter"], "leave": x["leave"]}
    return [i for b in scan._backtrace([pa.RecordBatch.from_pylist(rows)], Model) for i in b.column("ids").to_pylist()[0]]


def around(level: list[dict], fan: int) -> list[dict]:
    """The rounds of ``scan.borders`` without Spark."""
    if len(level) == 1:
        return [{"k": level[0]["k"], "enter": level[0]["left"][0], "leave": level[0]["right"][0]}]
    groups = [[r | {"above": k // fan} for r in level[k : k + fan]] for k in range(0, len(level), fan)]
    up = around([scan._product(pa.Table.from_pylist(g)).to_pylist()[0] for g in groups], fan)
    tables = [pa.Table.from_pylist([r | {"enter": u["enter"], "leave": u["leave"]} for r in g]) for g, u in zip(groups, up, strict=True)]
    return [r for t in tables for r in scan._inside(t).to_pylist()]


@settings(max_examples=60, deadline=None)
@given(text=st.text(st.sampled_from(list("abe thinr\n.é珍日€🙂")) | st.characters(blacklist_categories=["Cs"]), min_size=1, max_size=250), size=st.integers(33, 120), fan=st.integers(2, 4))
def test_scan_equals_the_library(text, size, fan):
    assert scanned(text, size, fan) == scan.processor(PROTO).encode(text)


STATES = [(s, e) for s in (-2, -1) for e in (0, 1)]
MATRIX = st.tuples(st.just(STATES), st.dictionaries(st.sampled_from(STATES), st.integers(1, 15)))


@settings(max_examples=200, deadline=None)
@given(a=MATRIX, b=MATRIX, c=MATRIX)
def test_products_are_associative(a, b, c):
    assert scan.multiply(scan.multiply(a, b), c) == scan.multiply(a, scan.multiply(b, c))


@settings(max_examples=150, deadline=None)
@given(text=st.text(st.sampled_from(list("ab  the\n▁.é珍日€🙂")) | st.characters(blacklist_categories=["Cs"]), max_size=80))
def test_word_by_word_equals_the_library(text):
    w = scan.words(PROTO)
    assert w.apart and np.frombuffer(w.encode(text), np.int32).tolist() == scan.processor(PROTO).encode(text)


@pytest.mark.parametrize("text", [" " * 500, "a" * 700, "the " * 300, "aaaa bbbb" * 60, "▁" * 100 + "x"])
def test_runs(text):
    assert scanned(text, 64) == scan.processor(PROTO).encode(text)


def test_giants_and_edges(spark, monkeypatch):
    monkeypatch.setattr(scan, "GIANT", 2000)
    monkeypatch.setattr(scan, "CHUNK", 700)
    rng = random.Random(6)
    words = ["then", "of", "inandtion", "Käse", "日本", "\n", "x1", ""]
    giant = " ".join(rng.choice(words) for _ in range(2500))
    texts = {1: giant, 2: None, 3: "", 4: "short  text ", 5: giant[::-1], 6: "with ▁ inside"}
    rows = [(i, t, "k", 1) for i, t in texts.items()]
    df = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, key string, k int")
    p = scan.processor(PROTO)
    out = scan.encode(df)
    assert out.columns == ["doc_id", "text", "key", "k", "ids"]
    got = [(r["doc_id"], r["ids"]) for r in out.collect()]
    assert sorted(i for i, _ in got) == [1, 1, 2, 2, 3, 4, 5, 6]
    assert all(ids == (None if texts[i] is None else p.encode(texts[i])) for i, ids in got)
    back = {r["doc_id"]: r["decoded"] for r in scan.decode(out).collect()}
    assert {i: t for i, t in back.items() if i != 6} == {i: t for i, t in texts.items() if i != 6}
    exact = {r["doc_id"]: r["exact"] for r in scan.tokenized(df).collect()}
    assert exact == {1: True, 2: True, 3: True, 4: True, 5: True, 6: False}
    assert scan.tokenized(df.limit(0)).count() == 0


def test_chunks_of_one_text_are_many_tasks_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(scan, "GIANT", 1000)
    monkeypatch.setattr(scan, "CHUNK", 300)
    monkeypatch.setattr(scan, "FAN", 3)
    rng = random.Random(9)
    text = " ".join(rng.choice(["inandtion", "then", "Käse", "日本", "x1"]) for _ in range(2500))
    seen = spark.sparkContext.accumulator(0)
    traced = scan._backtrace

    def counted(it, model):
        n = 0
        for b in traced(it, model):
            n += 1
            yield b
        seen.add(1 if n else 0)

    monkeypatch.setattr(scan, "_backtrace", counted)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert scan.encode(df).first()["ids"] == scan.processor(PROTO).encode(text)
    assert seen.value > 5


def test_whole_table(spark):
    d = "/root/testdata/sf0.001"
    out = scan.op5_sentencepiece(spark, d).collect()
    assert len(out) == 200 and all(r["exact"] and r["n_tokens"] > 0 for r in out)
