"""Operator 13: spelling variants against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import pyarrow as pa

from brute import lower
from deskpulse.llm import spelling

SMALL = "/root/testdata/sf0.001"


def counted(rows):
    out = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lower(w)
            h = zlib.crc32(f"{i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += len(w) >= 7
    return {w: n for w, n in out.items() if n >= 2}


def near(words):
    """Near words by an index of words with one code point left out."""
    at = defaultdict(set)
    for w in words:
        at[w].add(w)
        for i in range(len(w)):
            at[w[:i] + w[i + 1 :]].add(w)
            at[w[:i], w[i + 1 :]].add(w)
    out = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            out[w] |= at[w[:i], w[i + 1 :]]  # replaced
            if w[:i] + w[i + 1 :] in words:  # deleted
                out[w].add(w[:i] + w[i + 1 :])
        out[w] |= {x for x in at[w] if len(x) == len(w) + 1}  # inserted
        out[w].discard(w)
    return out


def expected(words):
    links, form = near(words), {}
    for w, n in words.items():
        best = min(links[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        r = w
        while form[r]:
            r = form[r]
        out.add((w, form[w], r, n, len(links[w]), words[form[w]] if form[w] else None))
    return out


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in spelling.op13_spelling_variants(spark, SMALL).collect()}
    want = expected(counted(docs))
    assert got == want and any(r[1] for r in want)


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=9), min_size=1, max_size=40))
def test_one_edit_in_short_alphabets(words):
    rows = []
    for w in words:
        for k in (len(w), len(w) - 1):
            h = k // 2
            rows += [(f"<{k}:{w[:h]}", w, k), (f">{k}:{w[len(w) - (k - h):]}", w[::-1], k)]
    n = {w: 5 + len(w) for w in words}
    rows = sorted((key, 0, s, k, n[s if key[0] == "<" else s[::-1]], True) for key, s, k in rows if k > 0)
    cols = list(zip(*rows))
    t = pa.table([pa.array(c) for c in cols], names=["key", "part", "seen", "k", "n", "asks"])
    got = defaultdict(int)
    for r in spelling.scan_lists(t).to_pylist():
        got[r["word"]] += r["n_near"]
    want = near(words)
    assert {w: c for w, c in got.items() if c} == {w: len(want[w]) for w in words if want[w]}


def test_lists_dealt_by_their_queries(spark, monkeypatch):
    words = {f"prefix{a}{b}tail": 3 + (a == "q") * 90 for a in "abcdefghijklmnopq" for b in "xyz"}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    monkeypatch.setattr(spelling, "MOST", 7)
    got = {r["word"]: (r["n_near"], r["near_word"]) for r in spelling.near_words(df).collect()}
    want = near(words)
    assert got == {w: (len(want[w]), min(want[w], key=lambda x: (-words[x], x))) for w in words}


def test_nulls_long_texts_and_clashing_names(spark):
    long = " ".join(["Verylongword"] * 5000)
    rows = [(1, None, 0), (2, "", 0), (3, long, 0), (None, "Éclairée éclairée", 0), (3, "÷verylongword", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = {r["word"]: r["n"] for r in spelling.word_counts(df).collect()}
    assert got == counted([("null" if i is None else i, t) for i, t, _ in rows])
    empty = spelling.variants(spelling.word_counts(df.where("false")))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_chain_of_forms_ends_at_the_root(spark):
    words = [("abcdefgh", 1000), ("abcdefghi", 100), ("abcdefghij", 10), ("abcdefghijk", 1)]
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert got["abcdefghijk"] == ("abcdefghij", "abcdefgh") and got["abcdefgh"] == (None, "abcdefgh")


def test_checksums_go_on_from_a_state():
    data = np.frombuffer(b"abc" * 40, np.uint8)
    s, e = np.array([0, 3, 5]), np.array([3, 120, 5])
    state = np.array([zlib.crc32(b"7:")] * 3, np.uint32)
    want = [zlib.crc32(b"7:" + data[a:b].tobytes()) for a, b in zip(s, e)]
    assert spelling.run_checksums(data, s, e, state).tolist() == want
