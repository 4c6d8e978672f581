"""Operator 12: token alignment against a plain form."""

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from deskpulse.llm import align

SMALL = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "  two  spaces ", "tab\tand\nline", "x▁y", "ﬁ ligature", "<|endoftext|> <s> </s> <unk>", "naïve café ÿ", "日本語 テキスト",
       "don't 's we'll", "a b 　c", "é ́x", "\x00 nul \x7f", "ends with space ", "🙂🙂 emoji", "1234 5678", "x " * 700, "ı İ ſ"]


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(align.TOKENIZER_A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=align.TOKENIZER_B)
    letter = align._byte_letters()

    def tokens(text):
        """(A tokens, B tokens) as (id, start, end), or none."""
        if not text:
            return [], []
        raw = b" " + text.encode()
        a = [(i, bytes(letter[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(text)]
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            return [], []
        out = []
        for side in (a, b):
            at, row = 0, []
            for i, x in side:
                row.append((i, at, at + len(x)))
                at += len(x)
            out.append(row)
        return out

    return tokens


def expected(rows, tokens):
    per, count = {}, Counter()
    for i, t in rows:
        a, b = tokens(t)
        ends_a = [e for _, _, e in a]
        links = []
        for x, s, e in b:
            k = bisect_left(ends_a, s + 1)
            while k < len(a) and a[k][1] < e:
                links.append((a[k][0], x))
                k += 1
        borders = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, s = [], 0
        for e in borders:
            groups.append(",".join(str(x) for x, p, _ in a if s <= p < e) + "|" + ",".join(str(x) for x, p, _ in b if s <= p < e)) if len(a) < 3000 else None
            s = e
        text = ";".join(groups)
        per[i] = (len(a), len(b), len(borders), links, hashlib.sha256(text.encode()).hexdigest() if a else "")
        count.update(links)
    best = defaultdict(int)
    for (x, y), n in count.items():
        best[y] = max(best[y], n)
    return {i: (na, nb, g, len(l), sum(count[k] == best[k[1]] for k in l), sum(count[k] for k in l), h) for i, (na, nb, g, l, h) in per.items()}


def found(df):
    cols = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_whole_table_equals_the_plain_form(spark, plain):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    docs = [(i, t) for i, t in docs]
    got, want = found(align.op12_token_alignment(spark, SMALL)), expected(docs, plain)
    long = {i for i, t in docs if want[i][0] >= 3000}
    assert {k: v[:6] for k, v in got.items()} == {k: v[:6] for k, v in want.items()}
    assert {k: v[6] for k, v in got.items() if k not in long} == {k: v[6] for k, v in want.items() if k not in long}


def test_odd_texts_repeats_and_clashing_names(spark, plain):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, ODD[5]), (101, ODD[8])]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, n_a int").repartition(3)
    got = found(align.alignment(df))
    assert got == expected(rows, plain)
    assert align.alignment(df.where("false")).count() == 0


def test_links_over_several_blocks(spark, plain, monkeypatch):
    monkeypatch.setattr(align, "BLOCK_LINKS", 50)
    p = align.pair(*(open(f, "rb").read() for f in (align.TOKENIZER_A, align.TOKENIZER_B)))
    texts = ["one two three " * 30, "three two", None, "four " * 7]
    batch = pa.record_batch([pa.array(range(4)), pa.array(range(4)), pa.array(texts)], names=["doc_row", "doc_id", "text"])
    rows = [r for b in align._rows(p, batch) for r in b.to_pylist()]
    want = expected(list(enumerate(texts)), plain)
    for i in range(4):
        mine = [r for r in rows if r["doc_id"] == i]
        assert sum(np.frombuffer(r["times"], "<u4").sum() for r in mine) == want[i][3] == sum(r["n_links"] for r in mine)
    assert len({r["part"] for r in rows}) > 2


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60), min_size=1), st.sets(st.integers(1, 60), min_size=1))
def test_gallop_and_align(a, b):
    a, b = sorted(a | {61}), sorted(b | {61})
    assert align.gallop(np.array(a), np.array(b)).tolist() == [bisect_left(b, x) for x in a]
    at_a, at_b, last_a, last_b = align.align(np.array(a), np.array(b))
    span = lambda ends, k: (ends[k - 1] if k else 0, ends[k])
    want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(span(a, i)[0], span(b, j)[0]) < min(span(a, i)[1], span(b, j)[1])]
    assert sorted(zip(at_a.tolist(), at_b.tolist())) == want
    assert [a[i] for i in last_a] == sorted(set(a) & set(b)) == [b[j] for j in last_b]
