import random

from brute import near_duplicates, shingles

from deskpulse.llm import minhash_dedup
from deskpulse.llm.io import table

SCHEMA = "doc_id long, text string, bucket string, family int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "b", 1) for i, t in texts.items()], SCHEMA)


def check(out, texts, k, percent):
    comp = near_duplicates(texts, k, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()}
    assert got == {i: (len(shingles(t, k)), comp[i]) for i, t in texts.items()}


def test_families_around_the_threshold_and_edges(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = {}
    for f in range(6):  # families whose members differ in some words, above and below the threshold
        base = [word() for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(40):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = word()
            texts[len(texts)] = " ".join(w)
    texts |= {900: None, 901: "", 902: " \n\t ", 903: "one", 904: "ONE", 905: "one two", 906: "one\ttwo ", 907: "x " * 50_000, 908: "X " * 40_000, 909: "É é", 910: "é É"}
    rows = frame(spark, texts)
    check(minhash_dedup.minhash_components(rows.union(rows.limit(5)), 3, 85), texts, 3, 85)
    kept = minhash_dedup.drop_near_duplicates(rows, 5, 80)
    comp = near_duplicates(texts, 5, 80)
    assert kept.columns == rows.columns and {r["doc_id"] for r in kept.collect()} == {i for i, c in comp.items() if i == c}


def test_group_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", 1500)
    rng = random.Random(5)
    base = [str(rng.random()) for _ in range(100)]
    texts = {}
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(100)] = str(rng.random())
        texts[i] = " ".join(w)
    check(minhash_dedup.minhash_components(frame(spark, texts), 3, 85), texts, 3, 85)


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in table(spark, d, "documents").collect()}
    check(minhash_dedup.op2_minhash_near_dedup(spark, d), texts, 3, 85)


def test_empty(spark):
    assert minhash_dedup.minhash_components(frame(spark, {0: "a"}).limit(0)).count() == 0


def test_estimate_is_corrected_for_chance():
    import numpy as np

    n = 120
    assert abs(minhash_dedup._similar(np.array([n / 16]), n)[0]) < 1e-12 and minhash_dedup._similar(np.array([n]), n)[0] == 1


def test_rows_without_or_with_a_shared_id_are_judged_by_their_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(None, a), (None, a + " more"), (7, b), (7, b), (7, c), (8, c), (9, a)]
    kept = minhash_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    assert sorted(map(tuple, kept)) == [(7, b), (7, c), (9, a)]
