import random

import numpy as np
from brute import lcs, tokens

from deskpulse.llm import decontaminate as dc
from deskpulse.llm.io import table

DOC = "doc_id long, text string, item_id int, k int, v string"


def test_lcs_equals_dynamic_programming():
    rng = random.Random(10)
    for _ in range(50):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 90))]
        b = [rng.randrange(6) for _ in range(rng.randrange(0, 90))]
        assert dc.lcs_length(np.array(a, np.uint64), np.array(b, np.uint64)) == lcs(a, b)


def test_planted_passages_paraphrases_and_clean_documents(spark):
    rng = random.Random(11)
    common = ["w" + str(i) for i in range(40)]
    rare = ["r" + str(i) for i in range(4000)]
    say = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n)]
    items = {i: " ".join(say(rng.choice([14, 30, 55]))) for i in range(30)}
    docs, want = {}, set()
    for i in range(400):
        w = say(rng.choice([20, 120, 600]))
        if i % 4 == 0:
            item = rng.randrange(30)
            passage = items[item].split()
            if i % 8 == 0:  # a paraphrase: every sixth word is another one
                passage = [rng.choice(rare) if k % 6 == 5 else x for k, x in enumerate(passage)]
            at = rng.randrange(len(w))
            w[at:at] = passage
            want.add((i, item))
        docs[i] = " ".join(w)
    rows = [(i, t, 1, 2, "x") for i, t in docs.items()] + [(900, None, 1, 2, "x"), (901, "", 1, 2, "x"), (902, "... !!", 1, 2, "x"), (903, "w1 " * 50_000, 1, 2, "x")]
    d = spark.createDataFrame(rows + rows[:3], DOC)
    b = spark.createDataFrame([(i, t) for i, t in items.items()] + [(77, None), (78, ""), (None, "a b c"), (0, items[0])], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminations(d, b).collect()}
    assert got <= want and {p for p in want if p[0] % 8} <= got  # every verbatim passage, nothing else
    loose = [p for p in want if p[0] % 8 == 0]
    assert len(got & set(loose)) >= 0.8 * len(loose)  # short items with every sixth word replaced are the hardest
    assert {p for p in loose if len(items[p[1]].split()) > 14} <= got
    clean = dc.drop_contaminated(d, b)
    assert clean.columns == d.columns and {r["doc_id"] for r in clean.collect()} == {r[0] for r in rows} - {i for i, _ in got}
    assert dc.contaminations(d.limit(0), b).count() == 0 and dc.contaminations(d, b.limit(0)).count() == 0


def test_whole_table_against_shared_runs(spark):
    d = "/root/testdata/sf0.01"
    items = {r["item_id"]: tokens(r["text"]) for r in table(spark, d, "benchmark").collect()}
    docs = {r["doc_id"]: " ".join(tokens(r["text"])) for r in table(spark, d, "documents").collect()}
    verbatim = {(i, k) for i, t in docs.items() for k, w in items.items() if f" {' '.join(w)} " in f" {t} "}
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in dc.op10_benchmark_decontamination(spark, d).collect()}
    assert verbatim and verbatim <= set(got)
    for (i, k), c in got.items():  # nothing is reported without its cover somewhere in the document
        assert lcs(items[k], docs[i].split()) >= c * len(items[k]) - 1e-9 >= dc.COVER * len(items[k]) - 1


def test_shares_of_a_large_benchmark_give_the_same(spark, monkeypatch):
    d = "/root/testdata/sf0.001"
    docs, b = table(spark, d, "documents"), table(spark, d, "benchmark")
    one = sorted(map(tuple, dc.contaminations(docs, b).collect()))
    monkeypatch.setattr(dc, "ITEM_CHARS", 3000)
    assert sorted(map(tuple, dc.contaminations(docs, b).collect())) == one


def contaminated(spark, docs, items):
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    b = spark.createDataFrame(list(items.items()), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in dc.contaminations(d, b).collect()}


def test_verbatim_items_of_few_words_in_long_documents(spark):
    rng = random.Random(12)
    common, rare = ["w" + str(i) for i in range(40)], ["r" + str(i) for i in range(4000)]
    say = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n)]
    items = {i: " ".join(say(3 + i % 10)) for i in range(60)}
    docs = {}
    for i in items:
        w = say(700)
        at = rng.randrange(len(w))
        w[at:at] = items[i].split()
        docs[i] = " ".join(w)
    assert {(i, i) for i in items} <= contaminated(spark, docs, items)


def test_paraphrases_at_60_to_80_percent_cover_against_brute_force(spark):
    rng = random.Random(13)
    common, rare = ["w" + str(i) for i in range(40)], ["r" + str(i) for i in range(4000)]
    say = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n)]
    items, docs, want = {}, {}, set()
    for i in range(120):
        n = rng.choice([14, 18, 30, 55])
        body, last = say(n - 4), say(4)
        items[i] = " ".join(body) + ". " + " ".join(last)
        item = body + last
        lost = int(n * rng.choice([0.2, 0.25, 0.3, 0.35, 0.4]))
        if i % 2:  # any words
            gone = set(rng.sample(range(n), lost))
        else:  # rare ones first
            gone = set(sorted(range(n), key=lambda k: (item[k][0] == "w", rng.random()))[:lost])
        passage = [rng.choice(rare) if k in gone else x for k, x in enumerate(item)]
        w = say(400)
        at = rng.randrange(len(w))
        docs[i] = " ".join(w[:at] + passage + w[at:])
        if lcs(item, passage) >= dc.COVER * n and 2 * len(set(last) & set(passage)) >= len(set(last)):
            want.add((i, i))
    assert len(want) > 60 and want <= contaminated(spark, docs, items)


def test_lookup_meets_every_region_that_holds_an_item():
    rng = random.Random(14)
    h = lambda n: np.array([1 + int(30 * rng.random() ** 2) for _ in range(n)], np.uint64) << np.uint64(50)
    words = [h(rng.randrange(1, 30)) for _ in range(25)]
    index = {"words": words, "answers": [w[:1] for w in words], **dc._rarest(words, {"count": np.bincount(dc._bucket(np.concatenate(words)), minlength=2**dc.WORD_BITS)})}
    texts = [h(n) for n in (0, 1, 7, 60, 300, 0)]
    first = np.cumsum([0, *map(len, texts)])
    found = {}
    dc._by_words(np.concatenate(texts), first, index, found)
    want = {}
    for t, text in enumerate(texts):
        for i, w in enumerate(words):
            step, length = max(1, len(w) // 2), 2 * len(w) + min(len(w), dc.WINDOW)
            regions = [text[k : k + length] for k in range(0, len(text), step)]
            best = max((lcs(w.tolist(), r.tolist()) for r in regions if w[0] in r), default=0)
            if best >= dc.COVER * len(w):
                want[(t, i)] = best
    assert want and found == want


def test_items_of_common_words_and_items_repeated_by_a_third_of_short_rows(spark):
    rng = random.Random(15)
    common, rare = ["w" + str(i) for i in range(40)], ["r" + str(i) for i in range(4000)]
    items = {0: " ".join(rng.choice(common) for _ in range(30)), 1: " ".join(rng.sample(rare, 16)), 2: " ".join(rng.choice(common) for _ in range(8))}
    docs = {i: " ".join([*([items[1]] if i % 3 == 0 else []), *(rng.choice(rare) for _ in range(20))]) for i in range(300)}
    for i in range(300, 340):
        w = [rng.choice(common) if rng.random() < 0.8 else rng.choice(rare) for _ in range(60)]
        docs[i] = " ".join(w[:30] + [items[i % 2 * 2]] + w[30:])
    got = contaminated(spark, docs, items)
    assert {(i, 1) for i in range(0, 300, 3)} <= got and {(i, i % 2 * 2) for i in range(300, 340)} <= got
    assert not {i for i, k in got if k == 1 and i % 3}


def test_rows_are_dropped_by_their_own_text(spark):
    rng = random.Random(16)
    say = lambda n: " ".join("r" + str(rng.randrange(4000)) for _ in range(n))
    item, clean = say(30), [say(60) for _ in range(4)]
    rows = [(None, clean[0] + " " + item), (None, clean[1]), (5, clean[2]), (5, clean[3] + " " + item)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    kept = dc.drop_contaminated(d, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {tuple(r) for r in kept} == {(None, clean[1]), (5, clean[2])}


def test_row_sums_equal_sums_in_order_and_lookups_equal_membership():
    rng = np.random.default_rng(17)
    rows = rng.standard_normal((500, 5)).astype(np.float32)
    size = np.concatenate([rng.integers(1, 2 * dc.LONG, 80), [1, 900, dc.LONG, dc.LONG + 1]])
    begin, which = np.cumsum(size) - size, rng.integers(0, len(rows), size.sum())
    assert np.allclose(dc._row_sums(rows, which, begin, size), np.add.reduceat(rows[which], begin, axis=0), rtol=1e-4, atol=1e-4)
    assert dc._row_sums(rows, which, begin[:0], size[:0]).shape == (0, 5)
    h = rng.integers(0, 2**64, 3000, np.uint64)
    for known in (np.unique(h[:700]), h[:0], np.array([0, 2**64 - 1], np.uint64)):
        at, place = dc._found(np.append(h, np.uint64(0)), known, dc._sieve(known))
        assert np.array_equal(at, np.flatnonzero(np.isin(np.append(h, np.uint64(0)), known))) and np.array_equal(known[place], np.append(h, np.uint64(0))[at])


def test_regions_without_enough_words_of_an_item_are_not_compared():
    item, region = np.arange(10, dtype=np.uint64), np.array([3, 50, 4, 60, 5] * 20, np.uint64)
    assert dc.lcs_length(item, region) == 3
    assert dc.lcs_length(item, region[:5], least=4) == 3  # the words met, a bound
    index = {"words": [item, item[:3]], "answers": [item, item]}
    assert dc._common(index, 0, region) == 3 and dc._common(index, 1, item) == 3 and set(index["held"]) == {0, 1}
    index["n_held"] = dc.MOST_HELD
    index["words"].append(np.arange(dc.MOST_BITS + 1, dtype=np.uint64))
    assert dc._common(index, 2, index["words"][2]) == dc.MOST_BITS + 1 and not index["held"]
