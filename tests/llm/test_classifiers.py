"""Toxicity and quality: held-out accuracy, fixed rules, defined cases."""

import zlib

import numpy as np

from deskpulse.llm import quality, toxicity
from deskpulse.llm.boost import Boosted, Isotonic
from deskpulse.llm.io import table

D = "/root/testdata/sf0.1"
DOC = "doc_id long, text string, lang string, source string, n_chars long, posterior string"


def auc(y, s):
    rank = np.empty(len(s))
    rank[np.argsort(s, kind="stable")] = np.arange(len(s))
    return (rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_toxicity_on_held_out_rows(spark):
    out = toxicity.op7_toxicity(spark, D).toPandas()
    assert len(out) == table(spark, D, "documents").count()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(out.doc_id, out.held_out, strict=True))
    assert out.score.between(0, 1).all() and ((out.score >= 0.5) == (out.predicted == 1)).all()
    m = out.merge(table(spark, D, "labels").toPandas(), on="doc_id")
    m = m[m.held_out & m.toxic.notna()]
    assert auc(m.toxic.to_numpy(), m.score.to_numpy()) > 0.95
    assert (m.toxic[m.predicted == 1]).mean() > 0.95


def test_toxicity_disguises_and_defined_cases(spark):
    docs = table(spark, D, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, D, "labels"))
    rows = [
        (1, None), (2, ""), (3, "the weather in the garden was fine and they walked home"), (4, "you are a stupid idiot and a pathetic worthless loser, you moron"),
        (5, "you are a 1d10t and a st*pid l0ser, pathet1c scum"), (6, "word " * 200_000),
    ]
    p = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(spark.createDataFrame(rows + rows[:1], "doc_id long, text string"), model).collect()}
    assert max(p[1], p[2], p[3], p[6]) < 0.5 < min(p[4], p[5])
    none = toxicity.fit_toxicity(docs, table(spark, D, "labels").limit(0))
    assert toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), none).count() == 6
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_quality_on_labelled_rows(spark):
    out = quality.op8_quality(spark, D).toPandas()
    m = out.merge(table(spark, D, "labels").toPandas(), on="doc_id")
    m = m[m.quality.notna()]
    assert m.keep[m.quality == 1].mean() > 0.98 and (~m.keep[m.quality == 0]).mean() > 0.97


def test_quality_defined_cases_and_columns(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    extra = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "src0", 0)], docs.schema)
    kept = quality.keep_quality(docs.union(extra), table(spark, "/root/testdata/sf0.01", "labels"))
    assert kept.columns == docs.columns and kept.where("doc_id >= 1000000").count() == 0 and kept.count() > 700
    assert quality.keep_quality(docs.limit(0), table(spark, "/root/testdata/sf0.01", "labels")).count() == 0
    assert quality.keep_quality(docs, table(spark, "/root/testdata/sf0.01", "labels").limit(0)).count() == docs.where("text != ''").count()


def test_sites_shrink_and_leave_the_own_document_out(spark):
    rows = [("big", "a", 0.9)] * 500 + [("bad", "a", 0.05)] * 500 + [("tiny", "a", 0.5), ("bad", "b", 0.5), ("big", "a", 0.5), ("bad", "a", 0.5)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, lang string, p double")
    out = quality.posterior(df, "p", "post").where("doc_id >= 1000").orderBy("doc_id").collect()
    tiny, path, big, bad = (r["post"] for r in out)
    assert abs(tiny - 0.5) < 0.05 and bad < path <= tiny + 0.05 and bad < 0.5 < big


def test_boosting_and_isotonic():
    rng = np.random.default_rng(8)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    m = Boosted(rounds=40, depth=3).fit(x[:2000], y[:2000])
    assert (((m.raw(x[2000:]) > 0) == (y[2000:] == 1)).mean()) > 0.97
    z = rng.random(2000)
    iso = Isotonic(z, (rng.random(2000) < z).astype(float))
    v = iso(np.linspace(0, 1, 50))
    assert (np.diff(v) > 0).all() and np.abs(v - np.linspace(0, 1, 50)).max() < 0.15
    assert abs(iso(np.array([iso.least_score(0.5)]))[0] - 0.5) < 0.02


def test_tree_expression_equals_numpy(spark):
    from pyspark.sql import functions as F

    x = np.random.default_rng(9).integers(0, 5, (500, 3)).astype(float)
    m = Boosted(rounds=10).fit(x, (x.sum(1) > 6).astype(float))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:50]], "a double, b double, c double")
    got = [r[0] for r in df.select(m.column([F.col(c) for c in "abc"])).collect()]
    assert np.allclose(got, m.raw(x[:50]))


def test_words_are_learned_over_whole_texts_not_openings(spark):
    rows = [(i, f"one header of all texts n{i} " + ("vile" if i % 4 == 0 else "kind"), int(i % 4 == 0)) for i in range(80)]
    learned = toxicity._learn_words(spark.createDataFrame(rows, "doc_id long, text string, y int"))
    assert set(learned) == set(toxicity.PLAIN.of(["vile"]))


def test_quality_collects_one_row_per_labelled_document(spark, monkeypatch):
    docs = spark.createDataFrame([(i % 10 if i < 300 else 1, "some text of a document " * (i % 10 + 1)) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    sizes, whole = [], type(docs).toPandas
    monkeypatch.setattr(type(docs), "toPandas", lambda df: sizes.append(len(out := whole(df))) or out)
    quality.fit_quality(docs, labels)
    assert sizes == [10]
