import corpus_pipeline
import sentencepiece
from brute import near_duplicates, pii_base

from deskpulse.llm import decontaminate, quality
from deskpulse.llm.io import cut, table
from deskpulse.llm.sentencepiece_scan import MODEL

D = "/root/testdata/sf0.01"


def test_every_stage_on_its_own_input(spark):
    docs = table(spark, D, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "minhash_dedup", "decontaminate", "pii", "sentencepiece"]

    kept = cut(stages["quality"](spark, docs, D))
    scores = {r["doc_id"]: r["keep"] for r in quality.quality_scores(docs, table(spark, D, "labels")).collect()}
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == {i for i, k in scores.items() if k}

    one = cut(stages["minhash_dedup"](spark, kept, D))
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert one.columns == columns and {r["doc_id"] for r in one.collect()} == {i for i, c in near_duplicates(texts, 5, 80).items() if i == c}

    clean = cut(stages["decontaminate"](spark, one, D))
    bad = {r["doc_id"] for r in decontaminate.contaminations(one, table(spark, D, "benchmark")).collect()}
    assert bad and clean.columns == columns and {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in one.collect()} - bad

    private = cut(stages["pii"](spark, clean, D))
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert private.columns == columns and private.count() == clean.count()
    for r in private.collect():
        assert r["n_chars"] == len(r["text"]) and not pii_base(r["text"])
        if not pii_base(before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]

    tokens = stages["sentencepiece"](spark, private, D).collect()
    p = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = {r["doc_id"]: r["text"] for r in private.collect()}
    assert len(tokens) == len(text) and all(r["ids"] == p.encode(text[r["doc_id"]]) and r["exact"] for r in tokens)


def test_run_is_the_stages_in_order(spark):
    d = "/root/testdata/sf0.001"
    docs = table(spark, d, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, d))
    assert sorted(map(tuple, corpus_pipeline.run(spark, d).select("doc_id", "n_tokens").collect())) == sorted(map(tuple, docs.select("doc_id", "n_tokens").collect()))
