import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deskpulse.llm import decontaminate, textvec
from deskpulse.llm.io import tidy
from deskpulse.llm.textfeatures import PLAIN

TEXTS = st.lists(st.none() | st.text(st.sampled_from(list("aB c\n.é日")), max_size=40), max_size=6)


@settings(max_examples=200, deadline=None)
@given(texts=TEXTS, stretch=st.integers(1, 9))
def test_hashes_do_not_depend_on_the_stretch(texts, stretch):
    buffers = textvec.arrow_buffers(pa.array(texts, pa.string()))
    for hashes in (textvec.word_hashes, PLAIN.tokens):
        whole = hashes(*buffers)
        with pytest.MonkeyPatch.context() as m:
            m.setattr(textvec, "STRETCH", stretch)
            cut = hashes(*buffers)
        assert all(np.array_equal(a, b) for a, b in zip(whole, cut, strict=True))


def test_powers_kept_are_bounded():
    long = "x" * (3 * textvec.STRETCH) + " " + "ab " * 1000
    h, first = textvec.word_hashes(*textvec.arrow_buffers(pa.array([long, "ab"])))
    assert first.tolist() == [0, 1001, 1002] and len(set(h[1:].tolist())) == 1
    assert len(textvec._TABLES[0]) <= textvec.STRETCH


def test_tidy_yields_all():
    assert list(tidy(iter)([1, 2, 3])) == [1, 2, 3]


@pytest.mark.parametrize("tasks", [1, 40])
def test_sums_in_levels(spark, monkeypatch, tasks):
    """Groups of at most SUMMED tasks give the same sums as one pass over all texts."""
    monkeypatch.setattr(decontaminate, "SUMMED", 4)
    texts = [f"w{i} w{i % 7} again" for i in range(200)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(tasks)

    def count(acc, idx, first):
        acc[:, 0] += np.bincount(idx, minlength=len(acc))

    got = decontaminate._summed(docs, 1, "<f8", count)[:, 0]
    h, _ = PLAIN.tokens(*textvec.arrow_buffers(pa.array(texts)))
    assert np.array_equal(got, np.bincount(decontaminate._bucket(h), minlength=len(got)))
