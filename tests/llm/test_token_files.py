"""Operator 11: token files against the tokenizer's library, round trips and damage."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from deskpulse.llm import token_files as tf, tokenwords as tw
from deskpulse.llm.rangecoder import decode_blocks, encode_blocks

SMALL = "/root/testdata/sf0.001"
ODD = [None, "", "  ", "don't 'S we'Ve <|startoftext|>x<|endoftext|> a<|b", "É́ é İstanbul ﬁ ß ÿŸ ×÷  x y 12ab34 a1", "日本語 ٣٤ ʰ ª1 ²³ x_y --- !!'s 's",
       "\x1c\x1d a\x85b\x0bc\x00d", "À ̀a ab­cd ​ z", "¿Qué? naïve—x, (y) [z] {w} ~ ` @ # 3.14", "w " * 6000, "x" * 9000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tf.TOKENIZER)


@pytest.fixture(scope="module")
def coder():
    with open(tf.TOKENIZER, "rb") as f:
        return tf.word_coder(f.read())


def expected(rows, library):
    out, start = [], 0
    for i, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [tf.END], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_table_equals_the_library(spark, library):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    got = [tuple(r) for r in tf.op11_token_files(spark, SMALL).orderBy("doc_id").collect()]
    assert got == expected(docs, library)


def test_odd_texts_small_blocks_and_a_null_id(spark, library, tmp_path):
    rows = [(None, ODD[5])] + [(i * 3 - 4, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame([(t, i, "x", 7) for i, t in rows], "text string, doc_id long, ids string, file int").repartition(4)
    path = str(tmp_path / "files")
    tf.write_token_files(df, path)
    got = sorted((tuple(r) for r in tf.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(rows, library)
    # the ids themselves, part by part
    parts = tf.read_token_files(spark, path).orderBy("file", "place", "block").collect()
    flat = [x for p in parts for x in p["ids"]]
    assert flat == [x for _, t in rows for x in [*library.encode(t or "", add_special_tokens=False).ids, tf.END]]
    assert sum(p["first"] for p in parts) == sum(p["last"] for p in parts) == len(rows)


def test_repeated_ids_keep_their_rows_and_empty_tables_have_none(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (2, "")], "doc_id long, text string")
    tf.write_token_files(df, str(tmp_path / "a"))
    got = tf.read_documents(spark, str(tmp_path / "a")).collect()
    assert sorted(r["n_tokens"] for r in got if r["doc_id"] == 1) == [2, 3, 3]
    assert sorted(r["start"] for r in got)[0] == 0 and max(r["start"] + r["n_tokens"] for r in got) == 9
    tf.write_token_files(df.where("false"), str(tmp_path / "b"))
    assert tf.read_documents(spark, str(tmp_path / "b")).count() == 0


def test_words_side_by_side_equal_whole_texts(coder, library):
    texts = [t or "" for t in ODD] + ["The Quick brown-fox's 2nd ÉTÉ ends.", "a<b 'll x'"]
    flat, n = coder.texts(pa.array(texts))
    ends = np.cumsum(n)
    for t, s, e in zip(texts, ends - n, ends):
        assert flat[s:e].tolist() == library.encode(t, add_special_tokens=False).ids, t[:50]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 6), st.integers(0, 49_407)), max_size=300), min_size=1, max_size=7))
def test_range_coder_round_trip(blocks):
    blocks = [np.array(b, np.int64) for b in blocks]
    coded = encode_blocks(blocks, 49_408)
    for a, b in zip(blocks, decode_blocks(coded, [len(b) for b in blocks], 49_408)):
        assert a.tolist() == b.tolist()


def test_range_coder_predicts_what_repeats():
    again = np.tile(np.random.default_rng(1).integers(0, 49_408, 40), 50)
    alone = encode_blocks([again], 49_408)[0]
    assert len(alone) * 8 < 2 * len(again)  # two bits an id, of sixteen
    # blocks are independent: the same bytes whatever lies beside them
    assert encode_blocks([again[:7], again, again[::-1]], 49_408)[1] == alone


def test_damage_is_found_and_stays_in_its_block():
    ids = [np.arange(500) % 37, np.arange(300) % 11]
    coded = encode_blocks(ids, 49_408)
    data = [tf.pack(x, np.array([5, 6]), np.array([100, len(x) - 100]), 0, 0, c, 49_408) for x, c in zip(ids, coded)]
    assert [x.tolist() for _, x in tf.decode(data)] == [x.tolist() for x in ids]
    broken = data[0][:60] + bytes([data[0][60] ^ 1]) + data[0][61:]
    with pytest.raises(ValueError):
        tf.decode([broken])
    assert tf.decode(data[1:])[0][1].tolist() == ids[1].tolist()


def test_checksums_of_parts_join():
    a, b, c = b"one part", b"", b"another" * 9
    moved = tf.shifted_crc(np.array([zlib.crc32(a), zlib.crc32(b), zlib.crc32(c)], np.uint64), np.array([len(b + c), len(c), 0]))
    assert int(np.bitwise_xor.reduce(moved)) == zlib.crc32(a + b + c)


def test_carries_and_long_blocks_round_trip():
    rng = np.random.default_rng(9)
    blocks = [rng.integers(0, 3, 20_000), np.zeros(17_000, np.int64), rng.integers(0, 1 << 20, 400), np.arange(2048) % 2, np.zeros(0, np.int64)]
    for vocabulary in (1 << 20, 1 << 29):
        coded = encode_blocks(blocks, vocabulary) if vocabulary < 1 << 29 else encode_blocks([np.where(b == 1, vocabulary - 1, b) for b in blocks], vocabulary)
        for a, b in zip(blocks, decode_blocks(coded, [len(b) for b in blocks], vocabulary)):
            assert np.array_equal(a if vocabulary < 1 << 29 else np.where(a == 1, vocabulary - 1, a), b)


def test_words_are_cut_and_lowered_once_for_the_model_alone(coder, library, monkeypatch):
    called = []
    monkeypatch.setattr(coder, "whole", lambda pieces: called.append(pieces) or pytest.fail("plain words need no whole tokenizer"))
    coder.atoms.clear()
    texts = ["ÀÉÎ Naïve ÿes café-AU-lait 3x4 [ok]", "again AGAIN ÑANDÚ"] * 300
    flat, n = coder.texts(pa.array(texts))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts[:2]]
    assert flat.tolist() == (want[0] + want[1]) * 300 and n.tolist() == [len(want[0]), len(want[1])] * 300 and not called
    assert len(coder.atoms.known) == len(set(coder.atoms.known.to_pylist()))  # each distinct word once, kept in Arrow


def test_plain_pieces_are_cut_where_the_tokenizer_cuts(coder, library):
    signs = [chr(c) for c in [*range(0x21, 0x7F), *range(0xA1, 0x180), 0x0, 0x7F, 0x3B1, 0x4E2D, 0x1F600]]
    pieces = [a + b for a in signs for b in ("", "a", "É", "7", ".", "ß", "×", "é9(")] + ["ÀÖØÞß÷×", "àöøþÿ", "", "Ã©Ã", "x" * 300]
    plain, atoms, parts = tf.units(pa.array(pieces))
    flat, n = coder.words(atoms)
    ends = np.concatenate([[0], np.cumsum(n)])
    for k, i in enumerate(np.flatnonzero(plain)):
        want = library.encode(pieces[i], add_special_tokens=False).ids
        assert flat[ends[parts[k]] : ends[parts[k + 1]]].tolist() == want, pieces[i]
    assert all(plain[i] for i, p in enumerate(pieces) if p.isascii() and p.isalnum()) and not plain[pieces.index("ß")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text("ab'<é÷ß 7.\n", max_size=6), max_size=9), max_size=6))
def test_forgotten_words_are_encoded_again(batches):
    known = tw.Pieces(lambda p: [tuple(np.array(x, t) for x, t in (([c for w in p.to_pylist() for c in w.encode()], np.int32), ([len(w.encode()) for w in p.to_pylist()], np.int64)))], most=3)
    for words in batches:
        flat, n = known.ids(pa.array(words, pa.string()))
        assert flat.tolist() == [c for w in words for c in w.encode()] and n.tolist() == [len(w.encode()) for w in words]


def test_words_of_several_batches_stay_when_others_go():
    asked = []
    known = tw.Pieces(lambda p: [(asked.extend(p.to_pylist()), (np.zeros(len(p), np.int32), np.ones(len(p), np.int64)))[1]], most=8)
    for k in range(20):
        known.ids(pa.array(["often", "as often", *[f"once {k} {j}" for j in range(3)]]))
    assert asked.count("often") == asked.count("as often") == 1 and len(asked) == 2 + 60 and len(known.known) <= 8 + 5


def test_small_batches_of_blocks_are_decoded_side_by_side():
    batches = [pa.record_batch([pa.array(range(k, k + n), pa.int64())], names=["x"]) for k, n in ((0, 1000), (1000, 1000), (2000, 0), (2000, 2500), (4500, 7))]
    got = list(tf.side_by_side(iter(batches), 2048))
    assert [b.num_rows for b in got] == [2048, 2048, 411] and [x for b in got for x in b.column("x").to_pylist()] == list(range(4507))
    assert list(tf.side_by_side(iter([]), 2048)) == []


def test_small_batches_of_texts_are_tokenized_together():
    sizes = [10, 20, 5, 300, 1, 30, 0, 2]
    batches = [pa.record_batch([pa.array(range(n), pa.int64()), pa.array([f"{k} {i}" for i in range(n)], pa.string())], names=["doc_id", "text"]) for k, n in enumerate(sizes)]
    got = list(tf.gathered(iter(batches), batches[1].nbytes * 2))
    assert [b.num_rows for b in got] == [35, 300, 33]  # a large one stays alone
    assert pa.Table.from_batches(got).to_pylist() == pa.Table.from_batches(batches).to_pylist()
    assert list(tf.gathered(iter([]), 100)) == []


def test_pieces_are_picked_with_their_places():
    flat, lengths = np.arange(10, 22, dtype=np.int32), np.array([3, 0, 5, 1])  # what lies behind the pieces isn't used
    for which in ([], [1], [2, 0, 0, 1, 3, 2], [3] * 1000):
        ids, begins = tw.picked(flat, lengths, np.array(which, np.int64))
        ends = np.cumsum(lengths)
        want = [x for w in which for x in flat[ends[w] - lengths[w] : ends[w]]]
        assert ids.tolist() == want and begins.tolist() == np.concatenate([[0], np.cumsum(lengths[which] if which else [])]).tolist()
    assert tw.picked(flat[:0], lengths[:0], np.zeros(0, np.int64))[1].tolist() == [0]


def test_blocks_that_need_more_words_than_expected_round_trip():
    rng = np.random.default_rng(4)
    blocks = [rng.integers(0, 1 << 29, 2048), np.zeros(2048, np.int64), rng.integers(0, 1 << 29, 700), np.zeros(0, np.int64)]
    coded = encode_blocks(blocks, 1 << 29)
    assert len(coded[0]) > 2 * 2048 and len(coded[1]) < 100  # more than a word an id
    assert encode_blocks(blocks[:1], 1 << 29) == coded[:1] and encode_blocks(blocks[1:], 1 << 29) == coded[1:]
    assert all(np.array_equal(a, b) for a, b in zip(blocks, decode_blocks(coded, [len(b) for b in blocks], 1 << 29)))
    assert encode_blocks([], 1 << 29) == decode_blocks([], [], 1 << 29) == []
