"""Alignment of two tokenizers' tokens by their byte ranges (operator 12).

Both tokenizers encode a text; every token covers a range of its bytes. Byte
offsets where tokens of both end cut the sequences into groups, and two tokens
are linked if their ranges overlap.

The common ends come from a galloping intersection of the two sorted lists of
ends: each end of the shorter list starts where its share of the way through
the longer list lies, leaps on in doubling steps until it is passed, and the
bracket is halved until its rank is known; all ends of a batch of texts do so
side by side. Equal ends are the groups' borders. The rank of an end says how
many tokens of the longer list end before it; differences of ranks are the
ranges of tokens that a token of the shorter list overlaps, so links are ranges
and no two tokens are compared.

Corpus-wide counts: a link is a pair of ids. ``link_counts`` adds the links up
for each block of texts (at most BLOCK_LINKS links, a text that has more takes
several blocks), sums the blocks' counts of each pair and gives every block the
counts of its own pairs back. Only the best count of each id of the second
tokenizer is joined as a small table: it has at most one row for each id of the
vocabulary.

Tokenizing goes by words: both tokenizers begin a token at a single space
between two characters of words (checked for the vocabulary when it is loaded),
so a text's tokens are its words' tokens, and a task encodes a word once.

Defined cases: null and empty texts, and texts whose tokens don't give the
bytes of the text back (with a space before it), have no tokens: zeros and an
empty string; repeated rows are separate rows and count again; ties of counts
are all best; an empty table gives no rows; other columns are not read; very
long texts are encoded whole and linked in several blocks.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deskpulse.llm.io import cut, table
from deskpulse.llm.textvec import arrow_buffers, slices
from deskpulse.llm.tokenwords import Pieces, ragged_take, sums

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
SLICE = 2 << 20  # bytes of text aligned at a time (one text at least)
BLOCK_LINKS = 1 << 20  # links of a block at most
SPACE = "▁"
PLAIN = "^ [!-~\u00C0-\u017F]+$"
BLOCKS = (
    "doc_row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "block long, part int, pairs binary, times binary"
)


def _byte_letters() -> dict[str, int]:
    """Byte of each letter of the byte-level alphabet: printable Latin-1 bytes stand for themselves, others are
    numbered from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokens:
    """A byte-level tokenizer: ids of pieces, and each id's number of bytes."""

    def __init__(self, blob: bytes):
        self.tokenizer = Tokenizer.from_buffer(blob)
        self.tokenizer.encode_special_tokens = True
        letter, vocab = _byte_letters(), self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.bytes[i] = bytes(letter[c] for c in t) if all(c in letter for c in t) else t.encode()
        self.width = np.array([len(b) for b in self.bytes], np.int64)
        self.spaced = np.array([b[:1] == b" " for b in self.bytes])

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


class SentenceTokens:
    """A SentencePiece model, which adds the space before the text itself."""

    def __init__(self, blob: bytes):
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=blob)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.width = np.array([len(b) for b in self.bytes], np.int64)
        self.spaced = np.array([b[:1] == b" " for b in self.bytes])
        self.by_word = all(SPACE not in p.lstrip(SPACE) for p in names)

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return self.sp.encode([p[1:] for p in pieces], num_threads=1)


class Pair:
    """Two tokenizers and the words a task has met, with both encodings."""

    def __init__(self, blob_a: bytes, blob_b: bytes):
        self.a, self.b = ByteTokens(blob_a), SentenceTokens(blob_b)
        self.b_size = len(self.b.bytes)
        self.words = Pieces(self.both, 2)
        text_a, text_b = _spelled(len(self.a.bytes)), _spelled(self.b_size)
        wide = max(text_a[0].shape[1], text_b[0].shape[1])
        self.digits = np.concatenate([np.pad(t, ((0, 0), (0, wide - t.shape[1]))) for t, _ in (text_a, text_b)])
        self.digits_size = np.concatenate([text_a[1], text_b[1]])

    def both(self, pieces: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Both tokenizers' (flat ids, number of ids); a piece whose bytes don't come back from both has none."""
        sides = [side_by_side(t, pieces) for t in (self.a, self.b)]
        ok = (sides[0][1] > 0) & (sides[1][1] > 0)
        return [(flat[np.repeat(ok, n)], np.where(ok, n, 0)) for flat, n in sides]

    def texts(self, texts: pa.Array):
        """(A ids, B ids, A count and B count of each word, first word of each text); words of texts without tokens have 0."""
        data, offsets = arrow_buffers(texts)
        starts, owner = word_starts(data, offsets, self.b.by_word)
        ends = np.append(starts[1:], len(data))
        lead = np.searchsorted(starts, offsets[:-1][np.diff(offsets) > 0])  # words at the start of a text get the added space
        size = ends - starts
        size[lead] += 1
        at = np.cumsum(size) - size
        padded = np.full(int(size.sum()), 0x20, np.uint8)
        body = np.ones(len(padded), bool)
        body[at[lead]] = False
        padded[body] = data
        words = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(np.append(at, len(padded)).astype(np.int64)), pa.py_buffer(padded)])
        which = self.words.numbers(words)
        a, b = self.words.sides
        na, nb = a.lengths[which], b.lengths[which]
        bad = np.zeros(len(texts), bool)
        bad[owner[na == 0]] = True
        na, nb = np.where(bad[owner], 0, na), np.where(bad[owner], 0, nb)
        per = np.searchsorted(owner, np.arange(len(texts) + 1))
        ids = ragged_take(a.flat, a.starts[which], na).astype(np.int64), ragged_take(b.flat, b.starts[which], nb).astype(np.int64)
        return *ids, na, nb, per


def side_by_side(t, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, number of ids) of each piece; a piece whose tokens don't give its bytes back has none. Plain words (a
    space, then word characters) are encoded in rows of 500 and cut before the tokens that begin with a space."""
    plain = pc.match_substring_regex(pieces, PLAIN).to_numpy(zero_copy_only=False)
    words = pieces.to_pylist()
    rows = np.array_split(np.flatnonzero(plain), range(500, int(plain.sum()), 500))
    texts = ["".join([words[i] for i in row.tolist()]) for row in rows]
    counts, parts, order, rest = np.zeros(len(words), np.int64), [], [], np.flatnonzero(~plain).tolist()
    for row, text, ids in zip(rows, texts, t.encode(texts)):
        flat = np.array(ids, np.int64)
        heads = np.flatnonzero(t.spaced[flat]) if len(flat) else flat
        if len(heads) == len(row) and b"".join([t.bytes[i] for i in ids]) == text.encode():
            counts[row] = np.diff(np.append(heads, len(flat)))
            parts.append(flat)
            order.append(row)
        else:
            rest += row.tolist()
    for i, ids in zip(rest, t.encode([words[i] for i in rest])):
        if b"".join([t.bytes[k] for k in ids]) == words[i].encode():
            counts[i] = len(ids)
            parts.append(np.array(ids, np.int64))
            order.append([i])
    order = np.concatenate([np.asarray(o, np.int64) for o in order]) if order else np.zeros(0, np.int64)
    starts = np.zeros(len(words), np.int64)
    starts[order] = np.cumsum(counts[order]) - counts[order]
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return ragged_take(flat, starts, counts), counts


@lru_cache(maxsize=1)
def pair(blob_a: bytes, blob_b: bytes) -> Pair:
    return Pair(blob_a, blob_b)


def word_starts(data: np.ndarray, offsets: np.ndarray, by_word: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places where words begin, and each one's text: the start of each text and each single space between two
    visible ASCII characters or Latin letters (U+00C0 to U+017F), at which both tokenizers begin a token."""
    n = len(data)
    begins = offsets[:-1][np.diff(offsets) > 0]
    starts = begins
    if by_word and n > 2:
        ascii_ = (data > 0x20) & (data < 0x7F)
        latin = (data >= 0xC3) & (data <= 0xC5)  # lead bytes
        ends_word = ascii_.copy()
        ends_word[1:] |= latin[:-1]
        inner = np.flatnonzero((data[1:-1] == 0x20) & ends_word[:-2] & (ascii_ | latin)[2:]) + 1
        owner = np.searchsorted(offsets, inner, side="right") - 1
        inner = inner[(inner > offsets[owner]) & (inner + 1 < offsets[owner + 1])]
        starts = np.sort(np.concatenate([begins, inner]))
    return starts, np.searchsorted(offsets, starts, side="right") - 1


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Number of entries of ``long`` below each entry of ``short`` (both sorted, no repeats), by doubling leaps up or
    down from ``start`` (else from each entry's share of the way), and halving of the bracket."""
    n, m = len(short), len(long)
    if not n or not m:
        return np.zeros(n, np.int64)
    at = np.arange(n) * m // n if start is None else np.minimum(start, m - 1)
    up = long[at] < short
    lo, hi = np.where(up, at, -1), np.where(up, m, at)  # long[lo] < short <= long[hi]
    todo, leap = np.arange(n), 1
    while len(todo):
        rising = up[todo]
        probe = np.where(rising, at[todo] + leap, at[todo] - leap)
        probe_in = (probe >= 0) & (probe < m)
        todo, probe, rising = todo[probe_in], probe[probe_in], rising[probe_in]
        below = long[probe] < short[todo]
        lo[todo[below]] = probe[below]
        hi[todo[~below]] = probe[~below]
        todo, leap = todo[below == rising], leap * 2
    todo = np.flatnonzero(hi - lo > 1)
    while len(todo):
        mid = (lo[todo] + hi[todo]) >> 1
        below = long[mid] < short[todo]
        lo[todo[below]] = mid[below]
        hi[todo[~below]] = mid[~below]
        todo = todo[hi[todo] - lo[todo] > 1]
    return hi


def align(ends_a: np.ndarray, ends_b: np.ndarray, starts: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links and groups of two sorted lists of ends of the same bytes: (place in A, place in B) of every link, in order,
    and the places in A and in B of the last token of every group. ``starts``: where the search for each end of A in B,
    and of B in A, begins."""
    swap = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    rank = gallop(short, long, starts and starts[swap])
    common = np.flatnonzero(long[np.minimum(rank, len(long) - 1)] == short) if len(long) else np.zeros(0, np.int64)
    tied = np.zeros(len(short), np.int64)
    tied[common] = 1
    # a short token overlaps the long ones from the one that reaches over its start to the one that reaches its end
    begin = np.concatenate([[0], (rank + tied)[:-1]])[: len(short)]
    count = rank - begin + 1
    s = np.repeat(np.arange(len(short)), count)
    l = ragged_take(np.arange(len(long)), begin, count)  # noqa: E741
    return (l, s, rank[common], common) if swap else (s, l, common, rank[common])


def _spelled(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. n - 1 with one more place behind them, and their lengths with it."""
    raw = [str(i).encode() + b" " for i in range(n)]
    size = np.array([len(r) for r in raw], np.int64)
    out = np.zeros((n, int(size.max())), np.uint8)
    for i, r in enumerate(raw):
        out[i, : len(r)] = np.frombuffer(r, np.uint8)
    return out, size


def spelled_groups(p: Pair, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of 'a1,a2|b1;a3|b2,b3;' of all groups, and the bytes before each group."""
    na, nb = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    total = len(a) + len(b)
    group_start = np.cumsum(na + nb) - (na + nb)
    is_b = np.zeros(total, bool)
    is_b[ragged_take(np.arange(total), group_start + na, nb)] = True
    which = np.empty(total, np.int64)
    which[~is_b], which[is_b] = a, b + len(p.a.bytes)
    size = p.digits_size[which]
    end = np.cumsum(size)
    at = end - size
    out = p.digits[which][np.arange(p.digits.shape[1]) < size[:, None]]
    out[end - 1] = ord(",")
    out[end[group_start + na - 1] - 1] = ord("|")
    out[end[group_start + na + nb - 1] - 1] = ord(";")
    return out, np.append(at[group_start], len(out))


class Aligned:
    """A batch of texts, aligned. Links of all texts lie one after the other, ``links`` of each text."""

    def __init__(self, p: Pair, texts: pa.Array):
        self.a, self.b, na, nb, per = p.texts(texts)
        self.n_a, self.n_b = sums(na, per), sums(nb, per)
        ends_a, ends_b = np.cumsum(p.a.width[self.a]), np.cumsum(p.b.width[self.b])
        # the search for an end begins at the other tokenizer's first token of the same word
        starts = np.repeat(np.cumsum(nb) - nb, na), np.repeat(np.cumsum(na) - na, nb)
        self.at_a, self.at_b, self.last_a, self.last_b = align(ends_a, ends_b, starts)
        self.off_a, self.off_b = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        self.off_groups = np.searchsorted(self.last_a, self.off_a)
        self.off_links = np.searchsorted(self.at_a, self.off_a)
        self.n_groups, self.links = np.diff(self.off_groups), np.diff(self.off_links)
        self.pairs = self.a[self.at_a] * p.b_size + self.b[self.at_b]

    def digests(self, p: Pair) -> list[str]:
        """Hex sha256 of each text's groups; '' for texts without tokens."""
        raw, at = spelled_groups(p, self.a, self.b, self.last_a, self.last_b)
        at = at[self.off_groups]
        raw = memoryview(raw)
        return [hashlib.sha256(raw[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(at[:-1].tolist(), at[1:].tolist())]


def aligned_blocks(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> DataFrame:
    """One row for each document and block of its links: BLOCKS columns. ``pairs`` holds the document's distinct pairs
    (A id x size of B + B id) of the block, sorted, and ``times`` how often each occurs (8 and 4 bytes each); a
    document's own figures stand in its first row."""
    with open(a, "rb") as f, open(b, "rb") as g:
        blobs = f.read(), g.read()

    def run(batches):
        p = pair(*blobs)
        for batch in batches:
            for s in slices(batch, "text", SLICE):
                yield from _rows(p, s)

    d = docs.select(F.monotonically_increasing_id().alias("doc_row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(run, BLOCKS)


def _rows(p: Pair, s: pa.RecordBatch):
    x = Aligned(p, s.column("text"))
    # parts of documents of at most BLOCK_LINKS links; parts of small documents share a block
    parts = np.maximum(1, -(-x.links // BLOCK_LINKS))
    owner = np.repeat(np.arange(len(parts)), parts)
    begin = x.off_links[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * BLOCK_LINKS
    end = np.minimum(begin + BLOCK_LINKS, x.off_links[owner + 1])
    many = len(p.a.bytes) * p.b_size
    key = np.sort(np.repeat(np.arange(len(owner)) * many, end - begin) + x.pairs)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
    times = np.diff(np.append(first, len(key))).astype("<u4")
    key = key[first]
    bounds = np.searchsorted(key, np.arange(len(owner) + 1) * many)
    key = (key % many).astype("<i8")
    block = np.maximum(np.cumsum(end - begin) - 1, 0) // BLOCK_LINKS
    head = np.append(True, owner[1:] != owner[:-1])
    digest = np.array(x.digests(p), object)
    own = lambda v: pa.array(np.where(head, v[owner], 0).astype(np.int64))
    binary = lambda v: [v[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])]
    yield pa.record_batch(
        [s.column("doc_row").take(pa.array(owner)), s.column("doc_id").take(pa.array(owner)), own(x.n_a), own(x.n_b), own(x.n_groups), own(x.links),
         pa.array(np.where(head, digest[owner], ""), pa.string()), pa.array(np.full(len(owner), s.column("doc_row")[0].as_py())), pa.array(block.astype(np.int32)),
         pa.array(binary(key), pa.binary()), pa.array(binary(times), pa.binary())],
        names=["doc_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "block", "part", "pairs", "times"],
    )


def _block_pairs(batches):
    """Distinct pairs of each block with their numbers of links: rows of one block lie together in a task."""
    held, name = [], None
    for batch in batches:
        for *block, pairs, times in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "pairs", "times"))):
            if block != name:
                if held:
                    yield _added(name, held)
                held, name = [], block
            held.append((np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<u4")))
    if held:
        yield _added(name, held)


def _added(block: list, held: list) -> pa.RecordBatch:
    pairs, times = (np.concatenate(x) for x in zip(*held))
    distinct, inverse = np.unique(pairs, return_inverse=True)
    n = np.bincount(inverse, times, len(distinct)).astype(np.int64)
    of = [pa.array(np.full(len(distinct), block[0], np.int64)), pa.array(np.full(len(distinct), block[1], np.int32))]
    return pa.record_batch([*of, pa.array(distinct.astype(np.int64)), pa.array(n)], names=["block", "part", "pair", "n"])


def link_counts(blocks: DataFrame, b_size: int) -> DataFrame:
    """(block, part, pair, count, best): each block's distinct pairs with their corpus-wide counts of links and whether
    that is the highest of the pair's B id."""
    wanted = blocks.select("block", "part", "pairs", "times").mapInArrow(_block_pairs, "block long, part int, pair long, n long")
    counts = cut(wanted.groupBy("pair").agg(F.sum("n").alias("count")))
    best = counts.groupBy((F.col("pair") % b_size).alias("b")).agg(F.max("count").alias("highest"))
    counts = counts.join(best, F.col("pair") % b_size == F.col("b")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    return wanted.select("block", "part", "pair").join(counts, "pair")


def _scored(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums of each row's links over the counts of its block (all rows of one block, and its pairs' counts)."""
    order = pc.sort_indices(counts["pair"])
    known, count, best = (counts[c].take(order).to_numpy() for c in ("pair", "count", "best"))
    n_best, total = [], []
    for pairs, times in zip(rows["pairs"].to_pylist(), rows["times"].to_pylist()):
        at = np.searchsorted(known, np.frombuffer(pairs, "<i8"))
        t = np.frombuffer(times, "<u4").astype(np.int64)
        n_best.append(int(t[best[at]].sum()))
        total.append(int((t * count[at]).sum()))
    return pa.table({"doc_row": rows["doc_row"], "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64())})


def alignment(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    with open(b, "rb") as f:
        b_size = sentencepiece.SentencePieceProcessor(model_proto=f.read()).get_piece_size()
    blocks = cut(aligned_blocks(docs, a, b))
    linked = blocks.where("length(pairs) > 0")
    by = ["block", "part"]
    scored = linked.select("doc_row", *by, "pairs", "times").groupBy(*by).cogroup(link_counts(linked, b_size).groupBy(*by))
    scored = scored.applyInArrow(_scored, "doc_row long, n_best long, count_sum long")
    own = ["n_a", "n_b", "n_groups", "n_links"]
    zero = F.lit(0).cast("long")
    both = blocks.select("doc_row", "doc_id", *own, zero.alias("n_best"), zero.alias("count_sum"), "groups_sha256").unionByName(
        scored.select("doc_row", F.lit(None).cast("long").alias("doc_id"), *[zero.alias(c) for c in own], "n_best", "count_sum", F.lit("").alias("groups_sha256"))
    )
    return (
        both.groupBy("doc_row")
        .agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in (*own, "n_best", "count_sum")], F.max("groups_sha256").alias("groups_sha256"))
        .drop("doc_row")
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of all documents' tokens: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    return alignment(table(spark, sf_dir, "documents"))
