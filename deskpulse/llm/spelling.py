"""Spelling variants grouped around their frequent forms (operator 13).

``word_counts`` counts a table's words; ``near_words`` finds, for each word, the
words exactly one inserted, deleted or replaced code point away; ``variants``
gives each word its form (the most frequent near word, if it is FACTOR times as
frequent) and its root (the end of the chain of forms).

The search is dynamic programming over sorted lists. One edit lies either in
the first or in the last half of the shorter word, so the other half is shared:
every word goes into the lists of its first and of its last half (words of the
other length that it may be near to are in the same list). A list is sorted,
reversed words for last halves, and scanned once for all the words in it. The
edit matrix between a query and the list has three cells a row (the band of one
edit); neighbours in the sorted list share the rows of their longest common
prefix, so a row is computed once for a whole run of words with the same
prefix, and a run whose row exceeds one edit in every cell is skipped with all
its words. The halves that all words of a list share cost nothing.

Spark deals the lists by a hash of their key; a task scans its lists in groups
of about SCAN words. A list of more than MOST words is dealt by its queries: its
queries go to several tasks, each with the whole sorted list (a list is bounded
by the distinct words with the same half, whatever the number of rows).

Words are the maximal runs of letters of a pattern of one-byte (Latin-1) code
points; their counts are added up in each task before the shuffle. Defined
cases: null and empty texts have no words; repeated rows count again; very
long texts are read whole; words with equal counts are ordered by code points;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskpulse.llm.io import cut, table
from deskpulse.llm.textvec import arrow_buffers, slices
from deskpulse.llm.tokenwords import ragged_take

SHORTEST = 7  # code points of a word
LEAST = 2  # occurrences of a word
FACTOR = 10  # how much more frequent a form is
DIVISOR = 31
SLICE = 4 << 20
SCAN = 40_000  # words that a task scans at a time (one list at least)
CELLS = 4_000_000  # code points, with padding, of the words that a task scans at a time (one list at least)
MOST = 50_000  # queries of a list that go to one task
LONG = 48  # bytes up to which checksums of runs are computed side by side
COUNTS = "word string, n long"


def _steps() -> np.ndarray:
    """The byte table of crc32, from its polynomial."""
    v = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        v = np.where(v & 1 == 1, (v >> np.uint32(1)) ^ np.uint32(0xEDB88320), v >> np.uint32(1))
    return v


_TABLE = _steps()
_UPPER = np.zeros(256, np.uint8)
_UPPER[65:91] = 32


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the maximal runs of [A-Za-z\\u00C0-\\u00FF] in UTF-8 texts, and each one's text."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    low = data | 32
    letter = (low >= 97) & (low <= 122)
    lead = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF are C3 80 to C3 BF
    letter[lead] = True
    letter[lead[lead + 1 < n] + 1] = True
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    begins = offsets[(offsets > 0) & (offsets < n)]
    first[begins] = letter[begins]
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    last[begins - 1] = letter[begins - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def run_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of ``data[s:e]`` that goes on from the crc32 ``state`` of what stands before it."""
    crc = ~state
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    falling = -size[order]
    for j in range(min(int(size.max(initial=0)), LONG)):
        on = order[: np.searchsorted(falling, -j, side="left")]
        crc[on] = _TABLE[(crc[on] ^ data[starts[on] + j]) & 0xFF] ^ (crc[on] >> np.uint32(8))
    crc = ~crc
    for i in np.flatnonzero(size > LONG):
        crc[i] = zlib.crc32(data[starts[i] + LONG : ends[i]].tobytes(), int(crc[i]))
    return crc


def _counted(texts: pa.Array, ids: list, shortest: int, divisor: int) -> pa.RecordBatch:
    """Words of a slice of texts and their counts."""
    data, offsets = arrow_buffers(texts)
    data = data + _UPPER[data]
    starts, ends, owner = letter_runs(data, offsets)
    chars = np.cumsum(np.concatenate([[0], (data & 0xC0) != 0x80]))
    length = chars[ends] - chars[starts]
    keep = length >= shortest
    starts, ends, owner, length = starts[keep], ends[keep], owner[keep], length[keep]
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    h = run_checksums(data, starts, ends, before[owner])
    hit = h % divisor == 0
    size = ends - starts
    kept = ~hit
    flat = ragged_take(data, starts[kept], size[kept])
    words = pa.Array.from_buffers(pa.large_string(), int(kept.sum()), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size[kept])]).astype(np.int64)), pa.py_buffer(flat)])
    cut_words = []
    for s, e, k, n in zip(starts[hit], ends[hit], h[hit].astype(np.int64) % length[hit], length[hit]):
        if n > shortest:
            w = data[s:e].tobytes().decode()
            cut_words.append(w[:k] + w[k + 1 :])
    found = pc.value_counts(pa.concat_arrays([words, pa.array(cut_words, pa.large_string())]))
    return pa.record_batch([found.field("values").cast(pa.string()), found.field("counts").cast(pa.int64())], names=["word", "n"])


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, divisor: int = DIVISOR) -> DataFrame:
    """(word, n): words of at least ``shortest`` code points that occur ``least`` times or more.

    A run whose crc32 of "<doc_id>:<run>" is divided by ``divisor`` loses one code point first.
    """

    def run(batches):
        for batch in batches:
            for b in slices(batch, "text", SLICE):
                yield _counted(b.column("text"), b.column("doc_id").to_pylist(), shortest, divisor)

    d = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").where(F.col("text").isNotNull())
    d = d.withColumn("doc_id", F.coalesce("doc_id", F.lit("null")))
    return d.mapInArrow(run, COUNTS).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _listed(words: DataFrame) -> DataFrame:
    """Rows (key, k, word, n): each word in the lists of its halves, ``k`` the length of the shorter word of a pair."""
    size, half = F.char_length("word"), F.expr("k div 2")
    two = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("k"))
    first = two.select(F.concat(F.lit("<"), F.col("k").cast("string"), F.lit(":"), F.left("word", half)).alias("key"), "k", "word", "n")
    last = two.select(F.concat(F.lit(">"), F.col("k").cast("string"), F.lit(":"), F.right("word", F.col("k") - half)).alias("key"), "k", "word", "n")
    return first.unionAll(last)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near_word) of the words of ``words`` (word, n; distinct) that have near words:
    their number, and the most frequent of them (of equal ones the first by code points)."""
    rows = _listed(words)
    shorter = F.max(F.char_length("word") == F.col("k"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"), shorter.alias("shorter")).where("size > 1 and shorter").drop("shorter")
    rows = rows.join(sizes, "key")
    # a list of more than MOST words goes to several tasks; each one has all its words and a share of its queries
    parts = F.ceil(F.col("size") / MOST).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("share", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("key", "part", F.expr("if(key like '>%', reverse(word), word)").alias("seen"), "k", "n", (F.col("share") == F.col("part")).alias("asks"))
    rows = rows.repartition("key", "part").sortWithinPartitions("k", "key", "part", "seen")  # lists of equal lengths lie together
    found = rows.mapInArrow(_scan, "word string, n_near long, near_n long, near_word string")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near_word").alias("w"))).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.m")).alias("near_n"), F.col("best.w").alias("near_word"))


def _scan(batches):
    """Whole lists, in groups of about SCAN words, through ``scan_lists``."""
    held, rows = [], 0
    for b in (batch.slice(i, 4000) for batch in batches for i in range(0, batch.num_rows, 4000)):
        held.append(b)
        rows += b.num_rows
        if rows < SCAN and rows * (b.column("k")[-1].as_py() + 3) < CELLS:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        keys = pc.binary_join_element_wise(t["key"], t["part"].cast(pa.string()), "|")
        last = pc.index(keys, keys[-1]).as_py()  # the last list may go on in the next batch
        if last:
            yield scan_lists(t.slice(0, last))
            t = t.slice(last)
        held, rows = t.to_batches(), t.num_rows
    if rows:
        yield scan_lists(pa.Table.from_batches(held).combine_chunks())


def _matrix(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of Latin-1 words, one row each, zeros behind; and their lengths."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    flat = np.frombuffer(b"".join(raw), np.uint8)
    out = np.zeros((len(raw), int(size.max(initial=0)) + 2), np.uint8)
    out[np.repeat(np.arange(len(raw)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out, size


def scan_lists(t: pa.Table) -> pa.RecordBatch:
    """Near words within each list of a table in which the words of a list lie together, sorted.

    One state is a query, a run of list words with the same prefix (by its first and last word) and the three cells
    of the matrix row after that prefix: the distances of the prefix to the query's prefixes one shorter, as long and
    one longer. All queries advance by one code point at a time.
    """
    t = t.combine_chunks()
    col = lambda c: t[c].chunk(0) if t[c].num_chunks else t[c].combine_chunks()
    seen = col("seen")
    text, size = _matrix(seen)
    k, n = col("k").to_numpy(zero_copy_only=False).astype(np.int64), col("n").to_numpy(zero_copy_only=False)
    key, part = col("key"), col("part").to_numpy(zero_copy_only=False)
    rows = len(seen)
    code = key.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    fresh = np.ones(rows, bool)
    fresh[1:] = (code[1:] != code[:-1]) | (part[1:] != part[:-1])
    ends = np.append(np.flatnonzero(fresh)[1:], rows)
    which = np.cumsum(fresh) - 1
    backward = pc.starts_with(key, ">").to_numpy(zero_copy_only=False)
    shared = np.where(backward, k - k // 2, k // 2)  # of the list's words, from their start
    same = text[1:] == text[:-1]
    lcp = np.zeros(rows, np.int64)
    lcp[1:] = np.where(same.all(1), text.shape[1], np.argmin(same, 1))
    lcp[fresh] = 0

    deep = range(int(shared.min(initial=0)), text.shape[1])  # places of runs by the length of what they share
    begins = np.concatenate([np.flatnonzero(lcp <= j) + j * (rows + 1) for j in deep] or [np.zeros(0, np.int64)])
    q = np.flatnonzero(col("asks").to_numpy(zero_copy_only=False))
    lo, hi, at = np.flatnonzero(fresh)[which[q]], ends[which[q]], shared[q]
    d = np.ones((len(q), 3), np.int8)  # a shared prefix of length p is 1, 0, 1 edits from p - 1, p, p + 1 of the query
    d[:, 1] = 0
    d[at == 0, 0] = 2
    pairs_q, pairs_w = [], []
    while len(q):
        # words that end here: the distance is the cell of the query's whole length
        gap = size[q] - at
        done = (size[lo] == at) & (np.abs(gap) <= 1)
        hit = np.flatnonzero(done)
        hit = hit[d[hit, gap[hit] + 1] == 1]
        pairs_q.append(q[hit])
        pairs_w.append(lo[hit])
        lo = lo + (size[lo] == at)  # the run's other words go on (a list has each word once)
        on = lo < hi
        q, lo, hi, at, d = q[on], lo[on], hi[on], at[on], d[on]
        if not len(q):
            break
        # runs with one more code point in common begin at the run's first word and wherever the LCP is no longer than this
        a, b = np.searchsorted(begins, [at * (rows + 1) + lo + 1, at * (rows + 1) + hi])
        some = b - a
        who = np.repeat(np.arange(len(q)), some + 1)
        first = np.empty(len(who), np.int64)
        head = np.cumsum(some + 1) - (some + 1)
        inner = np.ones(len(who), bool)
        inner[head] = False
        first[head] = lo
        first[inner] = ragged_take(begins, a, some) - at[who[inner]] * (rows + 1)
        stop = np.append(first[1:], 0)
        stop[head + some] = hi
        c, qq, pos = text[first, at[who]], q[who], at[who]
        old = d[who]
        x = text[qq[:, None], np.minimum(pos[:, None] + np.arange(-1, 2), text.shape[1] - 1)]
        x[pos == 0, 0] = 0
        new = np.empty_like(old)
        new[:, 0] = np.minimum(old[:, 0] + (x[:, 0] != c), old[:, 1] + 1)
        new[:, 1] = np.minimum(np.minimum(old[:, 1] + (x[:, 1] != c), old[:, 2] + 1), new[:, 0] + 1)
        new[:, 2] = np.minimum(old[:, 2] + (x[:, 2] != c), new[:, 1] + 1)
        np.minimum(new, 2, out=new)
        on = new.min(1) <= 1
        q, lo, hi, at, d = qq[on], first[on], stop[on], pos[on] + 1, new[on]
    a, b = np.concatenate(pairs_q or [q]), np.concatenate(pairs_w or [q])
    # pairs of this list: the shorter word has k code points; a pair that shares both halves is counted by the first
    ok = np.minimum(size[a], size[b]) == k[a]
    a, b = a[ok], b[ok]
    half = k[a] // 2
    both = np.zeros(len(a), bool)
    back = np.flatnonzero(backward[a])
    if len(back):
        width = np.arange(int(half[back].max()))
        head = lambda r: text[r[:, None], np.clip(size[r][:, None] - 1 - width, 0, None)]
        equal = (head(a[back]) == head(b[back])) | (width >= half[back][:, None])
        both[back] = equal.all(1)
    a, b = a[~both], b[~both]
    words = np.array(seen.to_pylist(), object)
    spelled = lambda r: [w[::-1] if f else w for w, f in zip(words[r], backward[r])]
    near = np.array(spelled(b), object)
    order = np.lexsort((near.astype(str), -n[b], a)) if len(a) else np.zeros(0, np.int64)
    a, b, near = a[order], b[order], near[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(a)))
    return pa.record_batch(
        [pa.array(spelled(a[first]), pa.string()), pa.array(counts.astype(np.int64)), pa.array(n[b[first]].astype(np.int64)), pa.array(list(near[first]), pa.string())],
        names=["word", "n_near", "near_n", "near_word"],
    )


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n; distinct).

    A form is ``factor`` times as frequent as its word, so chains are short; the root is found by
    following forms twice as far in each round.
    """
    words = cut(words)
    near = near_words(words)
    known = F.col("near_n") >= factor * F.col("n")
    out = words.join(near, "word", "left").select(
        "word", F.when(known, F.col("near_word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(known, F.col("near_n")).alias("form_n"),
    )
    out = cut(out)
    up = out.select("word", F.coalesce("form", "word").alias("root"))
    top = out.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(1, math.log(max(top, factor), factor)) + 1)) if factor > 1 else 0):
        nxt = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        up = up.join(nxt, "root").select("word", F.col("above").alias("root"))
    return out.join(up, "word").select("word", "form", "root", "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their forms and roots: word, form, root, n, n_near, form_n."""
    return variants(word_counts(table(spark, sf_dir, "documents")))
