"""Benchmark decontamination by latent semantic retrieval (operator 10).

Method.
1. Word counts over all documents give inverse frequencies (hashed
   vocabulary of 2 ** WORD_BITS buckets; the commonest words weigh nothing).
2. A randomised SVD of the TF-IDF matrix of all passages (PASSAGE words
   each): every task multiplies its passages with a random test matrix and
   back, ``Y = A' (A O)``; the tasks' sums meet in Spark, and the driver takes
   the factors from the small matrices ``Y`` and ``O' Y`` (one-pass Nystroem
   form). One pass over the corpus, whatever its size.
3. Candidate search: windows of WINDOW words, every STEP words, are folded into
   the latent space and compared by cosine with windows of the benchmark items.
   Windows with less than LEAST_SHARED of their weight in words of the benchmark
   are passed over before, pairs with less than LEAST_OWN of it in words of that
   item after the search: parts of such windows can't make up the final cover.
4. Around each candidate the longest common subsequence of words with the
   item is taken (bit-parallel). A document is contaminated by an item if the
   subsequence covers COVER of the item's words and the answer check holds: of
   the item's last sentence, or of the rarest quarter of its words if it has
   only one sentence, at least half must stand in the region.

Everything over the documents runs in tasks; candidates never leave a task
before they are verified. Benchmark items are sent to tasks in shares of at
most ITEM_CHARS characters; a larger benchmark takes several searches.

Defined cases: null, empty and wordless texts and items match nothing;
items and documents shorter than a window are one window; repeated rows of a
document or item give one pair; several regions give the best coverage;
empty tables give no rows; other columns, whatever their names, are ignored
by the search and kept by ``drop_contaminated``, which judges every row by its
own text, with or without a doc_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.llm.io import table, tidy
from deskpulse.llm.textfeatures import PLAIN
from deskpulse.llm.textvec import arrow_buffers, mix, slices

WORD_BITS = 15
RANK, SKETCH = 48, 56
STOP = 250  # a word that is more than one in so many has weight zero
PASSAGE = 16
WINDOW, STEP, ITEM_STEP = 16, 8, 4
LEAST_SHARED = 0.6  # of a window's weight, in words of the benchmark
LEAST_OWN = 0.4  # of a window's weight, in words of one item
COSINE = 0.4
COVER = 0.6
LOOKED_UP = 0.25  # of the words needed, that a region must have of the rarest (any share is exact)
ITEM_CHARS = 8 << 20
BLOCK = 256  # vocabulary buckets per summed row
SUMMED = 128  # rows that a group adds up
LEVELS = 3  # of sums, for up to SUMMED ** LEVELS tasks
PASSAGES = 4096  # multiplied at once
COSINES = 1 << 22  # computed at once
LONG = 16  # rows from which on a sum is taken alone
MOST_HELD = 200_000  # words of items whose bits a task keeps,
MOST_BITS = 1_000  # of items of so many words at most


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - WORD_BITS)).astype(np.uint16)


def _summed(docs: DataFrame, width: int, dtype: str, add) -> np.ndarray:
    """Sum over all texts of a (2 ** WORD_BITS, width) matrix that ``add``
    accumulates per task; summed by blocks of rows in Spark. The tasks' blocks
    are added up in LEVELS levels, SUMMED neighbouring tasks in a group, so that
    no group grows with the number of tasks."""
    n = 2**WORD_BITS

    def part(batches):
        acc = np.zeros((n, width), dtype)
        for whole in batches:
            for b in slices(whole, "text"):
                h, first = PLAIN.tokens(*arrow_buffers(b.column("text")))
                if len(h):
                    add(acc, _bucket(h), first)
        for k in range(0, n, BLOCK):
            if acc[k : k + BLOCK].any():
                yield pa.record_batch([pa.array([k], pa.int32()), pa.array([acc[k : k + BLOCK].tobytes()], pa.binary())], names=["k", "v"])

    def total(kind: str):
        def add_up(t: pa.Table) -> pa.Table:
            acc = np.zeros(BLOCK * width, np.float64)
            for v in t.sort_by("m").column("v"):  # in the tasks' order
                acc += np.frombuffer(v.as_py(), kind)
            return pa.table({"k": t.column("k").slice(0, 1), "m": t.column("g").slice(0, 1), "v": pa.array([acc.tobytes()], pa.binary())})

        return add_up

    out = np.zeros((n, width))
    sums = docs.select("text").mapInArrow(tidy(part), "k int, v binary").withColumn("m", F.spark_partition_id())
    for level in range(LEVELS):
        group = F.lit(0) if level == LEVELS - 1 else F.floor(F.col("m") / SUMMED).cast("int")
        sums = sums.select("k", "m", "v", group.alias("g")).groupBy("k", "g").applyInArrow(total("<f8" if level else dtype), "k int, m int, v binary")
    for r in sums.collect():  # fixed size
        out[r["k"] : r["k"] + BLOCK] = np.frombuffer(r["v"]).reshape(BLOCK, width)
    return out


def fit_latent(docs: DataFrame) -> dict:
    """Inverse frequencies and fold-in matrix (words x RANK), of fixed size."""

    def count(acc, idx, first):
        acc[:, 0] += np.bincount(idx, minlength=len(acc))

    n = _summed(docs, 1, "<f8", count)[:, 0]
    idf = np.log((n.sum() + 1) / (n + 1)).astype(np.float32)
    idf[n * STOP > n.sum()] = 0
    test = np.random.default_rng(3).standard_normal((2**WORD_BITS, SKETCH)).astype(np.float32)

    def sketch(acc, idx, first):
        omega = weighted.value
        keep = idf[idx] > 0  # passages of words that weigh something
        idx, first = idx[keep], np.concatenate([[0], np.cumsum(keep)])[first]
        if not len(idx):
            return
        begins = np.append(passages(first), len(idx))
        for lo in range(0, len(begins) - 1, PASSAGES):
            at = begins[lo : lo + PASSAGES + 1]
            words, at = idx[at[0] : at[-1]], at - at[0]
            z = _row_sums(omega, words, at[:-1], np.diff(at))
            # back: every word adds its passage's row; words are sorted so that each bucket is one sum
            own = np.repeat(np.arange(len(z)), np.diff(at))
            order = np.argsort(words, kind="stable")
            w = words[order]
            starts = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            acc[w[starts]] += _row_sums(z, own[order], starts, np.diff(starts, append=len(w)))

    weighted = docs.sparkSession.sparkContext.broadcast(test * idf[:, None])  # 2 ** WORD_BITS x SKETCH floats
    y = _summed(docs, SKETCH, "<f4", sketch) * idf[:, None]
    shift = 1e-6 * max(np.linalg.norm(y), 1e-12)
    y += shift * test
    core = test.T.astype(np.float64) @ y
    vals, vecs = np.linalg.eigh((core + core.T) / 2)
    vals = np.maximum(vals, 1e-9 * max(vals.max(), 1e-30))
    u, s, _ = np.linalg.svd(y @ (vecs / np.sqrt(vals)), full_matrices=False)
    u, s = u[:, :RANK], np.maximum(s[:RANK], 1e-9 * max(s[0], 1e-30))  # s is the square of the singular values
    fold = (u / np.sqrt(s) * idf[:, None]).astype(np.float32)
    return {"idf": idf, "fold": fold / max(np.abs(fold).max(), 1e-30), "count": n}


def passages(first: np.ndarray, size: int = PASSAGE) -> np.ndarray:
    """Begins of the ``size``-word passages of all texts of a batch."""
    lens = np.diff(first)
    per = -(-lens // size)
    at = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(per)[:-1]]) * size, per)
    return at + np.arange(per.sum()) * size


def _row_sums(rows: np.ndarray, which: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of ``rows[which[b : b + n]]`` for each (b, n >= 1), each added up in this order: short ones
    side by side, a row of each at a time, those of more than LONG rows one by one."""
    out = np.empty((len(begin), rows.shape[1]), rows.dtype)
    by = np.argsort(-size, kind="stable")
    alone = int((size > LONG).sum())
    for k in by[:alone].tolist():
        out[k] = rows.take(which[begin[k] : begin[k] + size[k]], axis=0).sum(0)
    by = by[alone:]
    if len(by):
        at, n = begin[by], size[by]
        total = rows.take(which[at], axis=0)
        for j, left in enumerate(np.searchsorted(-n, -np.arange(1, n[0])).tolist(), 1):  # sums of more than j rows
            total[:left] += rows.take(which[at[:left] + j], axis=0)
        out[by] = total
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-30)


def item_index(items: list, model: dict) -> dict:
    """Latent windows, words and answers of a share of the benchmark."""
    rows = sorted({(r["item_id"], r["text"]) for r in items if r["text"] and r["item_id"] is not None})
    ids, words, answers, vec, owner = [], [], [], [], []
    for i, text in rows:
        h, _ = _tokens(text)
        if not len(h):
            continue
        k = len(words)
        ids.append(i)
        words.append(h)
        answers.append(_answer(text, h, model["idf"]))
        for at in range(0, max(1, len(h) - WINDOW + ITEM_STEP), ITEM_STEP):
            at = min(at, max(0, len(h) - WINDOW))
            vec.append(model["fold"][_bucket(h[at : at + WINDOW])].sum(0))
            owner.append(k)
    salt = mix(np.arange(1, len(words) + 1, dtype=np.uint64))
    keys = np.unique(np.concatenate([*[mix(w ^ x) for w, x in zip(words, salt, strict=True)], np.zeros(0, np.uint64)]))
    vocabulary = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]))
    return {
        "ids": np.array(ids, np.int64), "words": words, "answers": answers, "vocabulary": vocabulary, "sieve": _sieve(vocabulary), "salt": salt, "keys": keys, "key_sieve": _sieve(keys),
        "vec": _unit(np.array(vec, np.float32).reshape(len(vec), RANK)), "owner": np.array(owner, np.int64),
        **_rarest(words, model),
    }


def _rarest(words: list, model: dict) -> dict:
    """For the lookup: postings of each item's rarest words (by word: items and
    how often they have it among them), how many a region needs, and the regions."""
    key, item, often, least = [], [], [], []
    for k, h in enumerate(words):
        need = int(np.ceil(COVER * len(h)))
        m = max(1, int(need * LOOKED_UP))
        own, n = np.unique(h[np.argsort(model["count"][_bucket(h)], kind="stable")[: len(h) - need + m]], return_counts=True)
        key.append(own)
        often.append(n)
        item.append(np.full(len(own), k))
        least.append(m)
    key = np.concatenate([*key, np.zeros(0, np.uint64)])
    order = np.argsort(key, kind="stable")
    rare, begin = np.unique(key[order], return_index=True)
    n = np.array([len(h) for h in words], np.int64)
    step, length = np.maximum(1, n // 2), 2 * n + np.minimum(n, WINDOW)
    return {
        "rare": rare, "rare_sieve": _sieve(rare), "begin": np.append(begin, len(key)), "item": np.concatenate([*item, np.zeros(0, np.int64)]).astype(np.int64)[order],
        "often": np.concatenate([*often, np.zeros(0, np.int64)]).astype(np.int64)[order], "least": np.array(least, np.int64),
        "step": step, "length": length, "spans": -(-length // step),
    }


def _sieve(sorted_set: np.ndarray) -> np.ndarray:
    """By the first bits of a hash, whether ``sorted_set`` has any with them."""
    bits = min(24, max(10, (8 * len(sorted_set)).bit_length()))
    out = np.zeros(1 << bits, bool)
    out[(sorted_set >> np.uint64(64 - bits)).astype(np.int64)] = True
    return out


def _found(h: np.ndarray, sorted_set: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``h`` are in ``sorted_set``, and where; only what passes the sieve is looked up."""
    shift = np.uint64(64 - (len(sieve).bit_length() - 1))
    at = np.flatnonzero(sieve.take((h >> shift).view(np.int64)))
    place = np.searchsorted(sorted_set, h[at])
    if len(sorted_set):
        same = sorted_set[np.minimum(place, len(sorted_set) - 1)] == h[at]
        at, place = at[same], place[same]
    return at, place


def _tokens(text: str):
    data = np.frombuffer(text.encode(), np.uint8)
    return PLAIN.tokens(data, np.array([0, len(data)]))


def _answer(text: str, h: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Words of the last sentence; of a single sentence, its rarest quarter."""
    sentences = [s for s in text.replace("\n", ". ").split(". ") if s.strip(" .")]
    if len(sentences) > 1:
        last, _ = _tokens(sentences[-1])
        if len(last):
            return np.unique(last)
    return np.unique(h[np.argsort(-idf[_bucket(h)], kind="stable")[: max(1, len(h) // 4)]])


def item_bits(item: np.ndarray) -> dict[int, int]:
    """For each word of an item the places where it has it, one bit each."""
    at: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        at[w] = at.get(w, 0) | 1 << k
    return at


def lcs_length(item: np.ndarray, region: np.ndarray, at: dict[int, int] | None = None, least: float = 0) -> int:
    """Longest common subsequence, bit-parallel over the item's words (``at``: its bits, if known). A region
    with fewer than ``least`` words of the item gives their number, which the subsequence can't exceed."""
    at = item_bits(item) if at is None else at
    met = [at[w] for w in region.tolist() if w in at]
    if len(met) < least:
        return len(met)
    full = (1 << len(item)) - 1
    v = full
    for m in met:
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def _common(index: dict, i: int, region: np.ndarray) -> int:
    """Longest common subsequence of item ``i`` and a region; below COVER of the item it may be given too large."""
    item, held = index["words"][i], index.setdefault("held", {})
    at = held.get(i)
    if at is None:
        at = item_bits(item)
        index["n_held"] = index.get("n_held", 0) + len(item)
        if index["n_held"] > MOST_HELD:
            held.clear()
            index["n_held"] = len(item)
        if len(item) <= MOST_BITS:
            held[i] = at
    return lcs_length(item, region, at, COVER * len(item))


def find_in_batch(h: np.ndarray, first: np.ndarray, index: dict, model: dict) -> list[tuple[int, int, int]]:
    """(text number, item number, lcs) of the contaminations in a batch."""
    found: dict[tuple[int, int], int] = {}
    if len(h) and len(index["ids"]):
        _by_latent(h, first, index, model, found)
        _by_words(h, first, index, found)
    return [(t, i, n) for (t, i), n in found.items()]


def _holds(index: dict, i: int, region: np.ndarray) -> int:
    """Words of item ``i`` in order in the region, 0 if it doesn't hold the item."""
    words, answer = index["words"][i], index["answers"][i]
    got = _common(index, i, region)
    return got if got >= COVER * len(words) and np.isin(answer, region).sum() * 2 >= len(answer) else 0


def candidates(h: np.ndarray, first: np.ndarray, index: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, step number) of the first rare word of every region that
    has enough of them; a superset of the regions that hold an item."""
    at, word = _found(h, index["rare"], index["rare_sieve"])
    text = np.searchsorted(first, at, side="right") - 1
    per = index["begin"][word + 1] - index["begin"][word]
    post = np.repeat(index["begin"][word] - np.cumsum(per) + per, per) + np.arange(per.sum())
    item = index["item"][post]
    texts, most = len(first) - 1, int(np.diff(first).max()) + int(index["spans"].max()) + 1
    code = (item * texts + np.repeat(text, per)) * most + np.repeat(at - first[text], per) // index["step"][item]
    code, place = np.unique(code, return_inverse=True)
    # a word counts as often as the item has it, so one word said over and over is no candidate
    pair, one, n = np.unique(place * len(index["rare"]) + np.repeat(word, per), return_index=True, return_counts=True)
    total = np.bincount(pair // max(1, len(index["rare"])), np.minimum(n, index["often"][post[one]]), len(code))
    item, step = code // most // texts, code % most
    c = np.concatenate([[0], np.cumsum(total)])
    enough = c[np.searchsorted(code, code + index["spans"][item])] - c[:-1] >= index["least"][item]
    return (code // most % texts)[enough], item[enough], step[enough]


def _by_words(h: np.ndarray, first: np.ndarray, index: dict, found: dict) -> None:
    seen = set()
    for t, i, b in zip(*(x.tolist() for x in candidates(h, first, index)), strict=True):
        n, step, length = len(index["words"][i]), int(index["step"][i]), int(index["length"][i])
        if found.get((t, i), 0) == n:
            continue
        lo, hi = int(first[t]), int(first[t + 1])
        begin = max(0, b - int(index["spans"][i]) + 1)
        if _common(index, i, h[lo + begin * step : min(hi, lo + b * step + length)]) < max(COVER * n, found.get((t, i), 0) + 1):
            continue  # nor has any region within
        for k in range(begin, b + 1):
            if (t, i, k) not in seen:
                seen.add((t, i, k))
                got = _holds(index, i, h[lo + k * step : min(hi, lo + k * step + length)])
                if got:
                    found[(t, i)] = max(found.get((t, i), 0), got)


def _by_latent(h: np.ndarray, first: np.ndarray, index: dict, model: dict, found: dict) -> None:
    halves = passages(first, STEP)  # STEP-word pieces; a window is two neighbours
    weight = model["idf"][_bucket(h)].astype(np.float64)
    text_of = np.searchsorted(first, halves, side="right") - 1
    ends = np.append(halves[1:], len(h))
    pair = np.append(text_of[1:] == text_of[:-1], False)  # the next piece is of the same text
    alone = np.append(True, text_of[1:] != text_of[:-1]) & ~pair
    stop = np.where(pair, np.append(ends[1:], len(h)), ends)
    summed = lambda w: (c := np.concatenate([[0], np.cumsum(w)]))[stop] - c[halves]
    mass = summed(weight)
    known, _ = _found(h, index["vocabulary"], index["sieve"])
    shared = np.zeros(len(h))
    shared[known] = weight[known]
    near = np.flatnonzero((pair | alone) & (summed(shared) >= LEAST_SHARED * mass))
    if not len(near):
        return
    begin, size, mass, text_of = halves[near], (stop - halves)[near], mass[near], text_of[near]
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    take = np.repeat(begin - starts, size) + np.arange(size.sum())
    # within a window a repeated word weighs once for the items, so one word said over and over is no candidate
    _, once = np.unique(mix(h[take] ^ np.repeat(np.arange(len(near), dtype=np.uint64) << np.uint64(32), size)), return_index=True)
    weight_once = np.zeros(len(take))
    weight_once[once] = weight[take[once]]
    seen = set()
    ends = np.append(starts, len(take))
    rows = max(1, min(1024, COSINES // max(1, len(index["vec"]))))
    for lo in range(0, len(near), rows):
        at = ends[lo : lo + rows + 1]
        latent = _unit(np.add.reduceat(model["fold"][_bucket(h[take[at[0] : at[-1]]])], at[:-1] - at[0], axis=0))
        w, k = np.nonzero(latent @ index["vec"].T >= COSINE)
        code = np.unique((w + lo) * len(index["ids"]) + index["owner"][k])
        w, item = np.divmod(code, len(index["ids"]))
        at = np.repeat(starts[w] - np.concatenate([[0], np.cumsum(size[w])[:-1]]), size[w]) + np.arange(size[w].sum())
        of_item, _ = _found(mix(h[take[at]] ^ np.repeat(index["salt"][item], size[w])), index["keys"], index["key_sieve"])
        own = np.zeros(len(at))
        own[of_item] = weight_once[at[of_item]]
        keep = np.add.reduceat(own, np.concatenate([[0], np.cumsum(size[w])[:-1]])) >= LEAST_OWN * mass[w] if len(w) else np.zeros(0, bool)
        for a, i in zip(w[keep].tolist(), item[keep].tolist(), strict=True):
            n, t, at = len(index["words"][i]), int(text_of[a]), int(begin[a])
            key = (t, i, at // max(WINDOW, n // 2))
            if key in seen or found.get((t, i), 0) == n:
                continue
            got = _holds(index, i, h[max(int(first[t]), at - n) : min(int(first[t + 1]), at + WINDOW + n)])
            if got:
                seen.add(key)
                found[(t, i)] = max(found.get((t, i), 0), got)


def _searches(docs: DataFrame, benchmark: DataFrame):
    """(index, model) of each share of the benchmark, sent to the tasks one after the other."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").distinct()
    size = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    shares = max(1, -(-size // ITEM_CHARS))
    model = fit_latent(docs)
    for s in range(shares):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(shares)) == s).collect()  # about ITEM_CHARS characters
        yield docs.sparkSession.sparkContext.broadcast((item_index(own, model), model))


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, lcs_words, coverage): documents that hold an item."""
    out = None
    for sent in _searches(docs, benchmark):

        def run(batches, sent=sent):
            index, m = sent.value
            for whole in batches:
                for b in slices(whole, "text"):
                    h, first = PLAIN.tokens(*arrow_buffers(b.column("text")))
                    got = find_in_batch(h, first, index, m)
                    if got:
                        t, i, n = (np.array(x, np.int64) for x in zip(*got, strict=True))
                        cover = n / np.array([len(index["words"][k]) for k in i])
                        yield pa.record_batch([b.column("doc_id").take(pa.array(t)), pa.array(index["ids"][i]), pa.array(n), pa.array(cover)], names=["doc_id", "item_id", "lcs_words", "coverage"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id long, item_id long, lcs_words long, coverage double")
        out = part if out is None else out.union(part)
    best = out.groupBy("doc_id", "item_id").agg(F.max("lcs_words").alias("lcs_words"), F.max("coverage").alias("coverage"))
    return best


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; same columns.
    Every row is judged by its own text, whatever its doc_id."""
    out = docs
    for sent in _searches(docs, benchmark):

        def run(batches, sent=sent):
            index, m = sent.value
            for whole in batches:
                for b in slices(whole, "text"):
                    h, first = PLAIN.tokens(*arrow_buffers(b.column("text")))
                    clean = np.ones(b.num_rows, bool)
                    clean[[t for t, _, _ in find_in_batch(h, first, index, m)]] = False
                    yield b.filter(pa.array(clean))

        out = out.mapInArrow(tidy(run), docs.schema)
    return out


def op10_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item."""
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
