"""Near-duplicate documents by b-bit MinHash (operator 2).

Method: MinHash minima of each document's word shingles give band keys; the
low bits of the minima, packed into longs, give an estimate of the Jaccard
similarity by counting equal lanes, corrected for chance collisions of the
kept bits. Documents meet in band buckets; the estimate discards most chance
meetings; what is left is confirmed on the full shingle sets, so no link
below the threshold is ever reported.

How it stays whole and bounded at any size:

* Texts with equal shingle sets are one class from the start (a grouped
  minimum of the doc_id over the set's 128-bit fingerprint), so a group of
  copies costs one row however large it is.
* Pairs are never written out. The members of a bucket are dealt into blocks
  of bounded size, and two blocks meet in numpy, where all their pairs are
  estimated at once. A meeting returns at most one row per member: the root
  of its tree in the graph of likely pairs.
* The components of those trees are families: documents that may be linked.
  Only families' texts are read again for their shingle sets. A family is
  dealt into blocks bounded by members and by shingles; where two blocks
  meet, every likely pair is confirmed on the full sets (by merging two
  sorted sets, or for many pairs by one product of incidence matrices), and
  again only trees are returned. A family of any size is thus many bounded
  tasks, and every likely pair is confirmed or already connected.

Defined cases: a null, empty or separator-only text has an empty set and is
linked with nothing (also not with another empty text); a text with fewer
words than a shingle has its whole sequence as its one shingle; repeated
rows of one doc_id count as one document (its shingles come from the row
with the smallest text); a null doc_id is left out; an empty table gives no
rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.llm.bloom import bloom_filter, in_bloom
from deskpulse.llm.components import components
from deskpulse.llm.io import cut, free_name, tidy
from deskpulse.llm.textvec import arrow_buffers, mix, shingle_hashes, slices, word_hashes

ROWS = 5  # minima per band
BITS = 4  # kept bits per minimum
MISS = 1e-6  # chance that a pair at the threshold shares no band
SLACK = 5.0  # standard deviations by which an estimate may fall short
BLOCK = 1024  # members per block
BLOCK_SHINGLES = 1 << 18  # shingles per block of a family
STRIP = 128  # rows of a block estimated at once
COLUMNS = 4096  # shingles per step of an incidence product


def band_count(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))


def _signatures(k: int, bands: int):
    """Arrow function: doc_id, text -> set size, set fingerprint, band keys, packed low bits."""
    n_hash = bands * ROWS
    rng = np.random.default_rng(7)
    mul = rng.integers(1, 2**63, n_hash, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, n_hash, dtype=np.uint64)
    lanes = 64 // BITS
    words = -(-n_hash // lanes)
    shift = (np.arange(n_hash) % lanes * BITS).astype(np.uint64)
    band_no = np.arange(bands, dtype=np.uint64)

    def minima(s: np.ndarray) -> np.ndarray:
        low = np.full(n_hash, np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(s), 2048):
            h = s[at : at + 2048, None] * mul
            h += add
            h ^= h >> np.uint64(32)
            np.minimum(low, h.min(axis=0), out=low)
        return low

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                h, first = word_hashes(*arrow_buffers(b.column("text")))
                n = b.num_rows
                size, f1, f2 = (np.zeros(n, np.int64) for _ in range(3))
                keys = np.zeros((n, bands), np.uint64)
                sig = np.zeros((n, words), np.uint64)
                for i in range(n):
                    s = shingle_hashes(h[first[i] : first[i + 1]], k)
                    size[i] = len(s)
                    if not len(s):
                        continue
                    f1[i] = int(s.sum(dtype=np.uint64).astype(np.int64))
                    f2[i] = int(mix(s).sum(dtype=np.uint64).astype(np.int64))
                    low = minima(s)
                    acc = band_no.copy()
                    for r in range(ROWS):
                        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + low[r::ROWS])
                    keys[i] = acc
                    part = (mix(low) & np.uint64(2**BITS - 1)) << shift
                    np.bitwise_or.at(sig[i], np.arange(n_hash) // lanes, part)
                lists = lambda a, w: pa.ListArray.from_arrays(np.arange(0, n * w + 1, w, dtype=np.int32), pa.array(a.astype(np.int64).ravel()))
                yield pa.record_batch(
                    [b.column("doc_id"), pa.array(size), pa.array(f1), pa.array(f2), lists(keys, bands), lists(sig, words)],
                    names=["doc_id", "n_shingles", "f1", "f2", "bands", "sig"],
                )

    return run


def shingle_sets(docs: DataFrame, k: int, wanted: DataFrame) -> DataFrame:
    """(doc_id, shingles): sorted distinct shingle hashes of the whole texts of
    the wanted documents. A Bloom filter of fixed size, made from the wanted
    ids, drops most other rows where they are scanned, so texts are not
    shuffled; the exact choice is the caller's join on doc_id."""
    bloom = docs.sparkSession.sparkContext.broadcast(bloom_filter(wanted))

    def run(batches):
        for whole in batches:
            whole = whole.filter(pa.array(in_bloom(bloom.value, whole.column("doc_id").to_numpy())))
            for b in slices(whole, "text"):
                h, first = word_hashes(*arrow_buffers(b.column("text")))
                sets = [shingle_hashes(h[first[i] : first[i + 1]], k).astype(np.int64) for i in range(b.num_rows)]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate([*sets, np.zeros(0, np.int64)])
                yield pa.record_batch([b.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(flat))], names=["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, shingles array<long>")


def _similar(equal_lanes: np.ndarray, n_hash: int) -> np.ndarray:
    """b-bit estimate of the Jaccard similarity: equal lanes less those that
    are equal by chance."""
    chance = 2.0**-BITS
    return (equal_lanes / n_hash - chance) / (1 - chance)


def _least_estimate(threshold: float, n_hash: int) -> float:
    chance = 2.0**-BITS
    p = chance + (1 - chance) * threshold
    return threshold - SLACK * math.sqrt(p * (1 - p) / n_hash) / (1 - chance)


def _likely(sx, sy, nx, ny, n_hash: int, least: float, percent: int) -> np.ndarray:
    """Boolean matrix: pairs whose sizes and signatures allow the threshold."""
    ones = np.uint64(int("1" * (64 // BITS), 2**BITS))
    out = np.minimum(nx[:, None], ny) * 100 >= np.maximum(nx[:, None], ny) * percent
    for at in range(0, len(nx), STRIP):
        differ = np.zeros((min(STRIP, len(nx) - at), len(ny)), np.int64)
        for w in range(sx.shape[1]):  # a lane differs if any of its bits does
            z = sx[at : at + STRIP, w, None] ^ sy[:, w]
            z |= z >> np.uint64(1)
            z |= z >> np.uint64(2)
            differ += np.bitwise_count(z & ones)
        out[at : at + STRIP] &= _similar(n_hash - differ, n_hash) >= least
    return out


def _trees(link: np.ndarray, xi: np.ndarray, yi: np.ndarray) -> pa.RecordBatch:
    """(a, b): every member with a link and the smallest member reachable within the meeting."""
    rx, ry = xi.copy(), yi.copy()
    big = np.iinfo(np.int64).max
    while True:
        nx = np.minimum(rx, np.where(link, ry, big).min(1))
        ny = np.minimum(ry, np.where(link, nx[:, None], big).min(0))
        if (nx == rx).all() and (ny == ry).all():
            break
        rx, ry = nx, ny
    hx, hy = link.any(1), link.any(0)
    return pa.record_batch([pa.array(np.concatenate([xi[hx], yi[hy]])), pa.array(np.concatenate([rx[hx], ry[hy]]))], names=["a", "b"])


def _meetings(members: DataFrame, group: str, row) -> DataFrame:
    """(xs, ys): every two blocks of a group once, a block with itself included.
    ``members`` has the columns of ``row``, ``doc_id``, ``group`` and ``blocks``."""
    dealt = members.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    packed = dealt.groupBy(group, "blocks", "block").agg(F.collect_list(row).alias("rows"))
    # a block goes to its meetings with itself and with every other block
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("block"), o).alias("i"), F.greatest(F.col("block"), o).alias("j")))
    sent = packed.select(group, "block", "rows", F.explode(meets).alias("p"))
    both = sent.groupBy(group, "p").agg(F.array_sort(F.collect_list(F.struct("block", "rows"))).alias("two"))
    return both.select(F.get("two", 0)["rows"].alias("xs"), F.get("two", F.size("two") - 1)["rows"].alias("ys"))


def _array(rows: pa.StructArray, c: str) -> np.ndarray:
    return rows.field(c).to_numpy(zero_copy_only=False)


def _matrix(rows: pa.StructArray) -> np.ndarray:
    flat = rows.field("sig").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return flat.reshape(len(rows), -1)


def _likely_trees(members: DataFrame, n_hash: int, least: float, percent: int) -> DataFrame:
    """Trees (a, b) of the likely pairs within buckets."""

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                x, y = b.column("xs")[r].values, b.column("ys")[r].values
                xi, yi = _array(x, "doc_id"), _array(y, "doc_id")
                ok = _likely(_matrix(x), _matrix(y), _array(x, "n_shingles"), _array(y, "n_shingles"), n_hash, least, percent)
                ok &= xi[:, None] != yi
                if ok.any():
                    yield _trees(ok, xi, yi)

    blocked = members.withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    return _meetings(blocked, "bucket", F.struct("doc_id", "n_shingles", "sig")).mapInArrow(tidy(run), "a long, b long")


def _common(ok: np.ndarray, xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of the pairs marked in ``ok`` (0 elsewhere):
    pair by pair, or for many pairs as a product of incidence matrices."""
    out = np.zeros(ok.shape, np.int64)
    i, j = np.nonzero(ok)
    rows, cols = np.unique(i), np.unique(j)
    flat = np.concatenate([xs[k] for k in rows] + [ys[k] for k in cols])
    if len(i) * 60 < len(rows) * len(cols) + len(flat):
        for a, b in zip(i, j, strict=True):
            out[a, b] = len(np.intersect1d(xs[a], ys[b], assume_unique=True))
        return out
    _, col = np.unique(flat, return_inverse=True)
    own = np.concatenate([np.full(len(xs[k]), r) for r, k in enumerate(rows)] + [np.full(len(ys[k]), len(rows) + c) for c, k in enumerate(cols)])
    order = np.argsort(col, kind="stable")
    col, own = col[order], own[order]
    total = np.zeros((len(rows), len(cols)))
    for lo in range(0, int(col[-1]) + 1, COLUMNS):
        a, b = np.searchsorted(col, [lo, lo + COLUMNS])
        m = np.zeros((len(rows) + len(cols), COLUMNS), np.float32)
        m[own[a:b], col[a:b] - lo] = 1
        total += m[: len(rows)] @ m[len(rows) :].T
    out[np.ix_(rows, cols)] = np.rint(total).astype(np.int64)
    return out


def _confirmed_trees(members: DataFrame, n_hash: int, least: float, percent: int) -> DataFrame:
    """Trees (a, b) of the pairs within families whose full sets reach the threshold."""

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                x, y = b.column("xs")[r].values, b.column("ys")[r].values
                xi, yi = _array(x, "doc_id"), _array(y, "doc_id")
                nx, ny = _array(x, "n_shingles"), _array(y, "n_shingles")
                ok = _likely(_matrix(x), _matrix(y), nx, ny, n_hash, least, percent)
                ok &= xi[:, None] < yi if xi[0] == yi[0] and len(xi) == len(yi) else xi[:, None] != yi
                if not ok.any():
                    continue
                sets = [[v.values.to_numpy(zero_copy_only=False) for v in z.field("shingles")] for z in (x, y)]
                common = _common(ok, *sets)
                ok &= 100 * common >= percent * (nx[:, None] + ny - common)
                if ok.any():
                    yield _trees(ok, xi, yi)

    return _meetings(members, "family", F.struct("doc_id", "n_shingles", "sig", "shingles")).mapInArrow(tidy(run), "a long, b long")


def minhash_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id): documents linked, directly
    or through others, by 100 * intersection >= percent * union of their
    ``k``-word shingle sets. class_id is the smallest doc_id with an equal set,
    component_id the smallest doc_id reachable."""
    bands = band_count(percent / 100)
    n_hash = bands * ROWS
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    sigs = docs.mapInArrow(tidy(_signatures(k, bands)), "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, sig array<long>")
    sigs = cut(sigs)
    one = sigs.select("doc_id", "n_shingles", "f1", "f2").groupBy("doc_id").agg(F.min(F.struct("n_shingles", "f1", "f2")).alias("s")).select("doc_id", "s.*")
    classes = one.where("n_shingles > 0").groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("class_id"))
    reps = cut(
        sigs.join(classes.select(F.col("class_id").alias("doc_id"), "n_shingles", "f1", "f2"), ["doc_id", "n_shingles", "f1", "f2"], "leftsemi")
        .dropDuplicates(["doc_id"])
        .select("doc_id", "n_shingles", "bands", "sig")
    )
    least = _least_estimate(percent / 100, n_hash)
    buckets = reps.select("doc_id", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    narrow = reps.select("doc_id", "n_shingles", "sig")
    members = buckets.join(shared, "bucket").join(narrow, "doc_id")
    family = cut(components(cut(_likely_trees(members, n_hash, least, percent).where("a != b").distinct())))
    sizes = family.join(narrow.select(F.col("doc_id").alias("node"), "n_shingles"), "node").groupBy("component_id")
    sizes = sizes.agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    kin = family.join(sizes, "component_id").select(F.col("node").alias("doc_id"), F.col("component_id").alias("family"), "blocks").join(narrow, "doc_id")
    sets = shingle_sets(docs, k, family.select(F.col("node").alias("doc_id")))
    links = cut(_confirmed_trees(kin.join(sets, "doc_id"), n_hash, least, percent).where("a != b"))
    return _labelled(one, classes, components(links))


def _labelled(one: DataFrame, classes: DataFrame, comp: DataFrame) -> DataFrame:
    out = one.join(classes, ["n_shingles", "f1", "f2"], "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    named = comp.select(F.col("node").alias("class_id"), "component_id")
    return out.join(named, "class_id", "left").select("doc_id", "n_shingles", "class_id", F.coalesce("component_id", "class_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest doc_id,
    null last. Every row is judged by its own text: rows without a doc_id take
    part, repeated rows are a group, and texts that share a doc_id are told
    apart. Texts without words stay."""
    key = free_name(docs, "row_key")
    rows = cut(docs.withColumn(key, F.monotonically_increasing_id()))  # kept, so that the numbers stay
    comp = minhash_components(rows.select(F.col(key).alias("doc_id"), "text"), k, percent).select(F.col("doc_id").alias(key), "component_id")
    ranked = rows.select(key, F.struct(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), F.col(key).alias("key")).alias("rank"))
    first = ranked.join(comp, key).groupBy("component_id").agg(F.min("rank").alias("rank")).select(F.col("rank.key").alias(key))
    return rows.join(first, key, "leftsemi").select(*docs.columns)


def op2_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: 3-word shingles, 100 * intersection >= 85 * union."""
    from deskpulse.llm.io import table

    out = minhash_components(table(spark, sf_dir, "documents"), k=3, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
