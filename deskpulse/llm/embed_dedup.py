"""Near-duplicate embeddings by an inverted multi-index (operator 1).

Method: every vector is cut into two halves, each with its own codebook; the
pair of nearest codewords is its cell in the product grid. A vector nearer to
codeword a than to c is at least ``(|x-c|^2 - |x-a|^2) / (2 |c-a|)`` away from
everything that is nearest to c; both halves' bounds, squared, add up to a
bound on the distance to a cell. A cell is visited, in the order of the
multi-sequence traversal of the bounds, until the bound exceeds the distance
that the threshold stands for, so no link is missed, whatever the vectors.
In visited cells a product over the first few turned coordinates (principal
axes of the sample) and the length of the rest bounds each cosine from above
(Cauchy-Schwarz); what can reach the threshold is verified by cosine in double
precision. In vectors without structure the bound excludes few cells and the
search is brute force over those first coordinates; the codebooks save work
where vectors lie in groups.

Bounds and skew: equal vectors are one class (a grouped minimum), so copies
cost one row. The rows of a label are dealt by a hash into blocks of at most
about SHARE bytes, so a hot cell is no hot key. Every two blocks of a label
meet once, in rounds: in round r, block s meets block s + r (of the label's
blocks, in a circle), for even s and then for odd s. A round moves about as
many rows as there are and its files are given back before the next one, so
disk grows with the rows, not with the meetings. A meeting holds one block and reads the other in pieces; it returns
at most one row per member (the number of its links and the root of its tree)
and an edge where two trees met. Pairs are never written out. Codebooks are
fitted on a bounded sample (SAMPLE vectors, taken in the order of a hash);
every vector is indexed.

Defined cases: vectors compare only within the same label and length. A null
label, a null, empty or zero vector, or one with a null, NaN or infinite
component, is linked with nothing (0 links, its own component). Repeated rows
of one vec_id count once (the row with the smallest label and vector); a
null vec_id is left out; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.llm.components import components
from deskpulse.llm.io import cut, release, shuffles_given_back, small_batches, table, tidy
from deskpulse.llm.textvec import mix

SAMPLE = 8192  # vectors that the codebooks are fitted on
CELL = 64  # vectors a cell should hold, on average over the largest label
CODEWORDS = 512  # at most, per half
RECALL = 0.995  # of isotropic neighbours, for the ``visits`` of ``fit_index``
SHARE = 1 << 25  # bytes of vectors in a block, on average
CHUNK = 1 << 15  # bytes of vectors that are moved as one row
ROWS = 512  # of the held block that visit together
COLUMNS = 1024  # that they meet at once
PIECE = 8192  # rows of the other block that are read at once
LET_THROUGH = 2e-5  # share of pairs that the first coordinates may leave to be verified
FEW = 100_000  # ids that are broadcast at most
SLACK = 1e-9  # on squared distances, for rounding


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sq_dists(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1))


def fit_codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = sq_dists(x, c).argmin(1)
        for j in range(len(c)):
            own = x[near == j]
            if len(own):
                c[j] = own.mean(0)
    return c


def traverse(d1: np.ndarray, d2: np.ndarray, visits: int) -> np.ndarray:
    """The first ``visits`` cells (i * len(d2) + j) of each row's multi-sequence
    traversal. A cell can be among them only if fewer than ``visits`` cells
    lie at or below it in both sorted sequences, so only the staircase
    (i + 1) * (j + 1) <= visits of the two sorted sequences is summed."""
    k1, k2 = d1.shape[1], d2.shape[1]
    visits = min(visits, k1 * k2)
    o1, o2 = d1.argsort(1, kind="stable"), d2.argsort(1, kind="stable")
    s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
    i, j = np.nonzero(np.outer(np.arange(1, k1 + 1), np.arange(1, k2 + 1)) <= visits)
    sums = s1[:, i] + s2[:, j]
    best = sums.argsort(1, kind="stable")[:, :visits]
    return o1[np.arange(len(d1))[:, None], i[best]] * k2 + o2[np.arange(len(d1))[:, None], j[best]]


def fit_index(x: np.ndarray, largest: int, threshold: float, recall: float = RECALL) -> dict:
    """Codebooks of both halves, and the number of visits that meets isotropic
    neighbours at the threshold (a figure; the search goes by ``bounds``)."""
    rng = np.random.default_rng(11)
    half = x.shape[1] // 2
    k = int(min(CODEWORDS, max(2, np.ceil(np.sqrt(largest / CELL))), max(1, len(x) // 4)))
    c1, c2 = fit_codebook(x[:, :half], k, rng) if half else np.zeros((1, 0)), fit_codebook(x[:, half:], k, rng)
    probe = x[:1024]
    u = rng.standard_normal(probe.shape)
    u -= (u * probe).sum(1, keepdims=True) * probe
    norm = np.sqrt((u * u).sum(1, keepdims=True))
    other = threshold * probe + np.sqrt(1 - threshold**2) * u / np.maximum(norm, 1e-12)
    cells = lambda v: sq_dists(v[:, :half], c1).argmin(1) * len(c2) + sq_dists(v[:, half:], c2).argmin(1)
    ranks = []
    for a, b in ((probe, other), (other, probe)):
        order = traverse(sq_dists(a[:, :half], c1), sq_dists(a[:, half:], c2), len(c1) * len(c2))
        ranks.append((order == cells(b)[:, None]).argmax(1))
    seen = np.minimum(*ranks)  # a pair is met if either of them visits the other's cell
    return {"c1": c1, "c2": c2, "half": half, "visits": int(np.quantile(seen, recall, method="higher")) + 1}


def bounds(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """At most the squared distance of each row to anything nearest to each codeword."""
    d, apart = sq_dists(x, c), np.sqrt(sq_dists(c, c))
    near = d.argmin(1)
    gap = d - d[np.arange(len(x)), near][:, None] - 1e-12
    apart = apart[near]
    return np.where(apart > 1e-6, np.maximum(0, gap) / (2 * np.maximum(apart, 1e-6)), 0) ** 2


def reachable(x: np.ndarray, m: dict, threshold: float) -> np.ndarray:
    """Every cell that can hold a vector linked with a row of ``x``."""
    most = 2 - 2 * threshold + SLACK
    l1, l2 = bounds(x[:, : m["half"]], m["c1"]), bounds(x[:, m["half"] :], m["c2"])
    least1, least2 = l1.min(0), l2.min(0)
    inside = int((least1[:, None] + least2 <= most).sum())
    cells = np.arange(len(least1) * len(least2))
    if inside < len(cells):
        cells = traverse(least1[None], least2[None], inside)[0]  # of the rows together
    out, left = np.zeros(len(cells), bool), np.arange(len(cells))
    i, j = np.divmod(cells, len(m["c2"]))
    for a, b in zip(l1, l2, strict=True):
        near = a[i] + b[j] <= most
        out[left[near]] = True
        if near.any():  # a cell needs one row only
            left, i, j = left[~near], i[~near], j[~near]
            if not len(left):
                break
    return cells[out]


def fit_prefix(x: np.ndarray, threshold: float) -> np.ndarray:
    """The first principal axes (columns) of ``x``, as many as let through few pairs below the threshold."""
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    probe = x[:1024] @ axes
    below = probe @ probe.T < threshold
    for k in (7, 11, 15, 23, 31, 47, 63, 95, 127, 191, 255, 383, 511, 767):  # with the rest's length, widths that products are fast for
        if k >= x.shape[1]:
            break
        low = prefix(probe, k)
        if (below & (low @ low.T >= threshold)).sum() <= LET_THROUGH * below.size:
            return np.ascontiguousarray(axes[:, :k])
    return axes


def prefix(x: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` columns and the length of the rest: products of two such rows are at least the cosine."""
    low = x[:, :k]
    rest = np.sqrt(np.maximum(0, 1 - (low * low).sum(1, keepdims=True)))
    return np.concatenate([low, rest], 1).astype(np.float32)


class _Block:
    """Rows of one block, in the order of their cells."""

    def __init__(self, chunks: list[tuple[bytes, bytes, bytes]], kind: str, dim: int, m: dict | None):
        ids, copies, vecs = (b"".join(c) for c in zip(*chunks, strict=True))
        self.ids, self.copies = np.frombuffer(ids, np.int64), np.frombuffer(copies, np.int64)
        self.raw, self.cell, low = np.frombuffer(vecs, kind).reshape(len(self.ids), dim), np.zeros(len(self.ids), np.int32), []
        some = min(PIECE, max(1, (1 << 22) // dim))
        for at in range(0, len(self.ids), some):
            x = unit(self.raw[at : at + some])
            if m is not None:
                self.cell[at : at + some] = cells_of(x, m)
            low.append(prefix(x, min(dim, 31)) if m is None else prefix(x @ m["axes"], m["axes"].shape[1]))
        order = self.cell.argsort(kind="stable")
        self.ids, self.copies, self.raw, self.cell, self.low = self.ids[order], self.copies[order], self.raw[order], self.cell[order], np.concatenate(low)[order]
        self.found, self.root = np.zeros(len(order), np.int64), self.ids.copy()

    def linked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.found)
        return self.ids[at], self.found[at], self.root[at]


def cells_of(x: np.ndarray, m: dict) -> np.ndarray:
    return sq_dists(x[:, : m["half"]], m["c1"]).argmin(1) * len(m["c2"]) + sq_dists(x[:, m["half"] :], m["c2"]).argmin(1)


def reached(x: _Block, m: dict | None, threshold: float) -> list[np.ndarray | None]:
    """For every ROWS rows of ``x``, which cells they visit; None: all."""
    out = []
    for lo in range(0, len(x.ids), ROWS):
        visits = None
        if m is not None:
            cells = reachable(unit(x.raw[lo : lo + ROWS]), m, threshold)
            if len(cells) < len(m["c1"]) * len(m["c2"]):
                visits = np.zeros(len(m["c1"]) * len(m["c2"]), bool)
                visits[cells] = True
        out.append(visits)
    return out


def meet(x: _Block, y: _Block, visits: list[np.ndarray | None], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Adds the links between ``x`` and ``y`` (between the rows of ``x`` if they are the same) to both; returns edges between trees that met."""
    least = threshold - 4 * (x.low.shape[1] + 8) * 2.0**-24  # for rounding in single precision
    edges, bound = [], np.empty((ROWS, COLUMNS), np.float32)
    for k, lo in enumerate(range(0, len(x.ids), ROWS)):
        at = np.arange(lo if x is y else 0, len(y.ids))
        if visits[k] is not None:
            at = at[visits[k][y.cell[at]]]
        whole = len(at) and at[-1] - at[0] + 1 == len(at)
        for c in range(0, len(at), COLUMNS):
            cols = at[c : c + COLUMNS]
            to = y.low[cols[0] : cols[-1] + 1] if whole else y.low[cols]
            own = x.low[lo : lo + ROWS]
            hit = np.matmul(own, to.T, out=bound[: len(own), : len(to)] if len(to) == COLUMNS else None) >= least
            rows = hit.any(1).nonzero()[0]
            if len(rows):
                near = hit[rows].any(0).nonzero()[0]
                edges += _verified(x, rows + lo, y, cols[near], threshold)
    edges = np.unique(np.concatenate(edges, 1), axis=1) if edges else np.zeros((2, 0), np.int64)
    return edges[0], edges[1]


def _verified(x: _Block, rows: np.ndarray, y: _Block, cols: np.ndarray, threshold: float) -> list[np.ndarray]:
    link = unit(x.raw[rows]) @ unit(y.raw[cols]).T >= threshold
    if x is y:  # every pair once
        link &= rows[:, None] < cols
    hx, hy = link.any(1), link.any(0)
    if not hx.any():
        return []
    link, rows, cols = link[hx][:, hy], rows[hx], cols[hy]
    x.found[rows] += link @ y.copies[cols]
    y.found[cols] += x.copies[rows] @ link
    was_x, was_y = x.root[rows], y.root[cols]
    rx, ry, big = was_x, was_y, np.iinfo(np.int64).max
    while True:  # smallest root within the meeting, along links
        nx = np.minimum(rx, np.where(link, ry, big).min(1))
        ny = np.minimum(ry, np.where(link, nx[:, None], big).min(0))
        if x is y:  # a row can be on both sides
            _, both, other = np.intersect1d(rows, cols, assume_unique=True, return_indices=True)
            nx[both] = ny[other] = np.minimum(nx[both], ny[other])
        if (nx == rx).all() and (ny == ry).all():
            break
        rx, ry = nx, ny
    x.root[rows], y.root[cols] = rx, ry
    # a root that isn't kept is tied to the new one; a row's own id is tied at the end
    was, now, ids = np.concatenate([was_x, was_y]), np.concatenate([rx, ry]), np.concatenate([x.ids[rows], y.ids[cols]])
    tied = (was != now) & (was != ids)
    return [np.unique(np.stack([was[tied], now[tied]]), axis=1)] if tied.any() else []


def embedding_links(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id) under the given id name: the number of
    other vectors linked directly, and the smallest id reachable by links.
    ``vectors`` is read several times, so that no whole copy of it is kept."""
    spark = vectors.sparkSession
    small_batches(spark)
    kind = "<f4" if dict(vectors.dtypes)[vec_col] == "array<float>" else "<f8"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec")).where("id is not null")
    with shuffles_given_back(spark):
        members, index, sizes, models = _classes(rows, threshold, kind)
        release(spark)
        pairs = _linked(*index, sizes, models, threshold, kind)
        del index
        release(spark)
        counts = cut(pairs.groupBy("id").agg(F.sum("found").alias("found")))
        comp = cut(_trees(pairs))
        members = _hinted(members)
    out = (
        rows.select("id").distinct()
        .join(members, "id", "left")
        .withColumns({"rep": F.coalesce("rep", "id"), "copies": F.coalesce("copies", F.lit(1))})
        .join(counts.withColumnRenamed("id", "rep"), "rep", "left")
        .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    )
    return out.select(F.col("id").alias(id_col), (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))


def _classes(rows: DataFrame, threshold: float, kind: str) -> tuple[DataFrame, tuple[DataFrame, int], DataFrame, dict[int, dict]]:
    """Of (id, label, vec) rows: the members of classes of equal vectors (id, rep, copies), where there is more than
    one; the index of one row a class, with the most blocks of a label; the classes by label and length; the models."""
    base = _once(rows)
    wrong = F.exists("vec", lambda x: x.isNull()) | F.isnan(F.array_max("vec")) | (F.array_max("vec") == float("inf")) | (F.array_min("vec") == -float("inf"))
    zero = (F.array_max("vec") == 0) & (F.array_min("vec") == 0)
    usable = base.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & ~F.coalesce(wrong | zero, F.lit(True)))
    # 128 bits stand for label and vector where only equality counts
    usable = usable.withColumns({"dim": F.size("vec"), "f1": F.xxhash64("label", "vec"), "f2": F.xxhash64(F.lit(1), "label", "vec")})
    narrow = cut(usable.select("id", "label", "dim", "f1", "f2"))
    same = cut(narrow.groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).where("copies > 1"))
    members = cut(narrow.join(_hinted(same), ["f1", "f2"]).select("id", "rep", "copies"))
    reps, one = narrow, usable.withColumn("copies", F.lit(1).cast("long"))
    if not members.isEmpty():
        reps = narrow.join(_hinted(members.where("id != rep").select("id")), "id", "left_anti")
        if _few(members):
            one = usable.join(F.broadcast(members), "id", "left").where("rep is null or rep = id").withColumn("copies", F.coalesce("copies", F.lit(1).cast("long")))
        else:
            one = usable.groupBy("f1", "f2").agg(F.min(F.struct("id", "label", "vec", "dim")).alias("s"), F.count("*").alias("copies")).select("s.*", "copies")
    sizes = cut(reps.groupBy(F.col("label").cast("string").alias("label"), "dim").count())
    sample = reps.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id")  # bounded by SAMPLE
    sample = usable.join(F.broadcast(sample), "id", "left_semi").orderBy(F.xxhash64("id"), "id").select("dim", "vec").collect()
    return members, _index(one, sizes, kind), sizes, _models(sizes, sample, threshold)


def _trees(pairs: DataFrame) -> DataFrame:
    return components(pairs.where("root != id").select(F.col("id").alias("a"), F.col("root").alias("b")))


def _few(rows: DataFrame) -> bool:
    return rows.limit(FEW + 1).count() <= FEW


def _hinted(rows: DataFrame) -> DataFrame:
    """``rows`` (cut), to be broadcast if they are few: the other side of a join stays where it is."""
    return F.broadcast(rows) if _few(rows) else rows


def _once(rows: DataFrame) -> DataFrame:
    """One row an id, the smallest; rows of ids that come once are not moved where few ids come again."""
    smallest = lambda x: x.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("s")).select("id", "s.*")
    again = cut(rows.groupBy("id").count().where("count > 1").select("id"))
    if again.isEmpty():
        return rows
    if not _few(again):
        return smallest(rows)
    return rows.join(F.broadcast(again), "id", "left_anti").unionByName(smallest(rows.join(F.broadcast(again), "id", "left_semi")))


def _models(sizes: DataFrame, sample: list, threshold: float) -> dict[int, dict]:
    """Codebooks and first axes of the 64 most populous lengths."""
    models = {}
    for dim, largest in sizes.groupBy("dim").agg(F.max("count").alias("largest")).orderBy(F.desc("largest")).limit(64).collect():
        own = [r["vec"] for r in sample if r["dim"] == dim]
        if len(own) >= 8:
            x = unit(np.array(own, dtype=np.float64))
            models[dim] = fit_index(x, largest, threshold) | {"axes": fit_prefix(x, threshold)}
    return models


def _index(rows: DataFrame, sizes: DataFrame, kind: str) -> tuple[DataFrame, int]:
    """Rows dealt into blocks (label, dim, block, blocks, ids, copies, vecs), many a row, cut; and the most blocks of a label."""
    share, chunk = SHARE, CHUNK
    size = F.col("dim") * int(kind[-1])
    large = sizes.where(F.col("count") * size > share).collect()  # a row per SHARE bytes at most
    parts = {(r["label"], r["dim"]): -(-r["count"] * r["dim"] * int(kind[-1]) // share) for r in large}
    shared = rows.sparkSession.sparkContext.broadcast(parts)

    def packed(held):
        b = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        dims, ids, copies = (b.column(c).to_numpy() for c in ("dim", "id", "copies"))
        names = b.column("label").cast(pa.string()).dictionary_encode()
        code, names = names.indices.to_numpy(), names.dictionary.to_pylist()
        off = b.column("vec").offsets.to_numpy()
        flat = b.column("vec").values.to_numpy(zero_copy_only=False).astype(kind)
        blocks = np.array([shared.value.get((names[c], d), 1) for c, d in zip(code, dims.tolist(), strict=True)])
        block = (mix(ids.view(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)
        order = np.lexsort((block, code, dims))
        key = np.stack([dims, code, block])[:, order]
        starts = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, [len(order)]])
        out = []
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            dim = int(dims[order[lo]])
            most = max(1, chunk // (dim * int(kind[-1])))
            for at in (order[i : min(hi, i + most)] for i in range(lo, hi, most)):
                out.append((names[code[at[0]]], dim, int(block[at[0]]), int(blocks[at[0]]), ids[at].tobytes(), copies[at].tobytes(), flat[off[at][:, None] + np.arange(dim)].tobytes()))
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 3), strict=True)], names=["label", "dim", "block", "blocks", "ids", "copies", "vecs"])

    def pack(batches):
        held = []
        for b in batches:
            if b.num_rows:
                held.append(b)
            if sum(x.nbytes for x in held) > 1 << 24:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    packs = rows.select("id", "label", "dim", "copies", "vec").mapInArrow(tidy(pack), "label string, dim int, block int, blocks int, ids binary, copies binary, vecs binary")
    return cut(packs), max(parts.values(), default=1)


def _linked(index: DataFrame, blocks: int, sizes: DataFrame, models: dict[int, dict], threshold: float, kind: str) -> DataFrame:
    """(id, found, root) rows of all meetings, cut by rounds."""
    shared = index.sparkSession.sparkContext.broadcast(models)  # at most 2 x CODEWORDS codewords and the axes, a square of the length

    def search(batches) -> Iterator[pa.RecordBatch]:
        key, chunks, x, visits = None, [], None, []

        def rows(ids, found, root):
            return pa.record_batch([pa.array(ids), pa.array(found), pa.array(root)], names=["id", "found", "root"])

        def go(side, last):
            """Works off the chunks that are held."""
            nonlocal chunks, x, visits
            dim = key[1]
            m = shared.value.get(dim)
            if chunks:
                y, chunks = _Block(chunks, kind, dim, m), []
                if not side:
                    x, visits = y, reached(y, m, threshold)
                if side or key[2] == key[3]:
                    was, now = meet(x, y, visits, threshold)
                    yield rows(was, np.zeros(len(was), np.int64), now)
                    if x is not y:
                        yield rows(*y.linked())
            if last and x is not None:
                yield rows(*x.linked())
                x = None

        side, held = 0, 0
        for b in batches:
            cols = [b.column(c) for c in ("label", "dim", "s", "t", "side", "ids", "copies", "vecs")]
            for r in range(b.num_rows):
                *k, now, ids, copies, vecs = (c[r].as_py() for c in cols)
                if key is not None and (k != key or now != side or side and held >= PIECE):
                    yield from go(side, k != key)
                    held = 0
                key, side = k, now
                chunks.append((ids, copies, vecs))
                held += len(ids) // 8
        if key is not None:
            yield from go(side, True)

    pairs, held, rows = None, 0, sizes.agg(F.sum("count")).first()[0] or 0
    for r, half in [(0, ""), *((r, f"k.s % 2 = {odd} and ") for r in range(1, blocks // 2 + 1) for odd in (0, 1))]:
        # in a circle of blocks, block s calls block s + r; half way round, only the first half calls
        side = lambda s, t, k: F.struct(F.expr(s).cast("int").alias("s"), F.expr(t).cast("int").alias("t"), F.lit(k).alias("side"))
        sides = [side("block", f"(block + {r}) % blocks", 0)] + ([side(f"(block - {r} + blocks) % blocks", "block", 1)] if r else [])
        met = index.where(f"2 * {r} <= blocks").select("label", "dim", "blocks", F.explode(F.array(*sides)).alias("k"), "ids", "copies", "vecs")
        met = met.where(f"{half}(2 * {r} < blocks or k.s < k.t)").select("label", "dim", "k.*", "ids", "copies", "vecs")
        met = met.repartition("label", "dim", "s", "t").sortWithinPartitions("label", "dim", "s", "t", "side")
        found = cut(met.mapInArrow(tidy(search), "id long, found long, root long"))
        pairs, held = found if pairs is None else pairs.union(found), held + found.count()
        if r and held > rows:  # or linked rows would be kept once a round
            sums = cut(pairs.groupBy("id").agg(F.sum("found").alias("found")).select("id", "found", F.col("id").alias("root")))
            pairs, held = sums.union(cut(_trees(pairs).select("node", F.lit(0).cast("long"), "component_id"))), 0
            del sums
        del met, found
        release(index.sparkSession)
    return pairs


def op1_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query over all embeddings, cosine >= 0.93."""
    out = embedding_links(table(spark, sf_dir, "embeddings"), 0.93)
    return out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
