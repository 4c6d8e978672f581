import contextlib
import os
import tempfile
import threading

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from brute import union_find

from deskpulse.llm import embed_dedup
from deskpulse.llm.io import release, scratch_folder, table

SCHEMA = "vec_id long, embedding array<float>, label int, id string, copies int"


def expected(rows):
    links, n = [], {r[0]: 0 for r in rows}
    ok = [(i, np.array(v, float), l) for i, v, l, *_ in rows if v and l is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    for a, (i, x, l) in enumerate(ok):
        for j, y, m in ok[a + 1 :]:
            if l == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links.append((i, j))
                n[i] += 1
                n[j] += 1
    return n, union_find(n, links)


def check(out, rows):
    n, comp = expected(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out.collect()}
    assert got == {i: (n[i], comp[i]) for i in n}


def test_planted_groups_edges_and_clashing_names(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        if i < 150:  # near copies of one vector
            v = rng.standard_normal(16) * 0.05 + np.arange(16)
        elif i < 250:  # exact copies of one vector, in two labels
            v = np.ones(16) * 2
        else:
            v = rng.standard_normal(16)
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 2), "x", 1))
    rows += [
        (1000, None, 1, "x", 1), (1001, [0.0] * 16, 1, "x", 1), (1002, [1.0, None] + [0.0] * 14, 1, "x", 1), (1003, [float("nan")] * 16, 1, "x", 1),
        (1004, [float("inf")] + [0.0] * 15, 1, "x", 1), (1005, [2.0] * 16, None, "x", 1), (1006, [], 1, "x", 1), (1007, [2.0] * 3, 1, "x", 1), (1008, [1.0] * 3, 1, "x", 1),
    ]
    check(embed_dedup.embedding_links(spark.createDataFrame(rows + rows[:5], SCHEMA)), rows)


def test_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table(spark, d, "embeddings").collect()]
    check(embed_dedup.op1_embedding_near_dedup(spark, d), rows)


def test_empty(spark):
    assert embed_dedup.embedding_links(spark.createDataFrame([], SCHEMA)).count() == 0


def test_traversal_is_the_multi_sequence_order():
    rng = np.random.default_rng(2)
    d1, d2 = rng.random((20, 7)), rng.random((20, 5))
    for t in (1, 3, 12, 35):
        got = embed_dedup.traverse(d1, d2, t)
        sums = (d1[:, :, None] + d2[:, None, :]).reshape(20, -1)
        assert (np.take_along_axis(sums, got, 1) == np.sort(sums, 1)[:, :t]).all()


def test_calibrated_visits_reach_the_recall():
    rng = np.random.default_rng(3)
    x = embed_dedup.unit(rng.standard_normal((4000, 24)))
    m = embed_dedup.fit_index(x, 4000, 0.93)
    k = len(m["c2"])
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * embed_dedup.unit((u := rng.standard_normal(x.shape)) - (u * x).sum(1, keepdims=True) * x)
    h = m["half"]
    cell = lambda v: embed_dedup.sq_dists(v[:, :h], m["c1"]).argmin(1) * k + embed_dedup.sq_dists(v[:, h:], m["c2"]).argmin(1)
    visits = lambda v: embed_dedup.traverse(embed_dedup.sq_dists(v[:, :h], m["c1"]), embed_dedup.sq_dists(v[:, h:], m["c2"]), m["visits"])
    met = (visits(x) == cell(y)[:, None]).any(1) | (visits(y) == cell(x)[:, None]).any(1)
    assert m["visits"] < len(m["c1"]) * k and met.mean() >= 0.98


def test_low_rank_clusters_with_many_codewords_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(4)
    plane = rng.standard_normal((4, 32))
    centres = rng.standard_normal((60, 4))
    z = centres[rng.integers(0, 60, 1500)] + 0.25 * rng.standard_normal((1500, 4))
    rows = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(z @ plane + 0.01 * rng.standard_normal((1500, 32)))]
    monkeypatch.setattr(embed_dedup, "CELL", 4)
    check(embed_dedup.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")), rows)


def test_bounds_exclude_cells_but_no_neighbour():
    rng = np.random.default_rng(5)
    x = embed_dedup.unit(rng.standard_normal((3000, 3)) @ rng.standard_normal((3, 24)))
    m = embed_dedup.fit_index(x, 3000, 0.93)
    h, k = m["half"], len(m["c2"])
    cell = embed_dedup.sq_dists(x[:, :h], m["c1"]).argmin(1) * k + embed_dedup.sq_dists(x[:, h:], m["c2"]).argmin(1)
    seen = [embed_dedup.reachable(v[None], m, 0.93) for v in x[:300]]
    for v, cells in zip(x[:300], seen, strict=True):
        assert np.isin(cell[x @ v >= 0.93], cells).all()
    assert np.mean([len(c) for c in seen]) < len(m["c1"]) * k / 2


def grouped(rng, n, labels):
    """Rows in loose groups, with exact copies, in labels of different sizes."""
    centres = rng.standard_normal((40, 12))
    v = centres[rng.integers(0, 40, n)] + 0.12 * rng.standard_normal((n, 12))
    v[::9] = v[0]
    return [(i, [float(np.float32(x)) for x in w], int(labels[i % len(labels)]), "x", 1) for i, w in enumerate(v)]


@pytest.mark.parametrize("few", [0, 10, 1000])
def test_every_two_blocks_of_a_label_meet_once(spark, monkeypatch, few):
    rng = np.random.default_rng(6)
    rows = grouped(rng, 700, [1, 1, 1, 1, 2, 2, 2, 3, 3, 4])
    again = [(r[0], [x + 1 for x in r[1]], 5, "x", 1) for r in rows[:20]]  # larger labels: the first rows stay
    monkeypatch.setattr(embed_dedup, "SHARE", 12 * 4 * 60)  # 1 to 5 blocks a label
    monkeypatch.setattr(embed_dedup, "CHUNK", 12 * 4 * 7)
    monkeypatch.setattr(embed_dedup, "FEW", few)
    folds, trees = [], embed_dedup._trees
    monkeypatch.setattr(embed_dedup, "_trees", lambda pairs: folds.append(1) or trees(pairs))
    check(embed_dedup.embedding_links(spark.createDataFrame(rows + again, SCHEMA)), rows)
    assert len(folds) > 1  # results of several rounds were folded on the way


def test_trees_that_meet_late_are_one(spark, monkeypatch):
    # a chain of neighbours: each links with the next two, every component is whole only over all meetings
    angle = np.arange(300) * 0.3
    rng = np.random.default_rng(7)
    turn = np.linalg.qr(rng.standard_normal((16, 16)))[0]
    v = np.zeros((300, 16))
    v[:, 0], v[:, 1], v[:, 2] = np.cos(angle / 6), np.sin(angle / 6), np.arange(300) * 0.02
    v = v @ turn
    rows = [(int(i), [float(np.float32(x)) for x in v[k]], 1, "x", 1) for k, i in enumerate(rng.permutation(300))]
    monkeypatch.setattr(embed_dedup, "SHARE", 16 * 4 * 40)
    check(embed_dedup.embedding_links(spark.createDataFrame(rows, SCHEMA)), rows)


def test_prefixes_bound_the_cosine():
    rng = np.random.default_rng(8)
    for x in (rng.standard_normal((500, 40)), rng.standard_normal((500, 3)) @ rng.standard_normal((3, 40)) + 0.01 * rng.standard_normal((500, 40))):
        x = embed_dedup.unit(x)
        axes = embed_dedup.fit_prefix(x, 0.93)
        low = embed_dedup.prefix(x @ axes, axes.shape[1])
        assert (low @ low.T >= x @ x.T - 4 * (low.shape[1] + 8) * 2.0**-24).all()
    assert axes.shape[1] < 16  # in three dimensions a few are enough


def test_disk_grows_with_the_rows_and_not_with_the_meetings(spark, monkeypatch):
    rng = np.random.default_rng(9)
    n = 16_000
    flat = rng.standard_normal((n, 64)).astype(np.float32)
    path = f"{tempfile.mkdtemp(prefix='run-')}/embeddings.parquet"
    vecs = pa.ListArray.from_arrays(np.arange(0, flat.size + 1, 64, dtype=np.int32), flat.ravel())
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": vecs, "label": np.ones(n, np.int32)}), path)
    places = [str(x) for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    places.append(scratch_folder(spark).removeprefix("file:"))

    def used():
        total = 0
        for d in places:
            for at, _, names in os.walk(d):
                for x in names:
                    with contextlib.suppress(OSError):
                        total += os.path.getsize(f"{at}/{x}")
        return total

    release(spark)
    begun, most, done = used(), [0], threading.Event()

    def watch():
        while not done.wait(0.05):
            most[0] = max(most[0], used())

    key = "spark.sql.autoBroadcastJoinThreshold"
    threshold = spark.conf.get(key)
    spark.conf.set(key, "256k")  # the table is small, tables that it stands for are not
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        monkeypatch.setattr(embed_dedup, "SHARE", flat.nbytes // 8)  # 8 blocks
        assert embed_dedup.embedding_links(spark.read.parquet(path)).count() == n
    finally:
        done.set()
        watcher.join()
        spark.conf.set(key, threshold)
    assert (most[0] - begun) / flat.nbytes < 9
