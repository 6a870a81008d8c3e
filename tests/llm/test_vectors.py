"""Top-k search and embedding near-dedup against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from logwise.llm import lattice, mtree

VECS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("n", T.StringType()),  # names used inside the operators
        T.StructField("share", T.StringType()),
    ]
)
ODD = [
    (900, None),
    (901, []),
    (902, [None] + [0.5] * 15),
    (903, [float("nan")] + [0.5] * 15),
    (904, [float("inf")] + [0.5] * 15),
    (905, [0.0] * 16),
    (None, [0.25] * 16),
    (907, [0.5] * 4),
]


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b") for i, v in rows], VECS)


def brute_top(rows, query, k):
    good = [(i, np.floor(256 * np.array(np.float32(v), dtype=np.float64))) for i, v in rows if i is not None and usable(v)]
    out = set()
    for q, x in {(i, tuple(z)) for i, z in good if query(i)}:
        scores = [(-int(np.dot(z, x)), i) for i, z in good if i != q and len(z) == len(x)]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return sorted(out)


def vectors(n, seed, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim)) * 0.3
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    copies = [(n + i, rows[3][1]) for i in range(40)]  # ties: many copies of one vector
    near = [(n + 50 + i, [float(x + rng.normal() * 0.004) for x in base[5]]) for i in range(30)]
    return rows + copies + near + ODD


@pytest.mark.parametrize("tree_size,max_trees", [(100_000, 4096), (60, 4096), (60, 2)])
def test_top_k_equals_brute_force(spark, tree_size, max_trees):
    rows = vectors(400, 1)
    df = frame(spark, rows)
    got = mtree.top_k(df, df.where("vec_id % 7 = 0"), tree_size=tree_size, max_trees=max_trees, capacity=8, fanout=4, query_block=16)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, lambda i: i % 7 == 0, 5)


def test_top_k_of_small_and_empty_tables(spark):
    rows = [(0, [1.0, -1.0]), (1, [1.0, -1.0]), (2, [3.0, 2.0])]
    df = frame(spark, rows)
    assert sorted(map(tuple, mtree.top_k(df, df).collect())) == brute_top(rows, lambda i: True, 5)
    assert mtree.top_k(frame(spark, []), frame(spark, [])).count() == 0
    assert mtree.top_k(df, frame(spark, ODD[:3])).count() == 0


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(4)
    numbers = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, numbers(v)) for i, v in enumerate(rng.normal(size=(60, 4)) * 1e7)]
    rows += [(70 + i, numbers(v)) for i, v in enumerate(rng.normal(size=(20, 4)) * 1e9)]
    rows += [(100 + i, numbers(v)) for i, v in enumerate([[1e18] * 4, [-1e18] * 4, [3e38, 0.0, 0.0, 1.0], [-3e38] * 4, [0.5] * 4])]
    rows += [(200, rows[0][1]), (201, rows[0][1])]

    def whole(v):
        return [int(np.clip(np.floor(256.0 * x), -np.finfo(float).max, np.finfo(float).max)) for x in v]

    edge = 2**63 - 1
    want = []
    with np.errstate(over="ignore"):
        ints = {i: whole(np.array(v)) for i, v in rows}
    for q in ints:
        found = [(max(-edge, min(edge, sum(a * b for a, b in zip(ints[q], ints[i], strict=True)))), i) for i in ints if i != q]
        found.sort(key=lambda x: (-x[0], x[1]))
        want += [(q, r + 1, i, s) for r, (s, i) in enumerate(found[:5])]
    df = frame(spark, rows)
    for tree_size in (1000, 16):
        assert sorted(map(tuple, mtree.top_k(df, df, tree_size=tree_size, capacity=4, fanout=3).collect())) == sorted(want)


def test_large_components_stay_exact():
    x = np.array([[2.0**30, 1.0], [2.0**30, 2.0]])
    assert mtree.exact_scores(x, np.array([2.0**30, 1.0])).tolist() == [2**60 + 1, 2**60 + 2]
    assert np.isfinite(mtree.scale_vector(np.array([1.7e308, -1.7e308]))).all()
    huge = np.array([[2.0**31 - 1] * 8])
    assert mtree.exact_scores(huge, huge[0]).tolist() == [2**63 - 1]


def test_tree_avoids_computations_and_finds_all():
    rng = np.random.default_rng(2)
    x = np.floor(np.concatenate([rng.normal(c * 50, 1.0, size=(200, 4)) for c in range(6)]))
    pages = mtree.build_tree(1, x, [[i] for i in range(len(x))], 8, 16)
    import pandas as pd

    tree = mtree.Tree(pd.DataFrame(pages))
    q = x[0]
    want = sorted(((-int(v @ q), i) for i, v in enumerate(x) if i != 0))[:5]
    assert [(-s, i) for s, i in tree.search(q, 0, 5)] == want
    assert tree.avoided > 0 and tree.computed < len(x)


def test_lattice_decoder_is_nearest():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8)) * 2
    got = lattice.nearest_e8(x)
    near = ((x - got) ** 2).sum(1)
    for v in lattice.roots():  # no neighbour is closer
        assert (((x - got - v) ** 2).sum(1) >= near - 1e-12).all()
    doubled = got * 2
    assert (doubled == np.rint(doubled)).all() and (got.sum(1) % 2 == 0).all()
    assert len(lattice.roots()) == 240 and np.allclose((lattice.roots() ** 2).sum(1), 2)


def brute_links(rows, threshold):
    good = [(i, np.array(np.float32(v), dtype=np.float64)) for i, v in rows if i is not None and usable(v) and any(v)]
    links = {}
    up = {i: i for i, _ in good}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, (i, x) in enumerate(good):
        for j, y in good[a + 1 :]:
            if len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                links[i] = links.get(i, 0) + 1
                links[j] = links.get(j, 0) + 1
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    return {i: (links.get(i, 0), find(i) if i in up else i) for i, _ in rows if i is not None}


@pytest.mark.parametrize("unit", [2048, 8])
def test_near_duplicates_equal_brute_force(spark, unit):
    rows = vectors(300, 4)
    got = lattice.near_duplicates(frame(spark, rows), unit=unit).collect()
    assert len(got) == len(rows)
    want = brute_links(rows, 0.95)
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, False)
        else:
            assert (r["n_links"], r["component_id"]) == want[r["vec_id"]]
            assert r["kept"] == (r["vec_id"] == r["component_id"])


def test_recall_of_pairs_near_the_threshold(spark):
    rnd = np.random.default_rng(5)
    rows = []
    for i in range(300):
        x = rnd.normal(size=64)
        x /= np.linalg.norm(x)
        g = rnd.normal(size=64)
        g -= (g @ x) * x
        g /= np.linalg.norm(g)
        c = 0.9505 + 0.01 * random.Random(i).random()
        rows += [(2 * i, [float(v) for v in x]), (2 * i + 1, [float(v) for v in c * x + math.sqrt(1 - c * c) * g])]
    got = {r["vec_id"]: r["n_links"] for r in lattice.near_duplicates(frame(spark, rows)).collect()}
    want = brute_links(rows, 0.95)
    assert all(got[i] <= n for i, (n, _) in want.items())
    assert sum(got.values()) >= 0.97 * sum(n for n, _ in want.values())


def test_links_of_two_lengths_in_equal_numbers(spark):
    rng = np.random.default_rng(9)
    rows = []
    for dim in (64, 32):
        base = rng.normal(size=(400, dim))
        near = base + rng.normal(size=base.shape) * 0.1
        rows += [(len(rows) + i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([base, near]))]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.near_duplicates(frame(spark, rows)).collect()}
    want = brute_links(rows, 0.95)
    assert sum(got[i] == w for i, w in want.items()) >= 0.99 * len(rows)


def test_empty_near_duplicates(spark):
    assert lattice.near_duplicates(frame(spark, [])).count() == 0
    assert lattice.near_duplicates(frame(spark, ODD[:6])).where("n_links > 0").count() == 0


def test_queries_of_a_block_open_each_page_once():
    import pandas as pd

    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(600, 8)) * 100)
    x[50:60] = x[7]
    found = {}
    for i, v in enumerate(x):
        found.setdefault(v.tobytes(), []).append(i)
    distinct = np.stack([np.frombuffer(v) for v in found])

    class Opened(dict):
        times = 0

        def __getitem__(self, page):
            self.times += 1
            return super().__getitem__(page)

    tree = mtree.Tree(pd.DataFrame(mtree.build_tree(1, distinct, list(found.values()), 4, 16)))
    tree.pages = Opened(tree.pages)
    own, floor = np.arange(0, 600, 3), np.full(200, -mtree.EDGE)
    floor[::2] = 40_000
    row, ids, scores = tree.search_all(x[own], own, 5, floor)
    assert tree.pages.times <= len(tree.pages) + 1  # once each; the root's centre first
    got = {}
    for r, i, s in zip(row.tolist(), ids.tolist(), scores.tolist(), strict=True):
        got.setdefault(r, []).append((-s, i))
    for r, q in enumerate(own):
        every = sorted((-int(x[q] @ x[i]), i) for i in range(600) if i != q)
        assert got.get(r, []) == [(s, i) for s, i in every if -s >= floor[r]][:5]
