"""Vector codes against plain loops over whole integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from logwise.llm import codes

VECS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.StringType()),
        T.StructField("position", T.StringType()),  # names used inside the operator
        T.StructField("n", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("code", T.StringType()),
    ]
)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "p", "q", "r", "s") for i, v, label in rows], VECS)


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{(id, code, error, label error)} as a sorted list, and the codebooks."""
    kept = [(i, v, y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = next((len(v) for _, v, _ in kept if v), 0)

    def ints(v):
        return [int(x) * scale if abs(x) >= 2.0**52 else math.floor(x * scale) for x in v]

    fit = [ints(v) for _, v, _ in kept if len(v) == dim]
    cuts = codes.cuts(dim, parts)
    books = [[v[a:b] for v in fit[:entries]] for a, b in cuts]

    def best(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            mine = {}
            for v in fit:
                mine.setdefault(best(v[a:b], books[p])[1], []).append(v[a:b])
            books[p] = [
                [sum(c) // len(mine[k]) for c in zip(*mine[k], strict=True)] if k in mine else e for k, e in enumerate(books[p])
            ]
    out = []
    for i, v, y in kept:
        if len(v) != dim:
            out.append((i, y, None, None))
            continue
        found = [best(ints(v)[a:b], book) for (a, b), book in zip(cuts, books, strict=True)]
        error = sum(d for d, _ in found)
        out.append((i, y, "".join(f"{k:02x}" for _, k in found), error if error < 2**63 else None))
    total = {}
    for _, y, _, e in out:
        if e is not None:
            total[y] = total.get(y, 0) + e
    sums = {y: t if t < 2**63 else None for y, t in total.items()}
    text = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(((i, c, e, sums.get(y)) for i, y, c, e in out), key=repr), hashlib.sha256(text.encode()).hexdigest()


def got(spark, rows):
    found, books = codes.compress(frame(spark, rows))
    cols = [(r["id"], r["code"], r["error"], r["label_error"]) for r in found.collect()]
    return sorted(cols, key=repr), codes.digest(books)


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in v], "ab"[i % 2] if i % 5 else None) for i, v in enumerate(rng.normal(size=(n, dim)) * 0.01)]
    rows += [(n + i, rows[3][1], "b") for i in range(60)]  # copies
    rows += [(7, rows[7][1], "a"), (7, rows[8][1], "a"), (None, rows[1][1], "null")]  # repeated and null ids
    rows += [(900, None, "a"), (901, [], "a"), (902, [None] * dim, "a"), (903, [math.inf] * dim, "b"), (904, [0.5], "c")]
    return rows


@pytest.mark.parametrize("dim", [16, 20, 3])
def test_codes_equal_plain_loops(spark, dim):
    rows = vectors(150, dim, dim)
    assert got(spark, rows) == brute(rows)


def test_few_rows_ties_and_empty_tables(spark):
    rows = [(2, [0.5] * 8, None), (1, [0.5] * 8, "x"), (3, [-0.25] * 8, None)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == brute([])
    assert got(spark, [(1, None, "a")]) == brute([])


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v], None) for i, v in enumerate(rng.normal(size=(40, 8)) * 1e5)]
    rows += [(100 + i, [float(x) for x in v], "far") for i, v in enumerate(rng.normal(size=(5, 8)) * 1e200)]
    rows += [(200, [1.7e308] * 8, "end")]
    assert got(spark, rows) == brute(rows)


def test_walk_shares_nodes_over_blocks_and_any_order():
    rng = np.random.default_rng(5)
    parts = rng.integers(-3, 3, size=(2000, 6))
    order, group = codes._sorted_distinct(parts)
    distinct = parts[order[np.flatnonzero(np.diff(group, prepend=-1))]]
    book = rng.integers(-3, 3, size=(7, 6))
    dist = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    walk = codes.TrieWalk(book)
    found = [walk.nearest(distinct[i : i + 50]) for i in range(0, len(distinct), 50)]
    assert (np.concatenate([f[0] for f in found])[group] == dist.argmin(axis=1)[order]).all()
    assert (np.concatenate([f[1] for f in found])[group] == dist.min(axis=1)[order]).all()
    prefixes = sum(len({tuple(p[: d + 1]) for p in distinct.tolist()}) for d in range(6))
    assert walk.nodes == prefixes < distinct.size  # every node of the trie once
    shuffled = codes.TrieWalk(book)
    assert (shuffled.nearest(parts)[0] == dist.argmin(axis=1)).all()
