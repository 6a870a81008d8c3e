"""Exact top-k inner products by best-first search in M-trees.

Vectors are dealt to the nearest of some pivots; each share becomes one
M-tree, written as pages: a metric node with its entries, each with a
covering radius and its distance to the node's own centre. A query walks a
tree best-first. The inner product relates to distance by
``q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2``, so with the largest norm below a
node, a lower bound of the distance bounds every score below it. Stored
parent distances give that bound without computing the entry's own distance.

Each query searches its home tree first. Its k-th score there decides which
other trees can hold a better vector; only those are searched. The queries of
a block walk a tree together, so a page is opened once for all of them.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logwise.llm.common import materialize, ship_package
from logwise.llm.vectors import distinct_vectors, is_finite

#: Slack of bounds: they are computed in floating point, scores exactly.
SLACK = 1e-9
#: Largest score, its negative the smallest; below that: no score.
EDGE = 2**63 - 1
NONE = np.int64(-(2**63))

PAGES = (
    "tree long, page long, leaf boolean, centre binary, size int, norms binary, radii binary, "
    "parent_dist binary, children array<long>, entries binary, ids array<array<long>>"
)


def scale_vector(v: np.ndarray, scale: float = 256.0) -> np.ndarray:
    """floor(scale * x) per component, in doubles, within the finite ones."""
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * v), -most, most)


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products of rows of ``x`` with ``q`` as int64, exact
    unless beyond a long, where they saturate."""
    most = (int(np.abs(x).max(initial=0)), int(np.abs(q).max(initial=0)))
    top = most[0] * most[1] * max(1, q.size)
    if top < 2**53:
        return (x @ q).astype(np.int64)
    if top < 2**63 and max(most) < 2**63:
        return x.astype(np.int64) @ q.astype(np.int64)
    big = [sum(int(a) * int(b) for a, b in zip(row, q, strict=True)) for row in x]
    return np.array([max(-EDGE, min(EDGE, s)) for s in big], dtype=np.int64)


def exact_products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """:func:`exact_scores` of rows of ``x`` with every row of ``q``, (rows of
    ``q``, rows of ``x``)."""
    top = int(np.abs(x).max(initial=0))
    plain = np.abs(q).max(axis=1, initial=0) < 2**53 / max(1, top * x.shape[1])
    out = np.empty((len(q), len(x)), dtype=np.int64)
    out[plain] = (q[plain] @ x.T).astype(np.int64)
    for i in np.flatnonzero(~plain).tolist():
        out[i] = exact_scores(x, q[i])
    return out


@np.errstate(over="ignore", invalid="ignore")
def build_tree(tree: int, x: np.ndarray, ids: list, fanout: int, capacity: int) -> list[dict]:
    """Pages of an M-tree over rows of ``x``, top page 0.

    Built from the top: entries of a page are medoids drawn with a fixed
    seed; each takes the rows that are nearest to it. A share that no longer
    splits (equal distances) is cut by position.
    """
    pages: list[dict] = []
    rng = np.random.default_rng(tree)
    norms = np.einsum("ij,ij->i", x, x)

    def node(rows: np.ndarray, centre: np.ndarray) -> int:
        number = len(pages)
        pages.append({})
        dist = np.sqrt(np.maximum(((x[rows] - centre) ** 2).sum(1), 0))
        if len(rows) <= capacity:
            order = np.argsort(dist, kind="stable")
            rows, dist = rows[order], dist[order]
            pages[number] = _page(
                tree, number, True, centre, norms[rows], np.zeros(len(rows)), dist, [], x[rows], [ids[i] for i in rows]
            )
            return number
        seeds = rng.choice(rows, size=min(fanout, max(2, len(rows) // capacity)), replace=False)
        near = ((x[rows][:, None, :] - x[seeds][None, :, :]) ** 2).sum(2).argmin(1) if len(rows) * len(seeds) < 200_000 else _nearest(x, rows, seeds)
        groups = [rows[near == k] for k in range(len(seeds))]
        if max(map(len, groups)) == len(rows):
            groups = np.array_split(rows, len(seeds))
        members = [(g, x[s]) for g, s in zip(groups, seeds, strict=True) if len(g)]
        radii = np.array([np.sqrt(((x[g] - c) ** 2).sum(1).max()) for g, c in members])
        parent = np.array([np.sqrt(((c - centre) ** 2).sum()) for _, c in members])
        top = np.array([norms[g].max() for g, _ in members])
        children = [node(g, c) for g, c in members]
        pages[number] = _page(tree, number, False, centre, top, radii, parent, children, np.stack([c for _, c in members]), [])
        return number

    node(np.arange(len(x)), x.mean(0))
    return pages


def _nearest(x: np.ndarray, rows: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    c = x[seeds]
    half = (c * c).sum(1) / 2
    return np.concatenate([(half - x[rows[i : i + 4096]] @ c.T).argmin(1) for i in range(0, len(rows), 4096)])


def _page(tree, page, leaf, centre, norms, radii, parent, children, entries, ids) -> dict:
    raw = lambda a: np.ascontiguousarray(a, dtype=np.float64).tobytes()
    return {
        "tree": tree, "page": page, "leaf": leaf, "centre": raw(centre), "size": len(norms), "norms": raw(norms),
        "radii": raw(radii), "parent_dist": raw(parent), "children": children, "entries": raw(entries), "ids": ids,
    }


def _bound(norms: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Upper bounds of inner products from sums of squared norms and least
    distances, with slack; no bound where the numbers leave the doubles."""
    with np.errstate(over="ignore", invalid="ignore"):
        upper = (norms - low * low) / 2 + SLACK * norms + SLACK
    # scores end at the smallest long
    return np.where(np.isfinite(norms) & np.isfinite(low), np.maximum(upper, -9.2e18), np.inf)


class Tree:
    """Pages of one tree, opened for searching."""

    def __init__(self, pdf: pd.DataFrame):
        self.pages = {}
        for p in pdf.to_dict("records"):
            f = lambda k: np.frombuffer(p[k])  # noqa: E731, B023
            self.pages[p["page"]] = (
                bool(p["leaf"]), f("norms"), f("radii"), f("parent_dist"), p["children"],
                f("entries").reshape(p["size"], -1), p["ids"], f("centre"),
            )
        self.computed = self.avoided = 0

    def search(self, q: np.ndarray, own: int, k: int, floor: float = -np.inf) -> list[tuple[int, int]]:
        """The k best (score, id) of one query, as in :meth:`search_all`."""
        least = -EDGE if floor == -np.inf else int(floor)
        _, ids, scores = self.search_all(q[None, :], np.array([own]), k, np.array([least], dtype=np.int64))
        return list(zip(scores.tolist(), ids.tolist(), strict=True))

    @np.errstate(over="ignore", invalid="ignore")  # then there is no bound
    def search_all(self, q: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``q``, id, score): of every query the k best ids with a
        score >= its floor, ties to smaller ids; its id ``own`` takes no part.

        The queries walk the tree together: of the waiting pages the one with
        the best bound of any query is read next, once, by all queries whose
        bound there still reaches their k-th score."""
        qq = np.einsum("ij,ij->i", q, q)
        scores = np.full((len(q), k), NONE)
        found = np.zeros((len(q), k), dtype=np.int64)
        least = floor.copy()
        ticket = itertools.count()
        root = self.pages[0]
        dist = np.sqrt(((q - root[7]) ** 2).sum(1))
        queue = [(-np.inf, next(ticket), 0, np.arange(len(q)), np.full(len(q), np.inf), dist)]
        while queue:
            _, _, number, rows, bound, dist = heapq.heappop(queue)
            live = bound >= least[rows]
            if not live.any():
                continue
            rows, dist = rows[live], dist[live]
            leaf, norms, radii, parent, children, entries, ids, _ = self.pages[number]
            # triangle inequality on stored distances only
            low = np.maximum(np.abs(dist[:, None] - parent) - radii, 0)
            near = _bound(qq[rows, None] + norms, low) >= least[rows, None]
            self.avoided += near.size - int(near.sum())
            self.computed += int(near.sum())
            some = np.flatnonzero(near.any(1))
            used = np.flatnonzero(near.any(0))
            if not len(some):
                continue
            rows, near = rows[some], near[np.ix_(some, used)]
            if leaf:
                self._take(exact_products(entries[used], q[rows]), near, [ids[i] for i in used], rows, own, scores, found, floor, least)
            else:
                for j, i in enumerate(used.tolist()):
                    at = rows[near[:, j]]
                    own_dist = np.sqrt(((q[at] - entries[i]) ** 2).sum(1))
                    upper = _bound(qq[at] + norms[i], np.maximum(own_dist - radii[i], 0))
                    keep = upper >= least[at]
                    if keep.any():
                        waiting = (at[keep], upper[keep], own_dist[keep])
                        heapq.heappush(queue, (-float(upper[keep].max()), next(ticket), int(children[i]), *waiting))
        row, rank = np.nonzero(scores > NONE)
        return row, found[row, rank], scores[row, rank]

    @staticmethod
    def _take(new: np.ndarray, near: np.ndarray, ids: list, rows: np.ndarray, own: np.ndarray, scores: np.ndarray, found: np.ndarray, floor: np.ndarray, least: np.ndarray) -> None:
        """Merges a leaf's scores, (queries, entries), into the k best of the
        queries ``rows``; every entry stands for its ids."""
        k = scores.shape[1]
        times = np.array([len(x) for x in ids])
        name = np.concatenate([np.asarray(x, dtype=np.int64) for x in ids])
        new = np.repeat(np.where(near, new, NONE), times, axis=1)
        new[name == own[rows, None]] = NONE
        enough = least[rows]
        if new.shape[1] > k:
            enough = np.maximum(enough, np.partition(new, -k, axis=1)[:, -k])
        r, c = np.nonzero((new >= enough[:, None]) & (new > NONE))
        if not len(r):
            return
        hit = np.unique(r)
        old_r, old_c = np.nonzero(scores[rows[hit]] > NONE)
        old_q = rows[hit][old_r]
        who = np.concatenate([rows[r], old_q])
        score = np.concatenate([new[r, c], scores[old_q, old_c]])
        what = np.concatenate([name[c], found[old_q, old_c]])
        # a score beyond the smallest long has no negative
        order = np.lexsort((what, ~score, who))
        who, score, what = who[order], score[order], what[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        best = rank < k
        scores[who[best], rank[best]] = score[best]
        found[who[best], rank[best]] = what[best]
        full = scores[rows[hit], k - 1]
        least[rows[hit]] = np.maximum(floor[rows[hit]], full)


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: float = 256.0,
    tree_size: int = 8192,
    max_trees: int = 4096,
    query_block: int = 1024,
    fanout: int = 32,
    capacity: int = 128,
) -> DataFrame:
    """The k highest integer inner products of each query over all rows.

    Components become ``floor(scale * x)``. Result: query_id, rank (from 1),
    vec_id, score; ties go to the smaller id; a query meets every row but
    rows of its own id, and fewer than k rows give fewer ranks. Vectors that
    are null or empty, or hold null or non-finite components, take no part on
    either side, as do null ids; scores beyond a long are the largest or
    smallest long; vectors of different length never meet. A repeated query row counts once,
    a repeated candidate row as often as it occurs. Other columns are ignored.
    Empty tables give no rows.

    Equal vectors are stored once with their k + 1 smallest ids: more cannot
    reach a result. Shares beyond ``tree_size`` (a pivot that draws a third of
    all rows) are salted into several trees.
    """
    spark = rows.sparkSession
    ship_package(spark)
    encode = lambda v: scale_vector(v, scale).tobytes()

    points = materialize(
        distinct_vectors(rows.where(is_finite(F.col(vec_col).cast("array<double>"))), id_col, vec_col, encode, k + 1),
        "mtree-points",
    )

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"vec": [encode(np.asarray(v)) for v in pdf["v"]], "query_id": pdf["query_id"]})

    vector = F.col(vec_col).cast("array<double>")
    wanted = queries.where(is_finite(vector) & F.col(id_col).isNotNull())
    wanted = wanted.select(F.col(id_col).cast("long").alias("query_id"), vector.alias("v"))
    asked = materialize(wanted.mapInPandas(encoded, "vec binary, query_id long").distinct(), "mtree-queries")
    n, n_queries = points.count(), asked.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n or not n_queries:
        return empty
    trees = max(1, min(max_trees, -(-n // tree_size)))
    drawn = [bytes(r["vec"]) for r in points.orderBy(F.xxhash64("vec"), "vec").limit(trees).collect()]
    dims = {len(v) for v in drawn} | {r[0] for r in points.select(F.length("vec")).distinct().collect()}
    pivots = spark.sparkContext.broadcast({d: np.array([np.frombuffer(v) for v in drawn if len(v) == d]) for d in dims})

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            share = np.zeros(len(pdf), dtype=np.int64)
            for i, raw in enumerate(pdf["vec"]):
                c = pivots.value[len(raw)]
                if len(c):
                    v = np.frombuffer(raw)
                    share[i] = int((((c - v) ** 2).sum(1)).argmin())
            pdf["share"] = share * 2**20 + pdf["vec"].map(len) // 8  # vectors of one length together
            yield pdf

    dealt = materialize(points.mapInPandas(assign, "vec binary, n long, ids array<long>, share long"), "mtree-dealt")
    parts = dealt.groupBy("share").agg(F.count(F.lit(1)).alias("_rows"))
    parts = parts.select("share", F.greatest(F.lit(1), F.ceil(F.col("_rows") / tree_size)).cast("long").alias("_cuts"))
    salted = dealt.join(F.broadcast(parts), "share").select(  # at most max_trees rows a vector length
        (F.col("share") * 2**20 + F.pmod(F.xxhash64("vec"), "_cuts")).alias("tree"), "vec", "ids"
    )

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(v) for v in pdf["vec"]])
        ids = [list(map(int, i)) for i in pdf["ids"]]
        return pd.DataFrame(build_tree(int(key[0]), x, ids, fanout, capacity))

    pages = materialize(salted.groupBy("tree").applyInPandas(build, PAGES), "mtree-pages")

    # a query's home tree: the first tree of its nearest pivot
    found = asked.select("vec", F.lit(0).cast("long").alias("n"), F.array("query_id").alias("ids"))
    home = found.mapInPandas(assign, "vec binary, n long, ids array<long>, share long").select(
        F.col("ids")[0].alias("query_id"), "vec", (F.col("share") * 2**20).alias("tree"), F.lit(None).cast("double").alias("least")
    )
    blocks = max(1, -(-n_queries // query_block))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        # a double: beyond 2^53 it may be rounded upwards
        floor = [-EDGE if pd.isna(x) else max(-EDGE, int(x) - (abs(int(x)) >> 50)) for x in left["least"]]
        own, q = left["query_id"].to_numpy(), np.stack([np.frombuffer(raw) for raw in left["vec"]])
        row, ids, scores = Tree(right).search_all(q, own, k, np.array(floor, dtype=np.int64))
        return pd.DataFrame({"query_id": own[row], "vec_id": ids, "score": scores})

    def run(todo: DataFrame) -> DataFrame:
        todo = materialize(todo.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))), "mtree-todo")
        pairs = todo.select(F.col("tree").alias("of_tree"), F.col("block").alias("of_block")).distinct()
        wanted = pages.join(pairs, F.col("tree") == F.col("of_tree"))
        return (
            todo.groupBy("tree", "block")
            .cogroup(wanted.groupBy("of_tree", "of_block"))
            .applyInPandas(lambda a, b: search(a, b), "query_id long, vec_id long, score long")
        )

    first = materialize(run(home), "mtree-home")
    floor = first.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("least")  # a home tree gives at most k rows
    )
    # root pages: mean centre, covering radius and largest norm of every tree
    roots = {
        int(r["tree"]): (np.frombuffer(r["centre"]), *_root_bounds(r))
        for r in pages.where(F.col("page") == 0).select("tree", "leaf", "centre", "norms", "radii", "parent_dist").toLocalIterator()
    }
    shared = spark.sparkContext.broadcast(roots)

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table: dict[int, tuple] = {}
        for t, (c, r, m) in shared.value.items():
            table.setdefault(len(c), []).append((t, c, r, m))
        table = {d: tuple(map(np.array, zip(*v, strict=True))) for d, v in table.items()}
        for pdf in batches:
            rows = []
            for q, raw, h, least in zip(pdf["query_id"], pdf["vec"], pdf["tree"], pdf["least"], strict=True):
                v = np.frombuffer(raw)
                if len(v) not in table:
                    continue
                names, centres, radii, norms = table[len(v)]
                with np.errstate(over="ignore", invalid="ignore"):
                    low = np.maximum(np.sqrt(((centres - v) ** 2).sum(1)) - radii, 0)
                    upper = _bound(v @ v + norms, low)
                open_ = names != h if pd.isna(least) else (names != h) & (upper >= least)
                rows += [(q, raw, int(t), least) for t in names[open_]]
            if rows:
                yield pd.DataFrame(rows, columns=["query_id", "vec", "tree", "least"])

    rest = home.drop("least").join(floor, "query_id", "left").select("query_id", "vec", "tree", "least")
    second = run(rest.mapInPandas(others, "query_id long, vec binary, tree long, least double"))
    ranked = first.unionByName(second).withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    )
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _root_bounds(row) -> tuple[float, float]:
    radii, parent = np.frombuffer(row["radii"]), np.frombuffer(row["parent_dist"])
    return float((radii + parent).max()), float(np.frombuffer(row["norms"]).max())
