"""Embedding near-duplicates by E8 lattice hashing.

Unit vectors are projected to 8 dimensions by random orthonormal frames, one
per table, scaled, shifted and decoded to the nearest E8 lattice point. A
vector is stored in its own cell and probes the neighbouring cells that are
nearest to its projection; vectors that meet in a cell are compared by cosine
in doubles.

Scale and tables follow the row count and the threshold: the scale keeps the
expected cell small, and as many tables are taken as pairs exactly at the
threshold need to meet with the wanted probability (simulated for the
dimension at hand).
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwise.llm.common import components, materialize, mix64, ship_package
from logwise.llm.vectors import distinct_vectors, is_finite

#: Neighbouring cells that a vector probes in each table.
PROBES = 4
#: Rows of a cell handled as one unit; larger cells are cut into block pairs.
UNIT = 2048


@functools.lru_cache(maxsize=1)
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps to neighbouring cells."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points of even sum: where the sum is odd, the worst
    rounded coordinate goes the other way."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(1) % 2 != 0)
    gap = (x - r)[odd]
    worst = np.abs(gap).argmax(1)
    r[odd, worst] += np.where(gap[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest lattice point of each row: D8 or D8 shifted by one half."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def frames(dim: int, tables: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Orthonormal projection (dim x 8, zero-padded below 8) and shift per table."""
    rng = np.random.default_rng([seed, dim])
    out = []
    for _ in range(tables):
        q, _ = np.linalg.qr(rng.normal(size=(max(dim, 8), 8)))
        out.append((q[:dim], rng.random(8)))
    return out


def cells(u: np.ndarray, frame: tuple[np.ndarray, np.ndarray], scale: float, table: int) -> np.ndarray:
    """Keys of the own cell (column 0) and the probed cells of each unit row;
    vectors of different length share none."""
    x = u @ frame[0] * scale + frame[1]
    own = nearest_e8(x)
    step = roots()
    near = np.argsort(-((x - own) @ step.T), axis=1, kind="stable")[:, :PROBES]
    points = np.concatenate([own[:, None, :], own[:, None, :] + step[near]], axis=1)
    whole = np.rint(points * 2).astype(np.int64).view(np.uint64)
    key = np.full(points.shape[:2], np.uint64((u.shape[1] << 32) + table + 1))
    for c in range(8):
        key = mix64(key ^ whole[:, :, c] + np.uint64(c))
    return key.view(np.int64)


def meet_rate(dim: int, scale: float, threshold: float, pairs: int = 2000, seed: int = 5) -> float:
    """Share of random pairs exactly at the threshold that meet in a table."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(pairs, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if dim < 2:
        return 1.0
    g = rng.normal(size=(pairs, dim))
    g -= (g * x).sum(1, keepdims=True) * x
    g /= np.linalg.norm(g, axis=1, keepdims=True)
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * g
    hit = []
    for t, f in enumerate(frames(dim, 3, seed + 1)):
        a, b = cells(x, f, scale, t), cells(y, f, scale, t)
        hit.append(((a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)).mean())
    return float(np.mean(hit))


def plan(dim: int, n: int, threshold: float, recall: float) -> tuple[float, int]:
    """(scale, tables): about 16 expected rows in a cell of spread-out
    vectors, the scale between 4 and 8 times sqrt(dim / 64)."""
    unit = math.sqrt(max(dim, 8) / 64)
    scale = unit * min(8.0, max(4.0, 4.0 * (0.0034 * n / 16) ** 0.125))
    rate = min(0.9999, max(0.02, meet_rate(dim, scale, threshold)))
    return scale, max(2, math.ceil(math.log(1 - recall) / math.log(1 - rate)))


def near_duplicates(
    rows: DataFrame,
    threshold: float = 0.95,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    recall: float = 0.998,
    seed: int = 11,
    unit: int = UNIT,
) -> DataFrame:
    """Links of cosine >= threshold and their components.

    Result per row: id, n_links (other rows linked directly), component_id
    (smallest id reachable, itself included), kept (id is the component's).
    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing; vectors of different length do not link. Equal vectors
    are one class: its members link with each other and with all members of
    linked classes, without being expanded into pairs. Rows of a repeated id
    are rows of their own but share id and component; null ids are returned
    with 0 links and a null component. Other columns are ignored. An empty
    table gives no rows.
    """
    spark = rows.sparkSession
    ship_package(spark)
    vec = F.col("v")
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    usable = F.coalesce(is_finite(vec) & F.exists(vec, lambda x: x != 0) & F.col("id").isNotNull(), F.lit(False))
    encode = lambda v: (v + 0.0).tobytes()  # noqa: E731  one zero

    classes = materialize(
        distinct_vectors(base.where(usable), "id", "v", encode, 1).select(F.col("ids")[0].alias("rep"), "vec", "n"),
        "lattice-classes",
    )
    sizes = {int(r["d"]): int(r["n"]) for r in classes.groupBy((F.length("vec") / 8).cast("int").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    plans = {d: plan(d, n, threshold, recall) for d, n in sizes.items()}

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys: list = [None] * len(pdf)
            size = pdf["vec"].map(len).to_numpy() // 8
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                u = _unit(np.stack([np.frombuffer(pdf["vec"].iloc[i]) for i in at]))
                scale, tables = plans[int(d)]
                per = np.concatenate([cells(u, f, scale, t) for t, f in enumerate(frames(int(d), tables, seed))], axis=1)
                for i, k in zip(at, per, strict=True):
                    keys[i] = k
            pdf["keys"] = keys
            yield pdf

    table = materialize(
        classes.mapInPandas(hashed, "rep long, vec binary, n long, keys array<long>"), "lattice-hashed"
    )
    # vectors go only to cells where somebody lives and somebody else comes
    seats = table.select("rep", F.posexplode("keys").alias("pos", "cell")).withColumn(
        "own", (F.col("pos") % (PROBES + 1) == 0).cast("int")
    )
    busy = (
        seats.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("_rows"), F.sum("own").alias("_own"))
        .where((F.col("_own") > 0) & (F.col("_rows") > 1))
        .select("cell", F.ceil(F.col("_rows") / unit).cast("int").alias("cuts"))
    )
    placed = seats.join(busy, "cell").withColumn("block", F.pmod(F.xxhash64("rep", "cell"), F.col("cuts")).cast("int"))
    # a cell of c blocks has units (i, j), i <= j; a row goes to those with its block
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    units = placed.select("cell", "rep", "block", other.alias("with"), F.col("pos").alias("pos")).select(
        "cell", "rep", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "pos"
    )
    # units are dealt to buckets of many small cells
    total = int(sum(sizes.values()))
    buckets = max(1, -(-total * 16 // 20_000))
    loaded = units.join(table, "rep").withColumn("bucket", F.pmod(F.xxhash64("cell", "i", "j"), F.lit(buckets)))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        # by length too, should two keys be equal by chance
        for _, cell_rows in pdf.groupby(["cell", "i", "j", pdf["vec"].map(len)], sort=False):
            if len(cell_rows) > 1:
                out += _cell_links(cell_rows, threshold)
        return pd.DataFrame(out, columns=["rep", "links", "root"])

    links = materialize(
        loaded.select("bucket", "cell", "i", "j", "block", "rep", "vec", "n", "keys")
        .groupBy("bucket")
        .applyInPandas(compare, "rep long, links long, root long"),
        "lattice-links",
    )
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    linked = components(links.select("rep", "root"), "rep", "root")
    found = (
        table.select("rep", "vec", "n")
        .join(counts, "rep", "left")
        .join(linked.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "vec",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["vec"] = [encode(np.asarray(v, dtype=np.float64)) if ok else None for v, ok in zip(pdf["v"], pdf["ok"], strict=True)]
            yield pdf[["id", "vec"]]

    every = base.select("id", "v", usable.alias("ok")).mapInPandas(keyed, "id long, vec binary")
    return every.join(found, "vec", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(False)).alias("kept"),
    )


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small values stay finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _cell_links(rows: pd.DataFrame, threshold: float) -> list[tuple[int, int, int]]:
    """(rep, weighted links, union-find root) of the pairs whose first meeting
    is this unit; a forest of roots instead of the pairs themselves."""
    rep, n = rows["rep"].to_numpy(), rows["n"].to_numpy()
    cell, i, j = int(rows["cell"].iloc[0]), int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
    block = rows["block"].to_numpy()
    keys = np.stack(rows["keys"].to_list())
    own, step = keys[:, :: PROBES + 1], PROBES + 1
    u = _unit(np.stack([np.frombuffer(v) for v in rows["vec"]]))
    parent = list(range(len(rep)))

    def find(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    links = np.zeros(len(rep), dtype=np.int64)
    for lo in range(0, len(rep), 256):
        close = u[lo : lo + 256] @ u.T >= threshold
        a, b = np.nonzero(close)
        a = a + lo
        ok = rep[a] < rep[b]
        if i != j:
            ok &= block[a] != block[b]
        a, b = a[ok], b[ok]
        if not len(a):
            continue
        probes_a, probes_b = keys[a].reshape(len(a), -1, step), keys[b].reshape(len(b), -1, step)
        same = own[a] == own[b]
        into_a = (probes_b == own[a][:, :, None]).any(2)  # b probes the cell of a
        into_b = (probes_a == own[b][:, :, None]).any(2)
        meets = same | into_a | into_b
        first = meets.argmax(1)
        at = np.arange(len(a))
        where = np.where(into_a[at, first], own[a, first], own[b, first])
        here = meets[at, first] & (where == cell)
        a, b = a[here], b[here]
        np.add.at(links, a, n[b])
        np.add.at(links, b, n[a])
        for p, q in zip(a.tolist(), b.tolist(), strict=True):
            ra, rb = find(p), find(q)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    best: dict[int, int] = {}
    for k in np.flatnonzero(links).tolist():
        r = find(k)
        best[r] = min(best.get(r, int(rep[k])), int(rep[k]))
    return [(int(rep[k]), int(links[k]), best[find(k)]) for k in np.flatnonzero(links).tolist()]
